"""A table with everything that may go wrong in a column."""

LONG = ("lorem ipsum dolor sit amet " * 4000) + "x" * 30_000
TEXTS = [None, "", " \t\n", "One two three FOUR five", "one two three four five", "ONE two three four five",
         "é ñ 日本語 \U0001F469‍\U0001F467 ΣΑΣ İ", LONG, LONG, "a", "a\x00b \x1c c\x85d", "<|endoftext|> it's"]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, tag string, row string, kept string, "
          "fingerprint string, segment string, word string, value string, n string, doc string, held string, k string")


def messy_rows():
    rows = [(at, text, None if at % 3 else "en", None if at % 4 else "s", None if at % 5 else at, *["x"] * 10, None)
            for at, text in enumerate(TEXTS)]
    return [*rows, rows[3], rows[3], (None, "null id", "en", "s", 1, *["x"] * 11), (None, None, *[None] * 14)]


def messy(spark, n=None):
    return spark.createDataFrame(messy_rows()[:n] if n is not None else messy_rows(), SCHEMA).repartition(3)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
