from collections import Counter

from skein.functions.text import occurrences, token_count, tokens
from skein.operators import words as w

TEXTS = ["", "  two  words ", "a b c\x1cd\x85e", "Covid-19 Covid-19Covid-19", "konec.\n\nřádku\tx",
         "http://x.y (Word) word! wörd, ?", None]


def frame(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "pos int, text string")


def test_tokens_are_those_of_a_unicode_split(spark):
    for row in frame(spark).select("text", tokens("text").alias("words"), token_count("text").alias("n")).collect():
        if row.text is None:
            assert row.n == 0
        else:
            assert row.words == row.text.split()
            assert row.n == len(row.text.split())


def test_counts_against_python(spark):
    rows = frame(spark)
    words = [x for t in TEXTS if t for x in t.split()]
    assert {r.word: r.n for r in w.word_count(rows, "text").collect()} == Counter(words)
    assert w.total_words(rows, "text").first().n_words == len(words)
    assert abs(w.mean_word_length(rows, "text").first()[0] - sum(map(len, words)) / len(words)) < 1e-12
    letters = Counter(x[0] for t in TEXTS if t for x in t.lower().split() if x[0].isalpha())
    assert {r.letter: r.n for r in w.first_letter_count(rows, "text").collect()} == letters
    lengths = Counter(map(len, words))
    assert {r.word_length: r.n for r in w.word_length_histogram(rows, "text").collect()} == lengths


def test_normalised_words_merge_and_skip_links(spark):
    found = {r.word: r.n for r in w.normalised_word_count(frame(spark), "text", None).collect()}
    assert found["word"] == 2 and found["wrd"] == 1
    assert not any(x.startswith("http") or x == "" for x in found)


def test_ties_go_to_the_word_seen_first(spark):
    rows = spark.createDataFrame([(2, "b a"), (1, "z b a")], "pos int, text string")
    assert [r.word for r in w.top_words(rows, "text", 3, order="pos").collect()] == ["b", "a", "z"]
    assert [r.word for r in w.top_words(rows, "text", 2).collect()] == ["a", "b"]


def test_occurrences_do_not_overlap(spark):
    row = spark.createDataFrame([("aaaa",)], "t string").select(occurrences("t", "aa").alias("n")).first()
    assert row.n == 2


def test_top_by_occurrences_takes_the_last_row_of_a_title(spark):
    rows = spark.createDataFrame(
        [(0, "t", "xx"), (1, "u", "x"), (2, "t", "")], "pos int, title string, text string")
    assert [tuple(r) for r in w.top_by_occurrences(rows, "x", 3).collect()] == [("u", 1), ("t", 0)]


def test_clean_words(spark):
    rows = spark.createDataFrame([("Ahoj, jak se dneska máš? 4x b2 ß",)], "value string")
    assert sorted(r.word for r in w.clean_words(rows, "value").collect()) == [
        "ahoj", "dneska", "jak", "máš", "se"]
    assert sorted(r.word for r in w.clean_words(rows, "value", "").collect()) == [
        "ahoj", "dneska", "jak", "m", "se"]


def test_words_are_normalised_after_the_first_count(spark):
    from skein.operators.words import normalised_word_count
    rows = spark.createDataFrame([("a A, ... http://x b",)], "text string")
    counted = normalised_word_count(rows, "text", None)
    plan = counted._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first = next(at for at, line in enumerate(plan) if "Generate" in line)
    assert not any("regexp_replace" in line for line in plan[first:])
    assert sum("Aggregate" in line for line in plan[:first]) == 2
    assert {r.word: r.n for r in counted.collect()} == {"a": 2, "b": 1}


def test_most_and_least_words_in_one_pass(spark):
    from skein.operators.words import most_and_least_words
    rows = spark.createDataFrame([(3, "a b"), (1, "c d"), (2, "e"), (4, None)], "pos int, text string")
    found = most_and_least_words(rows, "text", "pos")
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1
    assert {r.which: r.pos for r in found.collect()} == {"most": 1, "least": 4}
