"""Personal data in plain and disguised form, with spans in the original text."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.rows import key_type, slices, texts

KINDS = ("email", "ip", "card", "phone")

# Letters of other alphabets that look like ASCII ones, in pairs.
HOMOGLYPHS = dict(zip(
    "АВЕКМНОРСТУХЅІЈԚԜаеорсухѕіјԛԝһԁΑΒΕΖΗΙΚΜΝΟΡΤΥΧοαινρυɑɡı",
    "ABEKMHOPCTYXSIJQWaeopcyxsijqwhdABEZHIKMNOPTYXoaivpuagi"))
DOTS, AT_SIGNS = "\u2024\u3002\uff0e\uff61\ufe52", "\uff20\ufe6b"
DASHES = "\u2010\u2011\u2012\u2013\u2014\u2212\ufe63\uff0d"
BLANKS = "\u00a0\u2002\u2003\u2007\u2009\u202f\u3000"
HIDDEN = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
# Words that stand for digits and signs.
DIGIT_WORDS = dict(zip("zero oh one two three four five six seven eight nine".split(), "00123456789"))
REPEATS = {"double": 2, "triple": 3}
SIGN_WORDS = {"dot": ".", "point": ".", "plus": "+", "dash": "-", "hyphen": "-"}
AT_WORDS, DOT_WORDS = "at|arroba|arobase", "dot|punto|punkt"
# Spelled digits a run needs before it is read as a number.
LEAST_SPELLED = 3


def plain_signs() -> dict[str, str]:
    """Single characters and the ASCII they stand for; hidden ones stand for nothing."""
    table = {**HOMOGLYPHS, **dict.fromkeys(DOTS, "."), **dict.fromkeys(AT_SIGNS, "@"), **dict.fromkeys(DASHES, "-"),
             **dict.fromkeys(BLANKS, " "), **dict.fromkeys(HIDDEN, "")}
    for code in range(0xFF01, 0xFF5F):
        table.setdefault(chr(code), chr(code - 0xFEE0))
    for code in range(0x80, 0x20000):
        digit = unicodedata.decimal(chr(code), None)
        if digit is not None:
            table.setdefault(chr(code), str(digit))
    return table


def chars(pieces: str) -> str:
    return "[" + re.escape(pieces) + "]"


DIGIT = "|".join(DIGIT_WORDS)
NUMBER_TOKEN = rf"(?:\b(?:(?:double|triple)\s+)?(?:{DIGIT})\b|\b(?:{'|'.join(SIGN_WORDS)})\b|[0-9]+|\+)"
SEPARATOR = r"[\s,;/().-]"
NUMBER_RUN = re.compile(rf"(?<![A-Za-z0-9]){NUMBER_TOKEN}(?:{SEPARATOR}{{0,3}}{NUMBER_TOKEN})+", re.I)
NUMBER_PART = re.compile(NUMBER_TOKEN, re.I)
SPELLED = re.compile(rf"\b(?:{DIGIT})\b", re.I)

# A name before the @ has up to 17 parts between dots, so that prose about dots takes time in proportion.
LOCAL, LABEL = r"[A-Za-z0-9_%+-]++", r"[A-Za-z0-9-]++"
AT = rf"(?:\s*[\[({{<]\s*(?:{AT_WORDS}|@)\s*[\])}}>]\s*|\s+(?:{AT_WORDS})\s+|\s?@\s?)"
DOT = rf"(?:\s*[\[({{<]\s*(?:{DOT_WORDS}|point|\.)\s*[\])}}>]\s*|\s+(?:{DOT_WORDS})\s+|\.)"
MAILBOX = re.compile(rf"(?<![A-Za-z0-9._%+-]){LOCAL}(?:{DOT}{LOCAL}){{0,16}}?(?P<at>{AT}){LABEL}(?:{DOT}{LABEL})+", re.I)
NUMBERS = re.compile(rf"(?<![0-9])[0-9]++(?:{DOT}[0-9]++){{3}}", re.I)
SIGN = re.compile(rf"(?P<at>{AT})|(?P<dot>{DOT})", re.I)
DISGUISED_SIGN = re.compile(rf"[\[({{<]\s*(?:{AT_WORDS}|{DOT_WORDS}|point|@|\.)\s*[\])}}>]|\s(?:{DOT_WORDS})\s|\s@|@\s", re.I)

# Without one of these words or signs no text holds a spelled number or a disguised sign.
LETTERS = bytes(b if chr(b).isascii() and chr(b).isalpha() else 0x20 for b in range(256))
CLUES = frozenset(w.encode() for w in [*DIGIT_WORDS, *f"{AT_WORDS}|{DOT_WORDS}|point".split("|")]) - {b"at"}
CLUE_SIGN = re.compile(r"[\[({<]\s*(?:at\s|at[\])}>]|@|\.)|\s@|@\s", re.I)


def has_clue(text: str) -> bool:
    return not CLUES.isdisjoint(text.encode().lower().translate(LETTERS).split()) or bool(CLUE_SIGN.search(text))


DOMAIN = re.compile(r"@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")
BEFORE_AT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[str, int, int]


def passes_luhn(digits: str) -> bool:
    """Check sum of card numbers: every second digit from the right doubled, digit sums added."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """Identifiers written plainly, by kind leftmost first and without overlaps; failing ones go without a retry."""
    found: list[Span] = []
    done = 0
    if "@" in text:
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > done and text[start - 1] in BEFORE_AT:
                start -= 1
            if start < m.start():
                found.append(("email", start, m.end()))
                done = m.end()
    for m in IP.finditer(text):
        # A part of thousands of digits is no number to Python; leading zeros say nothing.
        if all(len(digits) <= 3 and int(digits or "0") <= 255 for digits in (part.lstrip("0") for part in m[0].split("."))):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and passes_luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


class Rewritten:
    """A text with pieces replaced, and the way back to the places they came from."""

    def __init__(self, text: str, pieces: list[tuple[int, int, str]]):
        out, at, place = [], 0, 0
        self.out_start, self.out_end, self.start, self.end = [], [], [], []
        for start, end, new in pieces:
            out += (text[at:start], new)
            place += start - at
            self.out_start.append(place)
            place += len(new)
            self.out_end.append(place)
            self.start.append(start)
            self.end.append(end)
            at = end
        self.text = "".join((*out, text[at:]))

    def source(self, start: int, end: int) -> tuple[int, int]:
        """Span of the original characters behind ``start`` to ``end``."""
        return self._place(start, False), self._place(end - 1, True)

    def _place(self, at: int, right: bool) -> int:
        n = bisect_right(self.out_start, at) - 1
        while n >= 0 and self.out_start[n] == self.out_end[n] == at and not right:
            n -= 1  # nothing was written for this piece
        if n < 0:
            return at + right
        if at < self.out_end[n]:
            return self.end[n] if right else self.start[n]
        return self.end[n] + at - self.out_end[n] + right


def spelled_numbers(text: str) -> Iterator[tuple[int, int, str]]:
    """Digits and signs for the words of runs with enough spelled digits."""
    for run in NUMBER_RUN.finditer(text):
        if sum(1 for _ in SPELLED.finditer(run[0])) < LEAST_SPELLED:
            continue
        at = run.start()
        for part in NUMBER_PART.finditer(text, run.start(), run.end()):
            if part.start() > at:
                yield at, part.start(), "" if at > run.start() else text[at:part.start()]
            word = part[0].lower().split()
            digit = DIGIT_WORDS.get(word[-1])
            yield *part.span(), digit * REPEATS.get(word[0], 1) if digit else SIGN_WORDS.get(word[0], part[0])
            at = part.end()


def disguised_mailboxes(text: str) -> Iterator[tuple[int, int, str]]:
    """``@`` and ``.`` for their disguises. A bare word for ``@`` counts only with a disguised dot after it."""
    for box in MAILBOX.finditer(text):
        after = text[box.end("at"):box.end()]
        if re.fullmatch(r"\s+\w+\s+", box["at"]) and not DISGUISED_SIGN.search(after):
            continue
        if not re.search(r"[A-Za-z]{2,}$", after):
            continue
        for sign in SIGN.finditer(text, box.start(), box.end()):
            yield *sign.span(), "@" if sign["at"] else "."


def disguised_addresses(text: str) -> Iterator[tuple[int, int, str]]:
    """``.`` for its disguises between four numbers."""
    for numbers in NUMBERS.finditer(text):
        for sign in SIGN.finditer(text, *numbers.span()):
            if sign[0] != ".":
                yield *sign.span(), "."


class Finder:
    """The transducers and detectors, compiled once per task."""

    def __init__(self):
        self.signs = plain_signs()
        self.odd = re.compile(chars("".join(self.signs)))

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Plain spans, and those that show only after normalising, in characters of ``text``."""
        base = plain_spans(text)
        odd = not text.isascii() and not self.signs.keys().isdisjoint(text)
        if not odd and not has_clue(text):
            return base, []
        first = Rewritten(text, [(*m.span(), self.signs[m[0]]) for m in self.odd.finditer(text)] if odd else [])
        pieces = sorted([*spelled_numbers(first.text), *disguised_mailboxes(first.text),
                         *disguised_addresses(first.text)])
        kept, at = [], 0
        for piece in pieces:  # a place read in two ways keeps the first
            if piece[0] >= at:
                kept.append(piece)
                at = piece[1]
        if not odd and not kept:
            return base, []
        second = Rewritten(first.text, kept)
        added = []
        for kind, start, end in plain_spans(second.text):
            left, right = first.source(*second.source(start, end))
            if text[left:right] == second.text[start:end]:
                continue
            if not any(k == kind and s <= left and right <= e for k, s, e in base):
                added.append((kind, left, right))
        return base, list(dict.fromkeys(added))


SPANS = "array<struct<kind:string,start:int,end:int,added:boolean>>"
SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("added", pa.bool_())]))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans`` for every row: personal data in the whole text, by start and then by kind as in ``KINDS``.

    Spans count characters (code points) of the original text, the end exclusive. ``added`` marks those found only
    after normalising homoglyphs, full-width and other digits, hidden characters, spelled digits and disguised signs.
    An added span never lies inside a plain one of its kind. Null and empty texts have none; repeated rows come out
    repeated; other columns are not looked at. No shuffle; the patterns take time in proportion to the text.
    """
    order = {kind: at for at, kind in enumerate(KINDS)}

    def run(batches):
        finder = Finder()
        for part in slices(batches):
            out = []
            for content in part.column("text").to_pylist():
                base, added = finder.spans(content)
                both = [(s, order[k], e, k, False) for k, s, e in base] + [(s, order[k], e, k, True) for k, s, e in added]
                out.append([{"kind": k, "start": s, "end": e, "added": new} for s, _, e, k, new in sorted(both)])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, SPANS_ARROW)], ["doc_id", "spans"])

    rows = texts(docs, key, text)
    return rows.mapInArrow(run, f"doc_id {key_type(rows)}, spans {SPANS}")


def digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """``doc_id``, counts of plain spans by kind, ``base_sha256`` of the plain spans, ``spans`` of all, as text."""
    written = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    base = F.filter("spans", lambda x: ~x["added"])
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(F.array_join(F.transform(base, written), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", written), ",").alias("spans"),
        F.size(F.filter("spans", lambda x: x["added"])).cast("long").alias("n_added"))
