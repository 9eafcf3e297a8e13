"""Secrets in text: plain patterns, and values in credential context by the cost of guessing them."""

from __future__ import annotations

import json
import math
import re
import unicodedata
from operator import eq

import pyarrow as pa
from pyspark.sql import DataFrame

from skein.llm.rows import key_type, slices, texts

KINDS = ("assign", "access", "hex")

ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

# Names of credentials and what stands between them and their value.
NAMES = (r"pass[ _-]?(?:word|wd|phrase|code|key)?s?|pwd|pin[ _-]?code|secret(?:[ _-]?key)?|(?:access|api|auth|bearer|client|private|refresh"
         r"|session|signing|encryption)[ _-]?(?:key|token|secret)|token|api_?key|credentials?|mot de passe|contrase(?:ñ|n)a|clave|passwort|kennwort")
IS = r"is|was|equals|est|es|ist|lautet"
CONTEXT = re.compile(
    rf"(?<![A-Za-z])(?:{NAMES})[\"']?(?:\s*(?::=|=>|->|[:=])\s*|\s+(?:{IS})\s*:?\s+|\s+)(?P<value>[\"'`]?[^\s\"'`]+)"
    rf"|(?:://)[^\s/:@]+:(?P<login>[^\s/@]+)(?=@)"
    rf"|(?<![A-Za-z])(?:bearer|basic)\s+(?P<bearer>[A-Za-z0-9+/_.=~-]+)", re.I)
CLUE = re.compile(r"pass|pwd|pin|secret|token|key|credential|contrase|clave|kennwort|bearer|basic|://", re.I)
EDGES = ".,;:!?()[]{}<>\"'`*"

# Decimal logarithm of the guesses from which a value counts as a secret and not as prose or a blank form.
LEAST_COST = 4.5
# The same for values of letters only in one case: as a whole, and for each letter, for words the list lacks are long but cheaper
# by the letter. Of 102,828 such words of English prose (licences, manuals, package descriptions) 0.29 % cost so much;
# of random letters 92 % of 8, 94 % of 9 and 10, 95 % of 12, 96 % of 16 and 98 % of 24.
LEAST_LETTERS_COST, LEAST_LETTER_COST = 9.0, 1.15
# Longest word looked up in a value.
WORD_LENGTH = 24
# Longest unit of a repeat.
UNIT_LENGTH = 16

# Signs written for letters, and the rows of a keyboard.
LEET = str.maketrans("430157@$!8", "aeoistasib")
KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = str.maketrans("~!@#$%^&*()_+{}|:\"<>?", r"`1234567890-=[]\;',./")
SLANT = (0.0, 1.5, 1.75, 2.25)

# Every way to write a date, each tried at every place: a longer one must not hide a shorter one.
_YEAR, _MONTH, _DAY = r"(?:19|20)\d\d", "(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])"
DATES = [re.compile(form) for form in (
    _YEAR, *(rf"{one}([-/._]?){two}\1{three}" for one, two, three in (
        (_YEAR, _MONTH, _DAY), (_DAY, _MONTH, _YEAR), (_DAY, _MONTH, r"\d\d"), (_MONTH, _DAY, _YEAR), (_MONTH, _DAY, r"\d\d"))))]
LOG2 = math.log10(2)


def neighbours() -> dict[str, set[str]]:
    """Keys next to each other, and steps along alphabet and digits."""
    place = {c: (x + slant, y) for y, (row, slant) in enumerate(zip(KEYBOARD, SLANT)) for x, c in enumerate(row)}
    near = {c: {d for d, (x2, y2) in place.items() if d != c and abs(x2 - x) <= 1 and abs(y2 - y) <= 1}
            for c, (x, y) in place.items()}
    for row in ("abcdefghijklmnopqrstuvwxyz", "0123456789"):
        for a, b in zip(row, row[1:]):
            near[a].add(b)
            near[b].add(a)
    return near


def word_ranks(path: str) -> dict[str, int]:
    """Whole words of a public vocabulary with their rank: words merged earlier are more frequent."""
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    words = sorted((at, token[:-4]) for token, at in vocab.items()
                   if token.endswith("</w>") and len(token) > 6 and token[:-4].isascii() and token[:-4].isalpha())
    return {word: rank + 1 for rank, (_, word) in enumerate(words)}


class GuessCost:
    """Least cost of guessing a value, as the decimal logarithm of the number of guesses."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks, self.near = ranks, neighbours()

    @staticmethod
    def per_character(c: str) -> float:
        """One character by brute force: the logarithm of its class's size."""
        return 1.0 if c.isdigit() else math.log10(26) if c.isascii() and c.isalpha() else math.log10(33) if c.isascii() else 2.0

    def unit_cost(self, unit: str) -> float:
        """What is repeated: its characters by brute force, or a word of the list."""
        return min(sum(map(self.per_character, unit)), math.log10(self.ranks.get(unit.lower(), 10 ** 9)))

    def cost(self, value: str) -> float:
        """Minimum over all segmentations; a new segment costs a factor of two.

        ``best[i]`` is the least cost of the first ``i`` characters. It follows from an earlier place by a word of the
        list (rank, times two for capitals and two for signs in place of letters), a date, a unit of up to 16 characters repeated, a
        walk over neighbouring keys, or one character more by brute force. Repeats and walks are maximal runs found
        beforehand. In a walk the best start so far is carried along. Of the starts of a repeat one that is no better than an
        earlier one can be forgotten: the logarithm of the times grows slower for the earlier one from then on.
        """
        n = len(value)
        plain, lower = value.lower().translate(LEET), value.lower()
        if len(lower) != n or len(plain) != n:  # a letter whose lower case is longer
            lower = plain = value
        keys = lower.translate(SHIFTED)
        dates: dict[int, list[tuple[int, float]]] = {}
        for start in range(n):
            for form in DATES if value[start].isdigit() else ():
                if m := form.match(value, start):
                    dates.setdefault(m.end(), []).append((start, math.log10(150) if form is DATES[0] else math.log10(365 * 150)))
        repeats: dict[int, list[tuple[int, int]]] = {}  # by end: length of the unit, start of the run
        for size in range(1, min(UNIT_LENGTH, n // 2) + 1):
            for m in re.finditer(b"\x01{%d,}" % size, bytes(map(eq, value, value[size:]))):
                for end in range(m.start() + 2 * size, m.end() + size + 1):
                    repeats.setdefault(end, []).append((size, m.start()))
        starts: dict[tuple[int, int, int], tuple[float, list[int]]] = {}
        best = [0.0] + [math.inf] * n  # ending with a finished segment
        brute = math.inf  # ending inside brute force
        walk, walked = math.inf, 0  # least of a start's cost less its place, in the walk that began there
        for at in range(1, n + 1):
            brute = min(brute, best[at - 1] + LOG2) + self.per_character(value[at - 1])
            least = brute
            for start in range(max(0, at - WORD_LENGTH), at - 2):
                for form, extra in ((lower, LOG2), (plain, 2 * LOG2)):
                    rank = self.ranks.get(form[start:at])
                    if rank:
                        capitals = value[start:at]
                        extra += LOG2 * (capitals != capitals.lower())
                        least = min(least, best[start] + math.log10(rank) + extra)
                        break
            for start, cost in dates.get(at, ()):
                least = min(least, best[start] + cost + LOG2)
            for size, first in repeats.get(at, ()):
                chain = (size, first, at % size)
                if chain not in starts:
                    starts[chain] = self.unit_cost(value[at - size:at]), []
                cost, held = starts[chain]
                lowest, good = math.inf, []
                for start in (*held, at - 2 * size):
                    sum_ = best[start] + math.log10((at - start) // size)
                    if sum_ < lowest:
                        lowest = sum_
                        good.append(start)
                held[:] = good
                least = min(least, lowest + cost + LOG2)
            if at > 1 and keys[at - 1] not in self.near.get(keys[at - 2], ()):
                walk, walked = math.inf, at - 1
            if at - walked >= 3:
                walk = min(walk, best[at - 3] - (at - 3) * LOG2)
                least = min(least, walk + at * LOG2 + math.log10(47))
            best[at] = least
        return best[n]


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the plain patterns; an assignment's value has 6 characters, an access key 20, a hex run 24."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def mixed(value: str) -> bool:
    """More than one word of prose: letters of both cases inside, or letters with digits or signs."""
    return any(not c.isalpha() for c in value) or (value[1:] != value[1:].lower() and value != value.upper())


def latin(value: str) -> str:
    """Letters without accents; those of scripts that the list of words does not cover are left out."""
    return value if value.isascii() else unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode()


class Finder:
    """Plain spans and costly values in credential context."""

    def __init__(self, ranks: dict[str, int], plain_costs: bool = True):
        self.guess, self.plain_costs = GuessCost(ranks), plain_costs

    def costly(self, value: str, cost: float) -> bool:
        if mixed(value):
            return cost >= LEAST_COST
        plain = latin(value)
        cost = cost if plain == value else self.guess.cost(plain)
        return cost >= max(LEAST_LETTERS_COST, LEAST_LETTER_COST * len(plain))

    def spans(self, text: str) -> list[tuple[str, int, int, bool, float]]:
        out, covered = [], []
        for kind, start, end in plain_spans(text):
            cost = None
            if self.plain_costs:
                cost = self.guess.cost(ASSIGN.match(text, start)[2] if kind == "assign" else text[start:end])
            out.append((kind, start, end, False, cost))
            covered.append((start, end))
        if not CLUE.search(text):
            return out
        covered.sort()
        at = 0
        while m := CONTEXT.search(text, at):
            group = m.lastgroup
            start, end = m.span(group)
            at = start  # a value can be the name of the next one
            while start < end and text[start] in EDGES:
                start += 1
            while end > start and text[end - 1] in EDGES:
                end -= 1
            value = text[start:end]
            if len(value) < 4 or any(s < end and start < e for s, e in covered):
                continue
            cost = self.guess.cost(value)
            if self.costly(value, cost):
                out.append(("assign", start, end, True, cost))
                at = m.end(group)
        return out


SPANS = "array<struct<kind:string,start:int,end:int,added:boolean,guesses_log10:double>>"
SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                  ("added", pa.bool_()), ("guesses_log10", pa.float64())]))


def find(docs: DataFrame, words: str, key: str = "doc_id", text: str = "text", plain_costs: bool = True) -> DataFrame:
    """``doc_id, spans`` for every row: secrets in the whole text, by start and then by kind as in ``KINDS``.

    Spans count characters of the text, the end exclusive; an added span is the bare value, of kind ``assign``.
    ``guesses_log10`` is the cost of the value (for ``assign`` without its name); plain spans, which are found
    whatever they cost, have none without ``plain_costs``. ``words`` is the file of a public
    vocabulary whose words count as guessable. Null and empty texts have none; repeated rows come out repeated; other
    columns are not looked at. No shuffle.
    """
    ranks = word_ranks(words)
    order = {kind: at for at, kind in enumerate(KINDS)}

    def run(batches):
        finder = Finder(ranks, plain_costs)
        for part in slices(batches):
            out = []
            for content in part.column("text").to_pylist():
                found = sorted(finder.spans(content), key=lambda x: (x[1], order[x[0]], x[2]))
                out.append([dict(zip(("kind", "start", "end", "added", "guesses_log10"), x)) for x in found])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, SPANS_ARROW)], ["doc_id", "spans"])

    rows = texts(docs, key, text)
    return rows.mapInArrow(run, f"doc_id {key_type(rows)}, spans {SPANS}")
