"""Token counts that follow edits: a tree of counts per document, re-encoded only where a text changed."""

from __future__ import annotations

import base64
import re

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.rows import key_type, slices

# The public pre-token pattern of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters from which a leaf ends at the next border, and from which a leaf grown by edits is cut anew.
LEAF, GROWN = 512, 4096
# A border between pre-tokens whatever stands around it: no pre-token goes on from a sign or letter to white space.
LEAF_END = re.compile(r"[!-~À-ÖØ-öø-ɏ](?=[ \n])")

TREE = "struct<sizes:array<int>,sums:array<int>>"


class Counter:
    """Counts tokens of leaves; a leaf is a run of whole pre-tokens."""

    def __init__(self, ranks: str, pattern: str = PATTERN):
        table = {base64.b64decode(token): int(rank) for token, rank in map(str.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def count(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))

    def leaves(self, text: str) -> list[str]:
        """A text cut into leaves of about ``LEAF`` characters; only one without borders can be longer."""
        ends = [0]
        while found := LEAF_END.search(text, ends[-1] + LEAF):
            ends.append(found.end())
        out = [text[a:b] for a, b in zip(ends, ends[1:])]
        return [*out, text[ends[-1]:]] if ends[-1] < len(text) or not out else out

    def tree(self, text: str) -> tuple[list[int], list[int]]:
        """Leaf lengths, and the sums of a binary tree over leaf counts: node 1 is the root, node i has 2i and 2i + 1."""
        cut = self.leaves(text)
        return [len(leaf) for leaf in cut], sums_over([self.count(leaf) for leaf in cut])

    def edit(self, text: str, sizes: list[int], sums: list[int],
             edits: list[tuple[int, int, str]]) -> tuple[str, list[int], list[int], int]:
        """The edited text, its tree, and how many characters were encoded again.

        A border between leaves holds as long as the characters on both its sides do. The leaves between the nearest
        borders that hold around an edit are counted again as one, in the place of the first of them; the others of
        them become empty, and only the sums above these places change. A leaf that outgrew ``GROWN`` is cut anew,
        with a new tree from the counts of all leaves. ``edits`` are (start, stop, new text) in characters of the old
        text, sorted, without overlaps.
        """
        sizes, sums = list(sizes), list(sums)
        width = len(sums) // 2
        starts, at = [], 0
        for size in sizes:
            starts.append(at)
            at += size
        regions: list[list] = []  # first leaf, last leaf, edits
        leaf = 0
        for start, stop, new in edits:
            while leaf + 1 < len(sizes) and starts[leaf + 1] < start:
                leaf += 1
            first = last = leaf
            while last + 1 < len(sizes) and starts[last + 1] <= stop:
                last += 1
            if regions and first <= regions[-1][1]:
                regions[-1][1] = max(last, regions[-1][1])
                regions[-1][2].append((start, stop, new))
            else:
                regions.append([first, last, [(start, stop, new)]])
        out, done, encoded, grown, counts = [], 0, 0, False, {}
        for first, last, inside in regions:
            low, high = starts[first], starts[last] + sizes[last]
            pieces, at = [], low
            for start, stop, new in inside:
                pieces += (text[at:start], new)
                at = stop
            region = "".join((*pieces, text[at:high]))
            out += (text[done:low], region)
            done = high
            encoded += len(region)
            counts[first] = region
            for place in range(first, last + 1):
                sizes[place] = len(region) if place == first else 0
                node = width + place
                change = (self.count(region) if place == first else 0) - sums[node]
                while node:
                    sums[node] += change
                    node //= 2
            grown |= len(region) > GROWN
        text = "".join((*out, text[done:]))
        if grown:
            sizes, sums = self.cut_anew(text, sizes, sums)
        return text, sizes, sums, encoded

    def cut_anew(self, text: str, sizes: list[int], sums: list[int]) -> tuple[list[int], list[int]]:
        """The same counts over leaves of ordinary length: long leaves are cut, empty ones go."""
        width, at, lengths, counts = len(sums) // 2, 0, [], []
        for place, size in enumerate(sizes):
            if size > GROWN:
                cut = self.leaves(text[at:at + size])
                lengths += map(len, cut)
                counts += map(self.count, cut)
            elif size:
                lengths.append(size)
                counts.append(sums[width + place])
            at += size
        return lengths or [0], sums_over(counts or [0])


def sums_over(counts: list[int]) -> list[int]:
    width = 1 << (len(counts) - 1).bit_length()
    sums = [0] * width + counts + [0] * (width - len(counts))
    for node in range(width - 1, 0, -1):
        sums[node] = sums[2 * node] + sums[2 * node + 1]
    return sums


def rank_file(path: str) -> str:
    """Text of a rank file, read by the driver and sent along with the job."""
    with open(path, encoding="ascii") as file:
        return file.read()


def build(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, text, tree`` and the columns of ``keep``: the tree of counts of every text; ``tree.sums[1]`` is its total.

    Null and empty texts have one empty leaf. Repeated rows come out repeated. No shuffle.
    """
    ranks = rank_file(path)
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *keep)

    def run(batches):
        counter = Counter(ranks)
        for part in slices(batches):
            trees = [counter.tree(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([{"sizes": a, "sums": b} for a, b in trees], TREE_ARROW)],
                [*part.schema.names, "tree"])

    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", tree {TREE}")


TREE_ARROW = pa.struct([("sizes", pa.list_(pa.int32())), ("sums", pa.list_(pa.int32()))])


def apply_edits(trees: DataFrame, path: str, edits: str = "edits") -> DataFrame:
    """``doc_id, text, tree, n_before, n_after, n_encoded``: the texts after their edits, with trees to match.

    ``edits`` is a column of arrays of ``struct<start, stop, new>`` in characters of the text, the stop exclusive. They
    are taken in order of start; one that begins before its predecessor's stop, is null or lies outside the text is an
    error of the caller and is moved inside: starts and stops are kept within the text and after the edit before. A null
    array edits nothing, a null ``new`` is empty. ``n_encoded`` is the number of characters that were encoded again.
    """
    ranks = rank_file(path)
    rows = trees.select("doc_id", "text", "tree", F.col(edits).alias("edits"))

    def tidy(length: int, wanted: list[dict] | None) -> list[tuple[int, int, str]]:
        out, at = [], 0
        for e in sorted((e for e in wanted or [] if e and e["start"] is not None and e["stop"] is not None),
                        key=lambda e: (e["start"], e["stop"])):
            start = min(max(e["start"], at, 0), length)
            at = min(max(e["stop"], start), length)
            out.append((start, at, e["new"] or ""))
        return out

    def run(batches):
        counter = Counter(ranks)
        for part in slices(batches):
            out = []
            for key, content, tree, wanted in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "tree", "edits"))):
                content = content or ""
                done = counter.edit(content, tree["sizes"], tree["sums"], tidy(len(content), wanted))
                out.append((done[0], {"sizes": done[1], "sums": done[2]}, tree["sums"][1], done[2][1], done[3]))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(columns[0], pa.string()), pa.array(columns[1], TREE_ARROW),
                 *[pa.array(c, pa.int64()) for c in columns[2:]]],
                ["doc_id", "text", "tree", "n_before", "n_after", "n_encoded"])

    return rows.mapInArrow(run, f"doc_id {key_type(rows)}, text string, tree {TREE}, n_before long, n_after long, n_encoded long")


def house_edits(text: str = "text", source: str = "source") -> F.Column:
    """Edits of a clean-up job: the first line goes, the source is noted in the middle, the end is put in capitals."""
    body, size = F.coalesce(F.col(text), F.lit("")), F.length(F.coalesce(F.col(text), F.lit("")))
    line = F.locate("\n", body)
    edit = lambda a, b, new: F.struct(a.cast("int").alias("start"), b.cast("int").alias("stop"), new.alias("new"))
    middle = F.greatest(F.floor(size / 2), line)
    last = F.greatest(size - 20, middle)
    return F.array(
        edit(F.lit(0), line, F.lit("")),
        edit(middle, middle, F.concat(F.lit(" ["), F.coalesce(F.col(source), F.lit("")), F.lit("] "))),
        edit(last, size, F.upper(F.substring(body, F.lit(1) + last, size - last))))
