"""Positional inverted index over documents, with exact phrase and proximity search."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.rows import as_bytes, key_type, slices, texts
from skein.session import cut

WINDOW = 13
# Bytes of text in one segment of the index; a longer document is a segment of its own.
SEGMENT_BYTES = 2 << 20
# Postings of a segment that are handed to Spark at once; a more frequent term comes alone.
PIECE_POSTINGS = 1 << 16
# Free positions between documents, so that no phrase runs from one into the next.
GAP = 256
# Words of queries searched for in one pass over the index; it bounds what is sent to the tasks.
BLOCK_WORDS = 1 << 20
# Places looked at in one step of a search.
STEP = 1 << 20

# Everything but a-z, 0-9 and the bytes of characters beyond ASCII separates words.
SEPARATORS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words(text: bytes) -> list[bytes]:
    """Words in lower case (A to Z only)."""
    return text.lower().translate(SEPARATORS).split()


def build(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index as a table: ``segment, term, gaps`` and, once per segment, ``segment, docs``.

    ``gaps`` are the differences between a term's positions in its segment; ``docs`` lists key and
    number of words of the segment's documents, ``GAP`` positions apart. A segment is a run of documents of one
    partition, so nothing is shuffled, and no list of postings outgrows a segment however frequent the
    term. Null and empty texts are documents without words. Repeated rows are documents of their own.
    """
    rows = texts(docs, key, text)
    schema = f"segment long, term string, gaps array<int>, docs array<struct<doc_id:{key_type(rows)},n_words:int>>"

    def run(batches):
        number = count(TaskContext.get().partitionId() << 32)
        for part in slices(batches, limit=SEGMENT_BYTES):
            yield from segment(next(number), part)

    def segment(number: int, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids: defaultdict[bytes, int] = defaultdict(count().__next__)
        numbers, lengths = [], []
        for content in as_bytes(part.column("text")):
            found = words(content)
            lengths.append(len(found))
            numbers.append(np.fromiter(map(ids.__getitem__, found), np.int32, len(found)))
        flat = np.concatenate(numbers)
        sizes = np.array(lengths)
        starts = GAP + np.cumsum(sizes + GAP) - sizes - GAP
        at = np.arange(len(flat)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        order = np.argsort(flat, kind="stable")
        at = at[order]
        bounds = np.append(0, np.cumsum(np.bincount(flat, minlength=len(ids))))
        gaps = np.diff(at, prepend=0)
        gaps[bounds[:-1]] = at[bounds[:-1]]
        names = ["segment", "term", "gaps", "docs"]
        doc_type = pa.list_(pa.struct([("doc_id", part.column("doc_id").type), ("n_words", pa.int32())]))
        held = pa.StructArray.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int32())], ["doc_id", "n_words"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.int32())),
             pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), held).cast(doc_type)], names)
        spelled = list(ids)
        pieces = np.append(0, np.flatnonzero(np.diff(bounds[1:] // PIECE_POSTINGS)) + 1)
        for first, last in zip(pieces, np.append(pieces[1:], len(ids))):
            n, part_bounds = last - first, bounds[first:last + 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, number)), pa.array(spelled[first:last], pa.binary()).cast(pa.string()),
                 pa.ListArray.from_arrays(pa.array(part_bounds - part_bounds[0], pa.int32()),
                                          pa.array(gaps[part_bounds[0]:part_bounds[-1]], pa.int32())),
                 pa.nulls(n, doc_type)], names)

    return cut(rows.mapInArrow(run, schema))


class Phrases:
    """A block of queries as distinct windows over numbered terms."""

    def __init__(self, queries: list[tuple[str, list[bytes]]], window: int):
        self.terms: dict[str, int] = {}
        cuts: dict[tuple[int, ...], list[int]] = {}
        self.ids = [q for q, _ in queries]
        for at, (_, found) in enumerate(queries):
            numbers = [self.terms.setdefault(w.decode(), len(self.terms)) for w in found]
            for start in range(max(1, len(numbers) - window + 1) if numbers else 0):
                owners = cuts.setdefault(tuple(numbers[start:start + window]), [])
                if not owners or owners[-1] != at:
                    owners.append(at)
        self.lengths = np.array([len(c) for c in cuts], np.int64)
        # Short windows are filled up with -1, which any place satisfies.
        self.windows = np.full((len(cuts), window), -1, np.int64)
        for at, numbers in enumerate(cuts):
            self.windows[at, :len(numbers)] = numbers
        self.owners = list(cuts.values())


class Postings:
    """The postings of a block's terms in one segment."""

    def __init__(self, phrases: Phrases, terms: list[str], bounds: np.ndarray, gaps: np.ndarray, sizes: np.ndarray):
        numbers = np.array([phrases.terms[t] for t in terms], np.int64)
        counts = np.diff(bounds)
        total = np.cumsum(gaps)
        before = np.repeat(np.append(0, total)[bounds[:-1]], counts)
        keys = (np.repeat(numbers, counts) << 32) + total - before
        keys.sort()
        self.phrases, self.keys = phrases, keys
        self.counts = np.zeros(len(phrases.terms) + 1, np.int64)
        self.counts[numbers] = counts
        self.first = np.append(0, np.cumsum(self.counts[:-1]))
        self.starts = GAP + np.cumsum(sizes + GAP) - sizes - GAP
        self.end = int(self.starts[-1] + sizes[-1] + GAP) if len(sizes) else GAP

    def search(self, slop: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Windows and the positions where they occur, in steps.

        The postings of a window's rarest term are shifted to the window's start; those without the next
        rarer term at its own offset (give or take ``slop``) go, and so on to the most frequent term.
        """
        windows = self.phrases.windows
        counts = np.where(windows >= 0, self.counts[windows], 1 << 40)
        live = np.flatnonzero(counts.min(axis=1) > 0) if len(windows) else np.zeros(0, np.int64)
        if not len(live):
            return
        order = np.argsort(counts[live], axis=1, kind="stable")
        rarest = order[:, 0]
        load = np.cumsum(counts[live, rarest])
        block = load // STEP
        for number in np.unique(block):
            inside = np.flatnonzero(block == number)
            yield from self._step(live[inside], order[inside], slop)

    def _step(self, live: np.ndarray, order: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        windows = self.phrases.windows
        terms = windows[live, order[:, 0]]
        sizes = self.counts[terms]
        which = np.repeat(np.arange(len(live)), sizes)
        places = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.first[terms][which]
        start = (self.keys[places] & 0xFFFFFFFF) - order[which, 0]
        for rank in range(1, order.shape[1]):
            offset = order[which, rank]
            term = windows[live[which], offset]
            wanted = (term << 32) + start + offset
            at = np.minimum(np.searchsorted(self.keys, wanted - slop), len(self.keys) - 1)
            good = (term < 0) | ((self.keys[at] >= wanted - slop) & (self.keys[at] <= wanted + slop))
            which, start = which[good], start[good]
        if len(which):
            yield live[which], start

    def document(self, position: np.ndarray) -> np.ndarray:
        """Number in the segment of the document that holds a position."""
        return np.searchsorted(self.starts, position, side="right") - 1


def query_blocks(queries: DataFrame, key: str, text: str, window: int) -> Iterator[Phrases]:
    """The queries in blocks of at most ``BLOCK_WORDS`` words (one longer query alone)."""
    block, size = [], 0
    for row in queries.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("t")).toLocalIterator():
        found = words((row["t"] or "").encode())
        if block and size + len(found) > BLOCK_WORDS:
            yield Phrases(block, window)
            block, size = [], 0
        block.append(("null" if row["k"] is None else row["k"], found))
        size += len(found)
    if block:
        yield Phrases(block, window)


def _per_segment(index: DataFrame, phrases: Phrases, schema: str, found) -> DataFrame:
    """Run ``found`` once per segment on the postings of the block's terms."""
    spark = index.sparkSession
    terms = spark.createDataFrame([(t,) for t in phrases.terms], "wanted string")
    posted = index.filter("term is not null").join(F.broadcast(terms), F.col("term") == F.col("wanted"), "left_semi")
    rows = posted.unionByName(index.filter("term is null"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        is_docs = np.asarray(table.column("term").is_null())
        docs = table.filter(pa.array(is_docs)).column("docs").combine_chunks().flatten()
        posts = table.filter(pa.array(~is_docs))
        gaps = posts.column("gaps").combine_chunks()
        lists = gaps.chunk(0) if isinstance(gaps, pa.ChunkedArray) else gaps
        sizes = np.asarray(docs.field("n_words"), np.int64)
        bounds = np.append(0, np.cumsum(np.asarray(lists.value_lengths(), np.int64)))
        postings = Postings(phrases, posts.column("term").to_pylist(), bounds,
                            np.asarray(lists.flatten(), np.int64), sizes)
        return found(postings, table.column("segment")[0].as_py(), docs)

    return rows.groupBy("segment").applyInArrow(run, schema)


def matches(index: DataFrame, queries: DataFrame, key: str, text: str = "text", window: int = WINDOW,
            slop: int = 0) -> DataFrame:
    """``doc_id, query_id, query_words, doc_at``: where windows of the queries' words occur.

    A window is ``window`` consecutive words of a query; a query of fewer, but not none, is one. With ``slop`` 0
    these are exact phrases, otherwise proximity matches: every word stands within ``slop`` (at most half of
    ``GAP``) of its place, counted from the window's rarest word in the segment. ``query_id`` is text, null as
    ``null``. Queries are searched in blocks against the whole index; nothing is cut off.
    """
    doc_type = index.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, query_id string, query_words int, doc_at int"
    out = index.sparkSession.createDataFrame([], schema)
    if not 0 <= slop <= GAP // 2:
        raise ValueError(f"slop must be from 0 to {GAP // 2}")
    for phrases in query_blocks(queries, key, text, window):
        def found(postings, segment, docs, phrases=phrases):
            arrays = [[], [], [], []]
            for which, start in postings.search(slop):
                doc = postings.document(start if slop == 0 else start + slop)
                for w, d, s in zip(which.tolist(), doc.tolist(), start.tolist()):
                    for owner in phrases.owners[w]:
                        arrays[0].append(d)
                        arrays[1].append(phrases.ids[owner])
                        arrays[2].append(int(phrases.lengths[w]))
                        arrays[3].append(s - int(postings.starts[d]))
            return pa.Table.from_arrays(
                [docs.field("doc_id").take(pa.array(arrays[0], pa.int64())), pa.array(arrays[1], pa.string()),
                 pa.array(arrays[2], pa.int32()), pa.array(arrays[3], pa.int32())],
                ["doc_id", "query_id", "query_words", "doc_at"])
        out = out.unionByName(_per_segment(index, phrases, schema, found))
    return out


def coverage(index: DataFrame, queries: DataFrame, key: str, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, hits, items`` for every document of the index: how much of it the queries cover.

    ``hits`` are the positions of words inside any occurrence of a window (see :func:`matches`), ``items`` the ids
    of the queries with occurring windows, both empty where nothing occurs. A document lies in one segment, so its
    matches are put together in the task that finds them; only blocks of queries meet in a small aggregate.
    """
    doc_type = index.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()
    schema = "segment long, at int, hits array<int>, items array<string>"
    every = index.filter("term is null").select("segment", F.posexplode("docs").alias("at", "doc"))
    parts = every.select("segment", "at", F.lit(None).cast("array<int>").alias("hits"),
                         F.lit(None).cast("array<string>").alias("items"), "doc")
    for phrases in query_blocks(queries, key, text, window):
        def found(postings, segment, docs, phrases=phrases):
            delta = np.zeros(postings.end + 1, np.int32)
            pairs = []
            n_windows = max(1, len(phrases.owners))
            for which, start in postings.search():
                np.add.at(delta, start, 1)
                np.add.at(delta, start + phrases.lengths[which], -1)
                pairs.append(np.unique(postings.document(start) * n_windows + which))
            hit = np.flatnonzero(np.cumsum(delta) > 0)
            owner = postings.document(hit)
            items: dict[int, set[str]] = {}
            for pair in np.unique(np.concatenate(pairs)).tolist() if pairs else []:
                doc, which = divmod(pair, n_windows)
                items.setdefault(doc, set()).update(phrases.ids[q] for q in phrases.owners[which])
            places = list(items)
            lists = [(hit[np.searchsorted(owner, d):np.searchsorted(owner, d, side="right")] - postings.starts[d]).tolist()
                     for d in places]
            return pa.Table.from_arrays(
                [pa.array(np.full(len(places), segment)), pa.array(places, pa.int32()),
                 pa.array(lists, pa.list_(pa.int32())), pa.array([list(items[d]) for d in places], pa.list_(pa.string()))],
                ["segment", "at", "hits", "items"])
        block = _per_segment(index, phrases, schema, found)
        parts = parts.unionByName(block.withColumn("doc", F.lit(None).cast(f"struct<doc_id:{doc_type},n_words:int>")))
    return parts.groupBy("segment", "at").agg(
        F.first("doc", ignorenulls=True).alias("doc"),
        F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    ).select("doc.doc_id", F.col("doc.n_words").cast("long").alias("n_words"), "hits", "items")


def contamination(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text",
                  query_key: str = "item_id", query_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    A document is contaminated when at least one word in twenty lies inside a window of a query. An empty
    table of queries leaves all documents clean; a query without words has no window.
    """
    found = coverage(build(docs, key, text), queries, query_key, query_text, window)
    n_hit = F.size("hits").cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))
