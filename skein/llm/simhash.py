"""SimHash near-duplicates: pigeonring chains over segments, then the whole distance."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.components import components
from skein.llm.rows import as_bytes, key_type, slices, texts, whole_rows, with_text
from skein.session import cut

SHINGLE = 3
LIMIT = 2
SEED = 42
BITS = 64
# Shingles counted in one step.
STEP = 1 << 14
# Values under one key that are compared with each other; larger groups are split by further bits first.
PAIRED = 64


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """Hashes of all runs of ``shingle`` words joined by a space, of the whole sequence where there are fewer words."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    stops = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.append(0, stops[:-1] + 1)
    size = min(shingle, len(found))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(
        starts[:len(found) - size + 1].tolist(), stops[size - 1:].tolist())], "<u8")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes; 0 without words."""
    hashes = shingle_hashes(text, shingle)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), STEP):
        ones += np.unpackbits(hashes[at:at + STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                 rows: bool = False) -> DataFrame:
    """``doc_id, fingerprint`` (a long holding the 64 bits) of every row, with ``rows`` also the row as ``row``; no shuffle."""
    named = whole_rows(docs, key) if rows else texts(docs, key, text)

    def run(batches):
        for piece in slices(with_text(batches, text) if rows else batches):
            contents = as_bytes(piece.column("text"))
            out = np.array([fingerprint(t, shingle) for t in contents], np.uint64).view(np.int64)
            columns = {"doc_id": piece.column("doc_id"), "fingerprint": pa.array(out)}
            if rows:
                columns["row"] = piece.column("row")
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return named.mapInArrow(run, f"doc_id {key_type(named)}, fingerprint long"
                            + (f", row {key_type(named, 'row')}" if rows else ""))


def segments(limit: int) -> list[tuple[int, int]]:
    """The ring: ``limit + 1`` segments of nearly equal width, as (lowest bit, width)."""
    count = limit + 1
    edges = [BITS * at // count for at in range(count + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def ones(low: int, width: int) -> int:
    return ((1 << width) - 1) << low


def chain_masks(limit: int) -> list[int]:
    """Bits of which two fingerprints at ``limit`` or fewer differing bits agree in at least one set.

    By the pigeonring principle some segment starts a chain in which each run of ``l`` segments differs in at most
    ``l * limit / (limit + 1)`` bits, rounded down: the first segment is equal, and the first two differ in one bit at
    most, so one half of the second is equal too. A set is the first segment and that half.
    """
    ring = segments(limit)
    if len(ring) == 1:
        return [ones(*ring[0])]
    masks = []
    for at, first in enumerate(ring):
        low, width = ring[(at + 1) % len(ring)]
        masks += [ones(*first) | ones(low, width // 2), ones(*first) | ones(low + width // 2, width - width // 2)]
    return list(dict.fromkeys(masks))


def finer_masks(mask: int, limit: int) -> list[int]:
    """The bits outside a mask, cut into ``limit + 1`` parts of which two close values agree in one; each added to the mask."""
    rest = [bit for bit in range(BITS) if not mask >> bit & 1]
    count = limit + 1
    parts = [rest[len(rest) * at // count:len(rest) * (at + 1) // count] for at in range(count)]
    return [mask | sum(1 << bit for bit in part) for part in parts if part]


def in_budget(differ: Column, limit: int) -> Column:
    """Does some chain of consecutive segments stay within its budgets, all the way round, which is the whole distance?"""
    counts = [F.bit_count(differ.bitwiseAND(F.lit(signed(ones(*segment))))) for segment in segments(limit)]
    n = len(counts)
    chains = []
    for start in range(n):
        within, total = [], F.lit(0)
        for length in range(1, n + 1):
            total = total + counts[(start + length - 1) % n]
            within.append(total <= length * limit // n)
        chains.append(reduce(Column.__and__, within))
    return reduce(Column.__or__, chains)


def links(values: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``one, two``: all pairs of distinct ``fingerprint`` values at ``limit`` or fewer differing bits.

    Values meet under the keys of :func:`chain_masks`. Under a key of up to ``PAIRED`` values each two are tested: the
    differences of some chain of consecutive segments must stay within its budgets, the last of which is the whole distance;
    only pairs that pass leave the task. A key with more values is split: its values meet again under the key and one part more of the other
    bits, of which close values agree in one. That ends, as ``n`` free bits tell at most ``2 ** n`` values apart, so
    no group is ever paired that is larger, however many values share a key, and none is left out. A value has
    few others within ``limit`` bits (2,080 for 2), which bounds the links.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")
    spark, masks = values.sparkSession, chain_masks(limit)
    # A larger group has more than ``limit`` free bits, so every part of them holds one.
    paired = max(PAIRED, 1 << limit)
    met = values.select("fingerprint", F.explode(F.array(*[F.lit(signed(m)) for m in masks])).alias("mask"))
    found = []
    while masks:
        met = met.withColumn("part", F.col("fingerprint").bitwiseAND(F.col("mask")))
        sizes = cut(met.groupBy("mask", "part").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
        few = met.join(sizes.filter(F.col("n") <= paired).drop("n"), ["mask", "part"]).groupBy("mask", "part").agg(
            F.collect_list("fingerprint").alias("all"))
        close = lambda a, b: (b > a) & in_budget(a.bitwiseXOR(b), limit)
        pairs = F.flatten(F.transform("all", lambda a: F.transform(
            F.filter("all", lambda b: close(a, b)), lambda b: F.struct(a.alias("one"), b.alias("two")))))
        found.append(cut(few.select(F.explode(pairs).alias("x")).select("x.*")))
        many = sizes.filter(F.col("n") > paired).drop("n")
        finer = [(m, f) for m in masks for f in finer_masks(m, limit)]
        masks = list(dict.fromkeys(f for _, f in finer)) if not many.isEmpty() else []
        if masks:
            # As many rows as there are ways to choose bits, whatever the data.
            steps = spark.createDataFrame([(signed(m), signed(f)) for m, f in finer], "mask long, finer long")
            met = cut(met.join(many, ["mask", "part"]).join(F.broadcast(steps), "mask").select(
                "fingerprint", F.col("finer").alias("mask")).distinct())
    return reduce(DataFrame.union, found)


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                limit: int = LIMIT, rows: bool = False) -> DataFrame:
    """``doc_id, fingerprint, component_id, kept`` for every row, with ``rows`` also the row as ``row``.

    Fingerprints come as 16 hex digits. Words are runs without ASCII white space, A to Z in lower case; shingles are
    ``shingle`` words joined by a space, the whole sequence where there are fewer. Texts without words (null, empty)
    have fingerprint zero and are linked like any other. ``component_id`` is the smallest ``doc_id`` reachable over links,
    a null one only where there is no other; one row that has it is ``kept``. Repeated rows come out repeated; other
    columns are not looked at.

    Copies are reduced to one fingerprint with a map-side minimum before any comparison, and get their component
    back by a join of two written tables, which Spark splits where one fingerprint owns very many rows.
    """
    every = cut(fingerprints(docs, key, text, shingle, rows).withColumn("tag", F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "tag"))
    distinct = cut(every.groupBy("fingerprint").agg(first.alias("first")))
    roots = components(links(distinct.select("fingerprint"), limit))
    rooted = cut(distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")))
    # A root of very many fingerprints is combined on the map side, then joined back to them.
    least = cut(rooted.groupBy("root").agg(F.min("first").alias("least")))
    named = cut(rooted.join(least, "root").select(
        "fingerprint", F.col("least.doc_id").alias("component_id"), F.col("least.tag").alias("kept_tag")))
    return every.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("tag") == F.col("kept_tag")).alias("kept"), *(["row"] if rows else []))
