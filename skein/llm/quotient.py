"""Exact duplicates: counting quotient filters per partition, merged, then bytes compared."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.rows import as_bytes, key_type, slices, texts, whole_rows, with_text
from skein.session import cut

# Quotients of the filters (top bits of a 64-bit fingerprint); each is merged on its own.
QUOTIENT_BITS = 12
# Top bits of the fingerprints that the broadcast set of repeated ones tells apart: 2**26 bits are 8 MB,
# whatever the table holds. When more fingerprints share them, more rows are compared; none is missed.
ROUTE_BITS = 26
# Fingerprints one filter takes before it is handed on.
FILTER_ROWS = 1 << 18

FILTER = "quotient int, remainders array<long>, counts array<long>"


def normal(text: bytes) -> bytes:
    """A to Z in lower case; bytes of other characters never fall in that range."""
    return text.lower()


def fingerprint(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big")


def pack(fingerprints: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A filter: per quotient its run of sorted remainders with their counts. Fingerprints are sorted and unique."""
    shift = np.uint64(64 - QUOTIENT_BITS)
    quotients = (fingerprints >> shift).astype(np.int32)
    first = np.flatnonzero(np.append(True, quotients[1:] != quotients[:-1])) if len(quotients) else np.array([], np.int64)
    bounds = pa.array(np.append(first, len(quotients)).astype(np.int32))
    remainders = (fingerprints & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(quotients[first]), pa.ListArray.from_arrays(bounds, pa.array(remainders)),
         pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int64)))],
        ["quotient", "remainders", "counts"])


def filters(docs: DataFrame) -> DataFrame:
    """Counting quotient filters of all texts, one for each partition and ``FILTER_ROWS`` fingerprints."""
    def run(batches):
        held: list[int] = []

        def flush():
            out = pack(*np.unique(np.array(held, np.uint64), return_counts=True))
            held.clear()
            return out

        for part in slices(batches):
            held.extend(fingerprint(hashlib.sha256(normal(t)).digest()) for t in as_bytes(part.column("text")))
            if len(held) >= FILTER_ROWS:
                yield flush()
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, FILTER)


def merged(parts: DataFrame) -> DataFrame:
    """One filter of all: runs of a quotient are merged by remainder, their counts added, nothing is lost.

    A run is as long as the distinct fingerprints of its quotient, however often one of them occurs.
    """
    def run(table: pa.Table) -> pa.Table:
        remainders = np.concatenate([np.asarray(c.flatten(), np.int64) for c in table.column("remainders").chunks])
        counts = np.concatenate([np.asarray(c.flatten(), np.int64) for c in table.column("counts").chunks])
        keys, at = np.unique(remainders, return_inverse=True)
        sums = np.bincount(at, weights=counts, minlength=len(keys)).astype(np.int64)
        quotient = np.uint64(table.column("quotient")[0].as_py()) << np.uint64(64 - QUOTIENT_BITS)
        return pa.Table.from_batches([pack(quotient | keys.astype(np.uint64), sums)])

    return parts.groupBy("quotient").applyInArrow(run, FILTER)


def repeated_bits(whole: DataFrame) -> bytes:
    """Bit set over the top ``ROUTE_BITS`` bits of all fingerprints with a count above one.

    Every quotient sends its own stretch of the set, so the driver gets the set once: 8 MB at most.
    """
    low = ROUTE_BITS - QUOTIENT_BITS
    width = (1 << low) // 8

    def run(batches):
        for part in batches:
            out = []
            for remainders, counts in zip(part.column("remainders"), part.column("counts")):
                keys = np.asarray(remainders.values, np.int64)[np.asarray(counts.values) > 1]
                bits = np.zeros(1 << low, np.uint8)
                bits[keys >> (64 - ROUTE_BITS)] = 1
                out.append(np.packbits(bits, bitorder="little").tobytes() if len(keys) else None)
            yield pa.RecordBatch.from_arrays([part.column("quotient"), pa.array(out, pa.binary())], ["quotient", "bits"])

    bits = bytearray(width << QUOTIENT_BITS)
    for row in whole.mapInArrow(run, "quotient int, bits binary").filter("bits is not null").toLocalIterator():
        bits[row["quotient"] * width:(row["quotient"] + 1) * width] = row["bits"]
    return bytes(bits)


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", rows: bool = False) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row; with ``rows`` also the row as ``row``.

    Texts are equal when identical after lower-casing A to Z; null counts as empty. Of equal texts the row
    with the largest ``doc_id`` stays, a null one last; of rows that also share it, exactly one. Other
    columns are not looked at, whatever their names. An empty table gives no rows.

    Fingerprints are counted in quotient filters per partition. Only rows whose fingerprint may occur
    twice move at all: their whole texts are grouped, with the copies of a task combined before the shuffle,
    so a text owning a third of all rows is one row per task. Size and kept row of a class are then counted and joined back
    by digest, without the texts; only rows whose digest turned out to stand for several texts go by the text itself.
    Both sides come straight from tables, so Spark splits a class that is too large for a task.
    """
    bits = repeated_bits(merged(filters(texts(docs, key, text))))
    named = whole_rows(docs, key) if rows else texts(docs, key, text)

    def run(batches):
        at = 64 - ROUTE_BITS
        for part in slices(with_text(batches, text) if rows else batches):
            hashes, routed = [], []
            for content in as_bytes(part.column("text")):
                digest = hashlib.sha256(content := normal(content))
                place = fingerprint(digest.digest()) >> at
                hashes.append(digest.hexdigest())
                routed.append(content if bits[place >> 3] >> (place & 7) & 1 else None)
            arrays = [part.column("doc_id"), pa.array(hashes), pa.array(routed, pa.binary()).cast(pa.string())]
            if rows:
                arrays.append(part.column("row"))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_sha256", "routed", "row"][:len(arrays)])

    schema = f"doc_id {key_type(named)}, text_sha256 string, routed string"
    if rows:
        schema += f", row {key_type(named, 'row')}"
    marked = cut(named.mapInArrow(run, schema).withColumn("tag", F.monotonically_increasing_id()))
    payload = ["row"] if rows else []
    slim = ["doc_id", "text_sha256", "tag", *payload]
    single = marked.filter("routed is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", *payload)
    many = marked.filter("routed is not null")
    # Bytes decide: a digest that stands for several texts is looked up by its texts, all others by the digest alone.
    several = cut(many.groupBy("text_sha256", "routed").agg(F.count(F.lit(1)).alias("n")).groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").select("text_sha256"))
    collided = not several.isEmpty()
    plain = many.join(several, "text_sha256", "left_anti") if collided else many
    verified = _classed(plain, ["text_sha256"], slim)
    if collided:
        verified = verified.unionByName(_classed(many.join(several, "text_sha256", "left_semi"), ["text_sha256", "routed"], slim))
    return single.unionByName(verified)


def _classed(rows: DataFrame, same: list[str], slim: list[str]) -> DataFrame:
    """Size and kept row of the class of every row; texts are read only where ``same`` names them."""
    classes = cut(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "tag")).alias("keep")))
    return rows.select(*dict.fromkeys([*slim, *same])).join(classes, same).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("tag") == F.col("keep.tag")).alias("kept"), "text_sha256", *[c for c in slim if c == "row"])
