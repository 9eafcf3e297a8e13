"""Handing rows to Python tasks in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of text one step of a Python task works on; a longer text is a step of its own.
SLICE_BYTES = 2 << 20


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text only, as ``doc_id`` and ``text``; a null text becomes an empty one."""
    return docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def whole_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id`` and the whole row as ``row``; its text travels once and is taken out by :func:`with_text`."""
    return docs.select(F.col(key).alias("doc_id"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))


def with_text(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches with the text of their rows as a column of its own, which shares the rows' memory."""
    for batch in batches:
        rows = batch.column("row")
        yield batch.append_column("text", rows.field(rows.type.get_field_index(text)).cast(pa.string()))


def key_type(df: DataFrame, key: str = "doc_id") -> str:
    """Type of a column, as text for a schema."""
    return df.schema[key].dataType.simpleString()


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows holding at most ``limit`` bytes in ``column``; a longer row comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        start = held = 0
        for at, n in enumerate(sizes.tolist()):
            if at > start and held + n > limit:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += n
        yield batch.slice(start)


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def without(docs: DataFrame, dropped: DataFrame, key: Column, dropped_key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose key is not in ``dropped``; columns of ``docs`` only, null keys compare equal."""
    ids = dropped.select(F.col(dropped_key).alias("__dropped_key"))
    return docs.join(ids, key.eqNullSafe(ids["__dropped_key"]), "left_anti")
