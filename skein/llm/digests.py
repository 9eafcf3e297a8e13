"""SHA-256 of sequences that may be longer than a task can hold."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def run_digests(pieces: DataFrame, keys: list[str], order: list[str], piece: str, separator: str,
                name: str = "digest") -> DataFrame:
    """``keys`` and the lower-case SHA-256 hex of each key's pieces, in ``order``, joined by ``separator``.

    The digest is one pass over the bytes in order, so a key's pieces meet in one task; they stream through it, sorted by
    Spark, and are never gathered. Callers join short values to longer pieces first. Keys must not be null; a null piece
    counts as empty; keys without rows have no digest.
    """
    fields = ", ".join(f"{k} {pieces.schema[k].dataType.simpleString()}" for k in keys)
    placed = pieces.select(*keys, *order, piece).repartition(*keys).sortWithinPartitions(*keys, *order)
    return placed.select(*keys, piece).mapInArrow(_hasher(keys, piece, separator.encode(), name), f"{fields}, {name} string")


def _hasher(keys: list[str], piece: str, separator: bytes, name: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = state = None
        for batch in batches:
            done = []
            for *key, value in zip(*[batch.column(k).to_pylist() for k in keys], batch.column(piece).cast(pa.binary())):
                if key != current:
                    if current is not None:
                        done.append([*current, state.hexdigest()])
                    current, state = key, hashlib.sha256()
                else:
                    state.update(separator)
                state.update(value.as_buffer() or b"")
            yield _table(done, batch.schema)
        if current is not None:
            yield _table([[*current, state.hexdigest()]], batch.schema)

    def _table(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
        columns = [pa.array([r[at] for r in rows], schema.field(k).type) for at, k in enumerate(keys)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([r[-1] for r in rows], pa.string())], [*keys, name])

    return run
