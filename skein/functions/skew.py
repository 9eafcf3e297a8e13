"""Joins that hold when one key owns a large share of the rows, and size-checked broadcasts."""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from skein.session import cut

# Rows looked at in the steps of a probe for size.
PROBE_ROWS = (4_096, 65_536)

# A side is broadcast only when a count over it proved both bounds.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20

# Rows of one key that a single task may sort or join.
GROUP_ROWS = 5_000_000

def row_bytes(df: DataFrame) -> Column:
    """Size of a row: 8 bytes per column of fixed width, the real length of the others."""
    size = F.lit(0)
    for column in df.schema:
        if isinstance(column.dataType, (StringType, BinaryType)):
            width = F.coalesce(F.octet_length(F.col(column.name)), F.lit(0))
        elif isinstance(column.dataType, (ArrayType, MapType, StructType)):
            width = F.coalesce(F.octet_length(F.to_json(F.struct(column.name))), F.lit(0))
        else:
            width = F.lit(8)
        size = size + width
    return size.cast("bigint")


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Does ``df`` stay inside the broadcast bounds? A probe that ends early on a large side.

    Rows are looked at in steps, of which the last is one row more than the bound: Spark runs as many tasks as that takes
    and no more. The driver gets one number a row, its size, so at most 4 MB. Files whose sizes alone are far beyond
    the bound are not opened, unless a filter may still leave little of them.
    """
    if _only_files(df) and _file_bytes(df) > FILES_FACTOR * max_bytes:
        return False
    for rows in (*[n for n in PROBE_ROWS if n < max_rows], max_rows + 1):
        sizes = df.select(row_bytes(df).alias("b")).limit(rows).toArrow().column("b")
        if sizes.length() > max_rows or (sizes.length() and pc.sum(sizes).as_py() > max_bytes):
            return False
        if sizes.length() < rows:
            return True
    return True


# Compressed files hold at least their own size in rows; all columns count, so a few of them may be much less.
FILES_FACTOR = 64


def _nodes(plan) -> list[str]:
    """Names of the nodes of a logical plan."""
    children = plan.children()
    return [plan.nodeName(), *[name for at in range(children.length()) for name in _nodes(children.apply(at))]]


def _only_files(df: DataFrame) -> bool:
    """Is ``df`` all rows of some files, with or without a choice of columns?"""
    names = _nodes(df._jdf.queryExecution().optimizedPlan())
    return {n.split(" ")[0] for n in names} <= {"Project", "LogicalRelation", "Relation", "Union"}


def _file_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_keys(df: DataFrame, keys: list[str], group_rows: int = GROUP_ROWS) -> DataFrame:
    """Keys with more rows than one task should hold, as ``keys + [_n]``, written out.

    Counts are combined on the map side, so measuring a hot key does not itself suffer from it. At most one
    key in ``group_rows`` rows comes back; joins with the written table are planned by its size.
    """
    return cut(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > group_rows))


def lookup(rows: DataFrame, per_key: DataFrame, on: str | list[str], how: str = "inner", **bounds: int) -> DataFrame:
    """Join ``rows`` to ``per_key`` (one row per key) without letting a hot key pile up in one task.

    A ``per_key`` that comes from a grouping or join is written first, once; the probe then reads its files, and only as far as the
    bound. A ``per_key`` found small is broadcast, and ``rows`` is not shuffled. Otherwise both sides are shuffled once, and
    Spark's adaptive join splits the pieces of ``rows`` that are too large for a task by bytes, along map outputs, so equal
    rows are split too (unless they are so few bytes that one task may have them). It can do so as both shuffles feed the join
    directly. ``rows`` is read once either way.
    ``how`` is one of inner, left, left_semi, left_anti.
    """
    on = [on] if isinstance(on, str) else list(on)
    if is_shuffled(per_key):
        per_key = cut(per_key)
    return rows.join(F.broadcast(per_key) if is_small(per_key, **bounds) else per_key, on, how)


def is_shuffled(df: DataFrame) -> bool:
    """Does the plan hold a step that shuffles rows of its own?"""
    shuffling = {"Aggregate", "Window", "Join", "Distinct", "Deduplicate", "Sort", "Repartition", "RepartitionByExpression"}
    return not shuffling.isdisjoint(name.split(" ")[0] for name in _nodes(df._jdf.queryExecution().optimizedPlan()))
