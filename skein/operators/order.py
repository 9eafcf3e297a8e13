"""Top-k, extremes, row numbers and previous rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from skein.functions.skew import GROUP_ROWS, hot_keys
from skein.session import cut

# Rows per block when one ordered sequence is cut over many tasks.
BLOCK_ROWS = 1_000_000


def top_k(df: DataFrame, measure: str | Column, k: int, ties: list[str | Column]) -> DataFrame:
    """``k`` rows with the greatest measure; equal measures follow ``ties``. No full sort is made."""
    measure = F.col(measure) if isinstance(measure, str) else measure
    return df.orderBy(measure.desc(), *ties).limit(k)


def arg_extreme(df: DataFrame, measure: str | Column, how: str, tie_order: str) -> DataFrame:
    """The row with the greatest or least measure, the first in order when several tie."""
    measure = F.col(measure) if isinstance(measure, str) else measure
    direction = {"max": measure.desc_nulls_last(), "min": measure.asc_nulls_last()}[how]
    return df.orderBy(direction, tie_order).limit(1)


def with_row_index(df: DataFrame, order: list[str | Column], name: str = "row_index",
                   keep: list[str] | None = None) -> DataFrame:
    """Number all rows from 0 in the given total order, without a single-task window.

    ``keep`` names the columns still wanted once the order is settled; all by default.

    One range shuffle places and sorts the rows, the placed table is written, and each partition then
    adds the row count of the partitions before it. The offsets hold one row per partition, so
    broadcasting them is bounded by the shuffle width.
    """
    placed = cut(
        df.orderBy(*order).select(
            *(keep or ["*"]),
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_row"),
        )
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_row") + F.col("_offset"))
        .drop("_part", "_row", "_offset")
    )


def previous_value(df: DataFrame, value: str, order: list[str], key: str | None = None,
                   name: str = "previous", group_rows: int = GROUP_ROWS,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Value of the row before, in ``order`` within ``key`` (or among all rows); null for the first.

    Ordinary keys use a window. Hot keys, and the case without a key, are cut into blocks of equal
    size along a global row index, so that no task holds a whole sequence.
    """
    if key is None:
        return _previous_in_blocks(df, value, order, None, name, block_rows)
    plain = Window.partitionBy(key).orderBy(*order)
    hot = hot_keys(df, [key], group_rows)
    if hot.isEmpty():
        return df.withColumn(name, F.lag(value).over(plain))
    hot = hot.select(F.col(key).alias("_hot"))
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    ordinary = df.join(hot, is_hot, "left_anti").withColumn(name, F.lag(value).over(plain))
    split = _previous_in_blocks(df.join(hot, is_hot, "left_semi"), value, order, key, name, block_rows)
    return ordinary.unionByName(split)


def _previous_in_blocks(df: DataFrame, value: str, order: list[str], key: str | None, name: str,
                        block_rows: int) -> DataFrame:
    same_key = F.col(key) if key else F.lit(0)
    indexed = with_row_index(df, [*([key] if key else []), *order], "_index").withColumn(
        "_block", F.floor(F.col("_index") / block_rows))
    carried = F.struct(same_key.alias("k"), F.col(value).alias("v"))
    inside = indexed.withColumn(
        "_lagged", F.lag(carried).over(Window.partitionBy("_block").orderBy("_index")))
    edges = indexed.filter(F.col("_index") % block_rows == block_rows - 1).select(
        (F.col("_block") + 1).alias("_block"), carried.alias("_edge"))
    before = F.coalesce("_lagged", "_edge")
    return (
        inside.join(edges, "_block", "left")
        .withColumn(name, F.when(before["k"].eqNullSafe(same_key), before["v"]))
        .drop("_index", "_block", "_lagged", "_edge")
    )


def day_of(df: DataFrame, time: str, zone: str = "UTC") -> Column:
    """Calendar day of a time column: of an instant in ``zone``, whatever the session's zone; of a wall time its own."""
    if df.schema[time].dataType != TimestampType():
        return F.col(time).cast("date")
    return F.convert_timezone(F.current_timezone(), F.lit(zone), F.col(time).cast("timestamp_ntz")).cast("date")


def advanced_since_previous(df: DataFrame, time: str, order: list[str], key: str | None = None,
                            name: str = "previous_date", zone: str = "UTC", **sizes: int) -> DataFrame:
    """Rows whose calendar day is later than that of the row before, with both days."""
    dated = df.withColumn("event_date", day_of(df, time, zone))
    return previous_value(dated, "event_date", order, key, name, **sizes).filter(
        F.col(name) < F.col("event_date"))


def first_ranks(df: DataFrame, key: str, order: list[str], start: int, stop: int) -> DataFrame:
    """Rows ``start`` to ``stop`` (from 1) of every key, with their rank as ``_rank``.

    A row's rank is its place in one global row index less that of its key's first row: one range shuffle, which
    splits any key, whatever ``stop`` is. One row per key is joined back.
    """
    indexed = with_row_index(df, [key, *order], "_index")
    first = indexed.groupBy(key).agg(F.min("_index").alias("_first")).withColumnRenamed(key, "_key")
    first = cut(first)
    rank = F.col("_index") - F.col("_first") + 1
    joined = indexed.join(first, F.col(key).eqNullSafe(F.col("_key")))
    return joined.withColumn("_rank", rank).filter(F.col("_rank").between(start, stop)).drop("_index", "_first", "_key")
