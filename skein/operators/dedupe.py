"""Greedy removal of duplicates over several keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.session import cut, write_cut

# Rounds that only look for rows nothing can block, before chains are settled as well.
PLAIN_ROUNDS = 4


def comparable(key: str) -> Column:
    """Key as text in which a missing value equals another missing value."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-"))


def kept_positions(df: DataFrame, keys: list[str], order: str, plain_rounds: int = PLAIN_ROUNDS) -> DataFrame:
    """Positions kept by a walk in ``order`` that skips a row sharing any key with a kept row.

    ``order`` must be unique. Each round keeps the
    rows that come first under all of their keys (nothing before them can block them), then removes every row
    sharing a key with a kept one. The first remaining row is always kept, so the rounds end, and each costs by what is left.
    What ``PLAIN_ROUNDS`` rounds leave is mostly chains of rows blocking each other; from then on a round also settles
    whole chains at once, see :func:`_chains`. Keys travel as two hashes of 64 bits each. Firsts are minima combined on the map side and meet on the unique position. Each round is written out, so a lost
    executor repeats one round at most, and removals join two written tables: Spark broadcasts the kept keys by the
    size of their files, or shuffles both sides once and splits a key with very many rows.
    """
    spark = df.sparkSession
    narrow = [F.struct(F.xxhash64(F.lit(1), comparable(k)).alias("a"), F.xxhash64(F.lit(2), comparable(k)).alias("b")).alias(k)
              for k in keys]
    left = cut(df.select(order, *narrow))
    schema = left.schema
    kept_folders = []
    while True:
        if len(kept_folders) < plain_rounds:
            firsts = [
                left.groupBy(k).agg(F.min(F.struct(order, *[o for o in keys if o != k])).alias("_first"))
                .select("_first.*", k).select(schema.names)
                for k in keys
            ]
            kept = reduce(lambda one, other: one.join(other.select(order), order, "left_semi"), firsts)
        else:
            settled = _chains(left, keys, order)
            kept = left.join(settled.filter("kept").select(order), order, "left_semi")
            left = left.join(settled.filter("not kept").select(order), order, "left_anti")
        kept_folders.append(write_cut(kept.select(schema.names)))
        kept = spark.read.schema(schema).parquet(kept_folders[-1])
        for k in keys:  # kept rows never share a key, so each has one row per key
            left = left.join(kept.select(k), k, "left_anti")
        left = cut(left)
        if left.isEmpty():
            return spark.read.schema(schema).parquet(*kept_folders).select(order)


def _chains(left: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``order, kept`` of rows whose fate hangs on a chain of single blockers.

    A row is blocked by the rows before it that share a key. The first of a key has none there, the second exactly one,
    the first. A row without any is kept. A row with exactly one over all its keys is kept if that one is not, so it points to it with
    parity one; pointers are doubled, adding parities, until they end at a row without blockers (which settles them) or at
    one with several (which leaves them for a later round). A chain of n rows takes log n doublings. First and second are minima combined
    on the map side; joins on a key start from written tables, so Spark splits a key with very many rows, and pointers meet
    on the unique position.
    """
    for k in keys:
        first = cut(left.groupBy(k).agg(F.min(order).alias(f"_first_{k}")))
        left = cut(left.join(first, k))
        second = cut(left.filter(F.col(order) > F.col(f"_first_{k}")).groupBy(k).agg(F.min(order).alias(f"_second_{k}")))
        left = cut(left.join(second, k, "left"))
    blockers = F.array_distinct(F.filter(F.array(*[F.when(F.col(order) > F.col(f"_first_{k}"), F.col(f"_first_{k}")) for k in keys]),
                                         lambda x: x.isNotNull()))
    several = reduce(Column.__or__, [F.coalesce(F.col(order) > F.col(f"_second_{k}"), F.lit(False)) for k in keys])
    ranked = cut(left.select(order, several.alias("several"), blockers.alias("blockers")))
    free = ranked.filter("not several and size(blockers) = 0").select(order)
    pointers = cut(ranked.filter("not several and size(blockers) = 1").select(
        order, F.col("blockers")[0].alias("to"), F.lit(True).alias("odd"), F.lit(False).alias("done")))
    while not pointers.filter("not done").isEmpty():
        beyond = pointers.select(F.col(order).alias("to"), F.col("to").alias("_to"), F.col("odd").alias("_odd"), F.col("done").alias("_done"))
        # A pointer whose end has none itself has arrived.
        pointers = cut(pointers.filter("done").unionByName(pointers.filter("not done").join(beyond, "to", "left").select(
            order, F.coalesce("_to", "to").alias("to"), (F.col("odd") != F.coalesce("_odd", F.lit(False))).alias("odd"),
            F.coalesce("_done", F.lit(True)).alias("done"))))
    ends = free.select(F.col(order).alias("to"))
    return cut(free.withColumn("kept", F.lit(True)).union(pointers.join(ends, "to", "left_semi").select(order, (~F.col("odd")).alias("kept"))))


def dedupe_greedy(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Whole rows of :func:`kept_positions`."""
    return df.join(kept_positions(df, keys, order), order, "left_semi")


def duplicate_count(df: DataFrame, keys: list[str], order: str, name: str = "n_duplicates") -> DataFrame:
    """Rows that the greedy walk skips."""
    kept = kept_positions(df, keys, order).agg(F.count(F.lit(1)))
    return df.agg((F.count(F.lit(1)) - kept.scalar()).alias(name))
