"""Sums over the subtrees of a forest by parallel tree contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.session import cut

# Rows of a round's table that share a file; the tables shrink round by round, and so do their files.
ROUND_ROWS = 10_000


def cut_by_size(df: DataFrame, rows: int) -> DataFrame:
    """Materialise a table of at most ``rows`` rows in no more files than that needs."""
    return cut(df.coalesce(max(1, -(-rows // ROUND_ROWS))))


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``id`` and, under their own names, ``values`` summed over the subtree of every node, its top included.

    ``nodes`` has ``id`` (long, unique), ``parent`` (an ``id`` of ``nodes``, null at the top of a tree) and the long columns
    ``values``; a null value counts as 0, other columns are not looked at. No rows give no rows. Every round

    * rakes: each leaf hands its sum to its parent (sums are combined on the map side, so a parent with a third of
      all nodes below it costs one row per task) and is done;
    * compresses: of the nodes with one child, those that draw heads and whose child does not are taken out; the child
      moves up to their parent and carries their values, so that whoever gets it gets both.

    Leaves and nodes with one child are at least half of all nodes, so a fixed share goes in each round
    and the number of rounds grows with the logarithm of the nodes, however deep the trees. A node knows its only child without a
    look at it: children are held as a count and the exclusive or of their ids. Then the rounds are walked
    backward, and each node taken out gets its own values plus the sum of the child it was taken off. Tables
    shrink geometrically both ways; joins are on ids that are unique on both sides.
    """
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("id").alias("kids"))
    table = cut(nodes.select("id", "parent", *values).join(children, "id", "left").select(
        "id", "parent", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("kids", zero).alias("kids"),
        *[F.coalesce(v, zero).cast("long").alias(v) for v in values], *[zero.alias(f"carry_{v}") for v in values],
        null.alias("child"), F.lit(0).alias("gone")))
    tables = [table]
    while rows := table.filter("gone = 0").count():
        table = cut_by_size(_round(table.filter("gone = 0"), values, len(tables)), rows)
        tables.append(table)
    return _expand(tables, values)


def _round(live: DataFrame, values: list[str], turn: int) -> DataFrame:
    """The tree after a round, and the nodes compressed in it (``gone``) with their values and their ``child``.

    Every change is a row under the node it belongs to, and one aggregate applies them.
    """
    carried = [f"carry_{v}" for v in values]
    heads = (F.col("n") == 1) & F.col("parent").isNotNull() & (F.xxhash64(F.lit(turn), "id") > 0)
    below = live.filter((F.col("n") > 0) & ~heads).select(
        F.col("id").alias("kids"), *[F.col(c).alias(f"below_{c}") for c in carried])
    taken = live.filter(heads).join(below, "kids").withColumn("child", F.col("kids"))

    def change(key: str, gone: int = 0, **given: Column) -> Column:
        zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
        base = {"parent": null, "moved": null, "n": zero, "kids": zero} | dict.fromkeys([*values, *carried], zero)
        return F.struct(F.col(key).alias("id"), *[c.alias(k) for k, c in (base | given).items() if k in base],
                        given.get("child", null).alias("child"), F.lit(gone).alias("gone"))

    kept = change("id", **{c: F.col(c) for c in ["parent", "n", "kids", *values, *carried]})
    raked = change("parent", n=F.lit(-1).cast("long"), kids=F.col("id"), **{v: F.col(v) + F.col(c) for v, c in zip(values, carried)})
    lifted = change("child", moved=F.col("parent"), **{c: F.col(v) + F.col(c) for v, c in zip(values, carried)})
    adopted = change("parent", kids=F.col("id").bitwiseXOR(F.col("child")))
    gone = change("id", gone=1, child=F.col("child"), **{v: F.col(f"below_{c}") for v, c in zip(values, carried)})
    changes = live.filter("n > 0 or parent is not null").select(F.when(F.col("n") > 0, kept).otherwise(raked).alias("x")).union(
        taken.select(F.explode(F.array(lifted, adopted, gone)).alias("x"))).select("x.*")
    return changes.groupBy("id").agg(
        F.coalesce(F.max("moved"), F.max("parent")).alias("parent"), F.sum("n").alias("n"), F.bit_xor("kids").alias("kids"),
        *[F.sum(c).alias(c) for c in [*values, *carried]], F.max("child").alias("child"), F.max("gone").alias("gone"))


def _expand(tables: list[DataFrame], values: list[str]) -> DataFrame:
    """Sums of all nodes, from the last round to the first: leaves have theirs, nodes taken out get their child's added."""
    known = tables[-1].select("id", *values)
    for before, after in zip(tables[-2::-1], tables[:0:-1]):
        taken = after.filter("gone = 1")
        if n := taken.count():
            totals = known.select(F.col("id").alias("child"), *[F.col(v).alias(f"child_{v}") for v in values])
            known = known.union(cut_by_size(taken.join(totals, "child").select(
                "id", *[(F.col(v) + F.col(f"child_{v}")).alias(v) for v in values]), n))
        known = known.union(before.filter("gone = 0 and n = 0").select("id", *values))
    return known
