"""Connected components of links between 64-bit nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.session import cut


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``one, two``, longs); equal roots mean connected.

    Each round points every node to the neighbour, or itself, that comes first in an order drawn anew from
    a hash, and merges nodes that point to the same one. A fixed share of the nodes goes in every round however long
    the chains, so the rounds grow with the logarithm of the nodes. Pointers are minima combined on the map side; they
    and the links are written each round, so the joins between them start from tables and Spark splits a node
    with very many links.
    """
    links = cut(links.filter("one != two").select(
        F.least("one", "two").alias("one"), F.greatest("one", "two").alias("two")).distinct())
    roots = cut(links.select(F.explode(F.array("one", "two")).alias("node")).distinct().withColumn("root", F.col("node")))
    turn = 0
    while not links.isEmpty():
        turn += 1
        drawn = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("draw"), F.col(c).alias("to"))
        both = links.union(links.select("two", "one"))
        pointers = cut(both.groupBy(F.col("one").alias("at")).agg(F.min(drawn("two")).alias("best"))
                       .select("at", F.least("best", F.struct(F.xxhash64(F.lit(turn), "at").alias("draw"),
                                                              F.col("at").alias("to")))["to"].alias("to")))
        ends = links.join(pointers.select(F.col("at").alias("one"), F.col("to").alias("first")), "one")
        ends = ends.join(pointers.select(F.col("at").alias("two"), F.col("to").alias("second")), "two")
        merged = ends.filter("first != second").select(
            F.least("first", "second").alias("one"), F.greatest("first", "second").alias("two")).distinct()
        links = cut(merged)
        moved = pointers.select(F.col("at").alias("root"), "to")
        roots = cut(roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
    return roots
