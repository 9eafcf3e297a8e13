"""Logged conversations: snapshots that a longer log repeats are dropped, the rest is rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.session import cut

# Turns of one conversation that are ordered, hashed and rendered together.
BLOCK_TURNS = 1024


def with_prefix_hashes(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``conv_id, block, k, role, text, one, two``: rank of the turn from 1, and two hashes of all turns up to it.

    A prefix's hash is the exclusive or, over its turns, of a hash of rank, role and text, so it rolls: the hash up to
    a turn is that of the block's start combined with the turns of the block. Blocks hold the turns whose number
    falls into the same ``block_turns``; ranks and hashes at their starts come from sums over blocks, so no task
    orders a whole conversation.
    """
    blocked = turns.withColumn("block", F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-1)).cast("long"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocked.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    ranked = blocked.withColumn("at", F.row_number().over(inside)).join(sizes, ["conv_id", "block"]).withColumn(
        "k", F.col("offset") + F.col("at"))
    # Null and empty are told apart, as are the borders between the parts.
    parts = [F.col("k"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    hashed = cut(ranked.select("conv_id", "block", "k", "role", "text", F.xxhash64(F.lit(1), *parts).alias("one"),
                               F.xxhash64(F.lit(2), *reversed(parts)).alias("two")))
    totals = hashed.groupBy("conv_id", "block").agg(F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two"))
    starts = totals.select("conv_id", "block", *[
        F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"start_{c}") for c in ("one", "two")])
    rolling = Window.partitionBy("conv_id", "block").orderBy("k")
    return hashed.join(starts, ["conv_id", "block"]).select("conv_id", "block", "k", "role", "text", *[
        F.bit_xor(c).over(rolling).bitwiseXOR(F.col(f"start_{c}")).alias(c) for c in ("one", "two")])


def maximal(prefixes: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies`` of the conversations that no other one repeats and continues.

    Of equal conversations the one with the least ``conv_id`` stands for all. ``prefixes`` has a row per turn. The last
    row of each is its hash as a whole; whole hashes that occur as a shorter part of any conversation are taken out.
    Equal hashes are combined on the map side on both sides of that join, so a snapshot or first turn shared by a
    third of all conversations is one row per task.
    """
    whole = prefixes.groupBy("conv_id").agg(F.max(F.struct("k", "one", "two")).alias("end"))
    ends = whole.groupBy("end").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies")).select(
        "conv_id", F.col("end.k").alias("k"), F.col("end.one").alias("one"), F.col("end.two").alias("two"), "n_copies")
    lengths = whole.select("conv_id", F.col("end.k").alias("n"))
    parts = prefixes.join(lengths, "conv_id").filter(F.col("k") < F.col("n")).select("k", "one", "two").distinct()
    return ends.join(parts, ["k", "one", "two"], "left_anti").select("conv_id", F.col("k").alias("n_turns"), "n_copies")


def rendered_turn(role: Column, text: Column) -> Column:
    """One turn between its marks; marks written in the turn itself are broken up by a space."""
    clean = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), clean(role), F.lit("\n"), clean(text), F.lit("<|im_end|>\n"))


def collapse(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``conv_id, part, n_turns, n_copies, rendered``: maximal conversations, rendered.

    Turns are ordered by ``turn``, then role and text, nulls first; a repeated row is a turn of its own. Rows without a
    ``conv_id`` belong to no conversation and are left out. ``n_turns`` and ``n_copies`` are those of the
    conversation; ``rendered`` is the text of its turns with numbers in the same ``block_turns``: ``part`` 0 is all of
    an ordinary conversation, and a longer one comes in several rows, in the order of ``part`` (-1: without a number).
    Null role and text are rendered empty. Other columns are not looked at.
    """
    turns = conversations.filter("conv_id is not null").select("conv_id", "turn", "role", "text")
    prefixes = cut(with_prefix_hashes(turns, block_turns))
    kept = cut(maximal(prefixes))
    pieces = prefixes.join(kept, "conv_id").groupBy("conv_id", F.col("block").alias("part"), "n_turns", "n_copies").agg(
        F.sort_array(F.collect_list(F.struct("k", rendered_turn(F.col("role"), F.col("text")).alias("piece")))).alias("all"))
    return pieces.select("conv_id", "part", "n_turns", "n_copies",
                         F.array_join(F.transform("all", lambda x: x["piece"]), "").alias("rendered"))
