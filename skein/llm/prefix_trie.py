"""Conversations as a trie of turns, with sums over every subtree by parallel tree contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.contraction import subtree_sums
from skein.llm.digests import run_digests
from skein.operators.order import with_row_index
from skein.session import cut

WORD = r"[^\x20\x09-\x0D]+"
# Conversations of one family share the opening turns of its first: ids from one multiple of FAMILY to the next.
FAMILY = 20
# An opening has fewer turns than this.
OPENINGS = 4
# Turns of one conversation whose hashes are rolled together.
BLOCK_TURNS = 1024
# Ids of neighbouring conversations that are written as one piece before they are hashed.
PIECE_IDS = 4096


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, k, one, two, words``: a row per turn, numbered from 1 within its conversation.

    Turns go by ``turn`` (null first), then role and text. ``one`` and ``two`` are independent hashes of role and
    text, ``words`` counts the words of the text. The number comes from one range shuffle of all turns, in which a hot
    conversation, or a row repeated very often, is split; the text goes no further than that.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", empty("role").alias("role"), empty("text").alias("text"))
    hashed = turns.select(
        "*", F.xxhash64(F.lit(1), "role", "text").alias("one"), F.xxhash64(F.lit(2), "text", "role").alias("two"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("tie"))
    indexed = with_row_index(hashed, ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "tie"], "at",
                             keep=["conv_id", "one", "two", "words"])
    firsts = cut(indexed.groupBy(F.col("conv_id").alias("conv")).agg(F.min("at").alias("first")))
    return cut(indexed.join(firsts, F.col("conv_id") == F.col("conv")).select(
        "conv_id", (F.col("at") - F.col("first") + 1).alias("k"), "one", "two", "words"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations with the opening of their family: ``conv_id, size``, and their turns as :func:`numbered_turns` has them.

    An opening is the first ``h`` turns of conversation ``c - c % FAMILY`` as logged (what there is of them), ``h`` the
    CRC-32 of the decimal id modulo ``OPENINGS``; a conversation's own turns after its first ``h`` follow. A family holds
    fewer than two times ``FAMILY`` conversations, so openings are handed out without skew.
    """
    heads = cut(turns.filter((F.col("k") < OPENINGS) & (F.col("conv_id") % FAMILY == 0)).groupBy(F.col("conv_id").alias("donor")).agg(
        F.sort_array(F.collect_list(F.struct("k", "one", "two", "words"))).alias("head")))
    logs = turns.groupBy("conv_id").agg(F.max("k").alias("n")).select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("donor"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENINGS).cast("int").alias("h"))
    opened = logs.join(heads, "donor", "left").withColumn(
        "head", F.filter(F.coalesce("head", F.array()), lambda x: x["k"] <= F.col("h")))
    opened = cut(opened.select("conv_id", "h", "head", F.size("head").alias("m"),
                               (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")))
    borrowed = opened.select("conv_id", F.explode("head").alias("x")).select("conv_id", "x.*")
    own = turns.join(opened.select(F.col("conv_id").alias("conv"), "h", "m"), F.col("conv_id") == F.col("conv")).filter(
        F.col("k") > F.col("h")).select("conv_id", (F.col("k") - F.col("h") + F.col("m")).alias("k"), "one", "two", "words")
    return opened.select("conv_id", "size"), borrowed.select(own.columns).union(own)


def prefixes(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``conv_id, k, one, two, up_one, up_two, words``: hashes of the first ``k`` turns, and of the first ``k - 1``.

    A prefix's hash is the exclusive or of its turns' hashes, each mixed with its depth. It rolls over blocks of
    ``block_turns``, whose starts come from sums over blocks, so no task walks a whole conversation.
    """
    mixed = turns.select("conv_id", "k", F.floor((F.col("k") - 1) / block_turns).alias("block"), "words",
                         F.xxhash64("k", "one").alias("one"), F.xxhash64("k", "two").alias("two"))
    mixed = cut(mixed)
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = mixed.groupBy("conv_id", "block").agg(F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two"))
    starts = totals.select("conv_id", "block", *[
        F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"start_{c}") for c in ("one", "two")])
    inside = Window.partitionBy("conv_id", "block").orderBy("k")
    rolled = mixed.join(starts, ["conv_id", "block"])
    up_to = lambda c: F.bit_xor(c).over(inside).bitwiseXOR(F.col(f"start_{c}"))
    return rolled.select("conv_id", "k", "words", "one", "two", up_to("one").alias("to_one"), up_to("two").alias("to_two")).select(
        "conv_id", "k", F.col("to_one").alias("one"), F.col("to_two").alias("two"),
        F.col("to_one").bitwiseXOR(F.col("one")).alias("up_one"), F.col("to_two").bitwiseXOR(F.col("two")).alias("up_two"), "words")


def _nodes(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """A row per distinct prefix, with an id, its parent's id and name, and its members counted."""
    inner = rows.groupBy(F.col("k").alias("depth"), "one", "two").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("up_one").alias("up_one"),
        F.min("up_two").alias("up_two"), F.min("words").alias("words"))
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("one"), F.lit(0).cast("long").alias("two"), "conv_id",
        "n_convs", F.lit(0).cast("long").alias("up_one"), F.lit(0).cast("long").alias("up_two"), F.lit(0).cast("long").alias("words"))
    nodes = cut(inner.select(top.columns).union(top).withColumn("id", F.monotonically_increasing_id()))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("one").alias("up_one"), F.col("two").alias("up_two"),
                         F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return cut(nodes.filter("depth > 0").join(above, ["depth", "up_one", "up_two"]).select(nodes.columns + above.columns[3:]).union(
        nodes.filter("depth = 0").select("*", F.lit(None).cast("long"), F.lit(None).cast("long"))))


def _ends(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """``depth, one, two, ends_sha256`` of nodes at which conversations end."""
    ends = rows.join(convs, "conv_id").filter(F.col("k") == F.col("size")).select("conv_id", F.col("k").alias("depth"), "one", "two")
    zero = F.lit(0).cast("long")
    ends = ends.union(convs.filter("size = 0").select("conv_id", zero, zero, zero))
    key = ["depth", "one", "two"]
    pieces = ends.groupBy(*key, F.floor(F.col("conv_id") / PIECE_IDS).alias("part")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("piece"))
    return run_digests(pieces, key, ["part"], "piece", ",", "ends_sha256")


def trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``: a row per trie node.

    A node is a distinct sequence of the first ``depth`` turns (role and text) of the conversations of
    :func:`rebuilt`; all of them, also those without turns, are members of the root. ``conv_id`` is the smallest member,
    ``parent_conv_id`` that of the parent (null at the root), ``n_leaves`` the childless nodes of the subtree,
    ``saved_tokens`` its sum of ``n_convs - 1`` times the words of a node's last turn: the tokens that need no second
    pass when prefixes are shared. ``ends_sha256`` is that of the decimal ids, ascending and comma-joined, of the members
    that end here; the empty text's for none.

    Null role and text are empty texts; a null ``turn`` comes first; rows of equal ``turn`` go by role and text, and a
    repeated row is a turn of its own. Rows without ``conv_id`` belong to no conversation and are left out. No conversations
    give no rows, not even a root. Other columns are not looked at. A turn, prefix or ending shared by a third of all
    conversations is combined on the map side or split by the adaptive join; nodes are told apart by 128 bits of hash.
    """
    convs, turns = rebuilt(numbered_turns(conversations))
    rows = cut(prefixes(turns, block_turns))
    nodes = _nodes(convs, rows)
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut(nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).withColumn(
        "n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words")))
    sums = subtree_sums(nodes, ["n_leaves", "saved_tokens"])
    named = nodes.drop("n_leaves", "saved_tokens").join(sums, "id").join(_ends(convs, rows), ["depth", "one", "two"], "left")
    return named.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
