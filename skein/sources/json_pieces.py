"""JSON arrays read by many tasks: records are found from running quotes and braces over pieces of the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skein.functions.skew import lookup
from skein.session import cut

# A file's blocks, and a piece's place in its block.
BLOCK = ["file", "block"]


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _opened(plain: Column, inside: Column) -> Column:
    """Opening braces outside strings, of text that starts inside a string or not."""
    start = F.when(inside, F.lit('"')).otherwise(F.lit(""))
    return _count(F.regexp_replace(F.concat(start, plain), r'"[^"]*+("|$)', ""), "{")


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files cut behind each closing brace, with what a piece adds to the depth if it starts outside or inside a string."""
    text = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    text = text.select("*", plain.alias("plain")).withColumn("odd", _count(F.col("plain"), '"') % 2)
    return text.select(
        *BLOCK, "at", "value", "odd",
        (_opened(F.col("plain"), F.lit(False)) - (1 - F.col("odd"))).alias("outside"),
        (_opened(F.col("plain"), F.lit(True)) - F.col("odd")).alias("inside"))


def _blocks(pieces: DataFrame, *sums: Column) -> DataFrame:
    return pieces.groupBy(*BLOCK).agg(*sums)


def read_json_array_split(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """Files that each hold one JSON array of objects, or one object, in UTF-8; large files are read by many tasks.

    A task reads a byte range, cut into pieces behind closing braces. Whether a piece starts inside a string, and how deep,
    are sums over the pieces before it: first inside the block, under both assumptions, then over the blocks of the file,
    of which there is one row each. A record ends where the depth comes back to none outside a string; its pieces
    are put together by record, also across blocks. White space, line breaks and nesting do not matter.

    A block's pieces are ordered in one task, and a block is at most ``spark.sql.files.maxPartitionBytes``. Elements that
    are no objects are left out. A record that does not fit ``schema`` has nulls. Empty files and ``[]`` give no rows. A file
    that ends inside its last record may give that record in part.
    """
    before = Window.partitionBy(*BLOCK).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*BLOCK).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    pieces = _pieces(spark, path).withColumn("started", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    add_a = F.when(F.col("started") == 0, F.col("outside")).otherwise(F.col("inside"))
    add_b = F.when(F.col("started") == 0, F.col("inside")).otherwise(F.col("outside"))
    pieces = cut(pieces.select(
        *BLOCK, "at", "value", "odd", "started", F.sum(add_a).over(upto).alias("if_outside"), F.sum(add_b).over(upto).alias("if_inside")))

    # One row a block: does it start inside a string, and how deep?
    blocks = _blocks(pieces, F.sum("odd").alias("odd"), F.max_by("if_outside", "at").alias("if_outside"), F.max_by("if_inside", "at").alias("if_inside"))
    blocks = blocks.select("*", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("in_string"))
    added = F.when(F.col("in_string") == 0, F.col("if_outside")).otherwise(F.col("if_inside"))
    blocks = blocks.select(*BLOCK, "in_string", F.coalesce(F.sum(added).over(earlier), F.lit(0)).alias("depth"))

    placed = lookup(pieces, blocks, BLOCK)
    depth = F.col("depth") + F.when(F.col("in_string") == 0, F.col("if_outside")).otherwise(F.col("if_inside"))
    closed = (F.col("in_string") + F.col("started") + F.col("odd")) % 2 == 0
    placed = placed.select(*BLOCK, "at", "value", ((depth == 0) & closed).cast("int").alias("ends"))
    placed = cut(placed.withColumn("record", F.coalesce(F.sum("ends").over(before), F.lit(0))))

    # What stands before the first end of a block belongs to the record begun in the last block with an end before it.
    ended = _blocks(placed, F.sum("ends").alias("n_ends"))
    opened = F.last(F.when(F.col("n_ends") > 0, F.struct("block", "n_ends")), ignorenulls=True).over(earlier)
    none = F.struct(F.lit(-1).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("n_ends"))
    ended = ended.select(*BLOCK, F.coalesce(opened, none).alias("carried"))
    rows = lookup(placed, ended, BLOCK)
    first = F.col("record") == 0
    rows = rows.select(
        "file", F.when(first, F.col("carried.block")).otherwise(F.col("block")).alias("block"),
        F.when(first, F.col("carried.n_ends")).otherwise(F.col("record")).alias("record"),
        F.struct(F.col("block").alias("from"), "at", "value").alias("piece"))
    record = F.concat(F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["value"]), "}"), F.lit("}"))
    records = rows.groupBy("file", "block", "record").agg(record.alias("text"))
    text = F.regexp_replace("text", r"^[^{]+", "")
    return records.filter(F.contains("text", F.lit("{"))).select(F.from_json(text, schema).alias("r")).select("r.*")
