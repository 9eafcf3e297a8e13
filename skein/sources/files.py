"""Batch file sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skein.functions.fixed import DEFAULT_LINE


def read_delimited(spark: SparkSession, path: str | list[str], schema: StructType | str,
                   sep: str = ",", header: bool = False) -> DataFrame:
    """Delimited file with a declared schema; double quotes enclose values that hold ``sep``."""
    return spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)


def read_csv(spark: SparkSession, path: str | list[str], header: bool = True,
             schema: StructType | str | None = None, names: list[str] | None = None) -> DataFrame:
    """CSV file. Without ``schema`` the types are inferred, which costs one more pass over the file."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    frame = reader.csv(path)
    return frame.toDF(*names) if names else frame


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, in column ``value``."""
    return spark.read.text(path)


def from_lines(spark: SparkSession, lines: list[str] | None = None) -> DataFrame:
    """Lines given in the call; a built-in sentence when there are none."""
    return spark.createDataFrame([(line,) for line in lines or [DEFAULT_LINE]], "value string")


def lines_or_default(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Lines of a file, or the built-in sentence when no path is given."""
    return read_lines(spark, path) if path else from_lines(spark)


def parse_lines(df: DataFrame, sep_regex: str, fields: dict[str, tuple[int, str]],
                col: str = "value") -> DataFrame:
    """Split lines and cast fields, given as ``name: (position, type)``.

    A field that is missing or does not parse is null.
    """
    parts = F.split(F.trim(F.col(col)), sep_regex)
    return df.select(*[
        F.get(parts, F.lit(position)).try_cast(kind).alias(name)
        for name, (position, kind) in fields.items()
    ])


def read_json_array(spark: SparkSession, path: str | list[str],
                    schema: StructType | str | None = None) -> DataFrame:
    """File holding one JSON array of objects. It is read by one task; ``json_pieces`` has a reader for large ones."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_lines(spark: SparkSession, path: str | list[str],
                    schema: StructType | str | None = None) -> DataFrame:
    """JSON store written by the article sink: one object per line, split among tasks."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def union_all(frames: list[DataFrame], by_name: bool = False) -> DataFrame:
    """All rows of all frames, matched by position or by column name."""
    return reduce(DataFrame.unionByName if by_name else DataFrame.unionAll, frames)
