"""Projections, casts, filters and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.fixed import DEGREES_PER_KELVIN, WATER_FREEZES


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Keep the named columns under new names, given as ``old: new``."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in columns.items()])


# Kind through which text becomes a whole number; it holds every value of the target exactly.
# A direct cast of text with a fraction fails, and failing costs an exception per row.
THROUGH = {"int": "double", "bigint": "decimal(38,9)", "long": "decimal(38,9)"}


def try_numeric(df: DataFrame, cols: list[str], kind: str = "double") -> DataFrame:
    """Cast text columns; text that is no number becomes null. Whole kinds cut off a fraction."""
    def number(c: str) -> Column:
        return F.col(c).try_cast(THROUGH.get(kind, kind)).try_cast(kind)

    return df.withColumns({c: number(c) for c in cols})


def binarise(df: DataFrame, col: str, threshold: float = 0, null_label: str = "drop",
             name: str | None = None) -> DataFrame:
    """1.0 where the value exceeds the threshold, else 0.0.

    Rows without a value are dropped, or labelled 0.0 with ``null_label='zero'``.
    """
    kept = df.dropna(subset=[col]) if null_label == "drop" else df
    return kept.withColumn(name or col, F.when(F.col(col) > threshold, 1.0).otherwise(0.0))


def to_fahrenheit(tenths: Column | str) -> Column:
    """Tenths of a degree Celsius to degrees Fahrenheit."""
    tenths = F.col(tenths) if isinstance(tenths, str) else tenths
    return WATER_FREEZES + tenths / 10 * DEGREES_PER_KELVIN


def to_celsius(fahrenheit: Column | str) -> Column:
    """Degrees Fahrenheit to degrees Celsius."""
    fahrenheit = F.col(fahrenheit) if isinstance(fahrenheit, str) else fahrenheit
    return (fahrenheit - WATER_FREEZES) / DEGREES_PER_KELVIN


def require_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with a value in every listed column."""
    return df.dropna(subset=cols)


def text_filter(df: DataFrame, col: str, contains: str | None = None, like: str | None = None,
                prefix: str | None = None, regex: str | None = None) -> DataFrame:
    """Rows whose text meets every given predicate."""
    text = F.col(col)
    tests = [
        text.contains(contains) if contains is not None else None,
        text.like(like) if like is not None else None,
        text.startswith(prefix) if prefix is not None else None,
        text.rlike(regex) if regex is not None else None,
    ]
    return df.filter(reduce(Column.__and__, [t for t in tests if t is not None], F.lit(True)))


def hash_share(keys: list[str], seed: int) -> Column:
    """Uniform number in [0, 1) that depends only on the key columns and the seed."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)


def sample_n(df: DataFrame, n: int, seed: int | None = None, keys: list[str] | None = None) -> DataFrame:
    """``n`` random rows. With ``seed`` and unique ``keys`` the same rows come back every time."""
    if seed is not None and keys:
        return df.orderBy(hash_share(keys, seed), *keys).limit(n)
    return df.orderBy(F.rand(seed)).limit(n)


def take_n(df: DataFrame, n: int, label: str | None = None) -> DataFrame:
    """Any ``n`` rows; of a node table optionally only those with a label."""
    chosen = df if label is None else df.filter(F.array_contains("labels", label))
    return chosen.limit(n)
