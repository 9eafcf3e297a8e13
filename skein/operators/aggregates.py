"""Counts, sums, averages and extremes, grouped or global.

Every group-by here combines on the map side, so a hot key costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.timeparts import TIME_PARTS, day_text, month_text, year_text


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_over_threshold(df: DataFrame, col: str, threshold: float, name: str = "n") -> DataFrame:
    """Number of rows whose value exceeds the threshold."""
    return df.agg(F.count_if(F.col(col) > threshold).alias(name))


def value_counts(df: DataFrame, col: str | Column, name: str = "value", keep_null: bool = True,
                 order: str | None = "value") -> DataFrame:
    """Rows per value, ordered by value, by count descending, or not at all."""
    counted = df.select((F.col(col) if isinstance(col, str) else col).alias(name))
    if not keep_null:
        counted = counted.dropna()
    counted = counted.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    sorts = {"value": [F.col(name)], "count": [F.col("n").desc(), F.col(name)]}
    return counted.orderBy(*sorts[order]) if order else counted


def counts_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per combination of keys."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def sum_by_key(df: DataFrame, key: str | Column, value: str, name: str = "total",
               key_name: str | None = None, round_to: int | None = None,
               order: str | None = "key") -> DataFrame:
    """Sum per key; ``order`` is key, total, total_desc or None."""
    key_name = key_name or (key if isinstance(key, str) else "key")
    key = F.col(key) if isinstance(key, str) else key
    total = F.sum(value) if round_to is None else F.round(F.sum(value), round_to)
    summed = df.groupBy(key.alias(key_name)).agg(total.alias(name))
    sorts = {"key": [F.col(key_name)], "total": [F.col(name), F.col(key_name)],
             "total_desc": [F.col(name).desc(), F.col(key_name)]}
    return summed.orderBy(*sorts[order]) if order else summed


def group_count(df: DataFrame, key: str, count_null: bool = True, name: str = "n_groups") -> DataFrame:
    """Number of groups; the group of missing keys counts unless told otherwise."""
    distinct = df.select(key).distinct()
    return count_rows(distinct if count_null else distinct.dropna(), name)


def avg_by_key(df: DataFrame, key: str, value: str, name: str = "average",
               round_to: int | None = None) -> DataFrame:
    """Average per key, ordered by key."""
    average = F.avg(value) if round_to is None else F.round(F.avg(value), round_to)
    return df.groupBy(key).agg(average.alias(name)).orderBy(key)


def extreme_by_key(df: DataFrame, key: str, value: str | Column, how: str,
                   name: str = "extreme") -> DataFrame:
    """Greatest or least value per key."""
    return df.groupBy(key).agg({"max": F.max, "min": F.min}[how](value).alias(name))


def mean(df: DataFrame, col: str, name: str = "mean") -> DataFrame:
    return df.agg(F.avg(col).alias(name))


def total(df: DataFrame, col: str, name: str = "total") -> DataFrame:
    return df.agg(F.sum(col).alias(name))


def count_by_time_part(df: DataFrame, part: str, time: str = "time",
                       keep_null: bool = False) -> DataFrame:
    """Rows per year, month, day or weekday (Monday is 0) of the written time, in order."""
    return value_counts(df, TIME_PARTS[part](time), part, keep_null)


def extreme_months(df: DataFrame, time: str = "time", order: str = "pos") -> DataFrame:
    """Months of the year with most and fewest rows in one row; the month seen first wins ties."""
    months = df.groupBy(month_text(time).alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    return months.agg(
        F.max_by("month", F.struct(F.col("n"), -F.col("first"))).alias("most"),
        F.max("n").alias("most_n"),
        F.min_by("month", F.struct("n", "first")).alias("least"),
        F.min("n").alias("least_n"),
    )


def category_counts_in_year(df: DataFrame, year: str, time: str = "time",
                            category: str = "category") -> DataFrame:
    """Rows per category in one year, most first; missing categories form a group."""
    return value_counts(df.filter(F.col(time).startswith(year)), category, category, order="count")


def category_share(df: DataFrame, col: str, name: str = "value") -> DataFrame:
    """Rows per value and their share of all rows; missing values form a group."""
    counted = value_counts(df, col, name, order=None)
    whole = counted.agg(F.sum("n"))
    return counted.withColumn("share", F.col("n") / whole.scalar())


def keyword_timeline(df: DataFrame, keywords: list[str], text: str = "title",
                     time: str = "time") -> DataFrame:
    """Rows per day and keyword whose text contains the keyword, in one pass over the table."""
    hits = F.filter(F.array(*map(F.lit, keywords)), lambda word: F.contains(F.col(text), word))
    return (
        df.select(day_text(time).alias("day"), F.explode(hits).alias("keyword"))
        .dropna(subset=["day"])
        .groupBy("keyword", "day").agg(F.count(F.lit(1)).alias("n"))
        .orderBy("keyword", "day")
    )


def top_rating_share(ratings: DataFrame, item: str = "item", rating: str = "rating",
                     top: int = 5) -> DataFrame:
    """Per item: top ratings, all ratings, and the share of the first in the second."""
    top_count = F.count_if(F.col(rating) == top)
    return ratings.groupBy(item).agg(
        top_count.alias("top_count"),
        F.count(rating).alias("n_ratings"),
        (top_count / F.count(rating)).alias("top_share"),
    )


def in_year(df: DataFrame, year: str, time: str = "time") -> DataFrame:
    """Rows written in one year."""
    return df.filter(year_text(time) == year)
