"""Joins of measured rows with names and other attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.skew import lookup
from skein.operators.aggregates import top_rating_share


def join_names(rows: DataFrame, names: DataFrame, on: str | list[str], how: str = "inner", **sizes: int) -> DataFrame:
    """Rows with the attributes of ``names``, which has one row per key."""
    return lookup(rows, names, on, how, **sizes)


def hyped_items(ratings: DataFrame, items: DataFrame, top: int = 5, k: int | None = 10,
                item: str = "item", rating: str = "rating", item_id: str = "id",
                name: str = "name") -> DataFrame:
    """Items with most top ratings, by name, with the share of top ratings in all their ratings.

    Ratings shrink to one row per item before the join, so its keys are unique on both sides.
    """
    shares = top_rating_share(ratings, item, rating, top).filter(F.col("top_count") > 0)
    named = items.select(F.col(item_id).alias(item), name)
    ranked = shares.join(named, item).select(item, name, "top_count", "top_share").orderBy(
        F.col("top_count").desc(), F.col("top_share").desc(), item)
    return ranked if k is None else ranked.limit(k)


def name_of_top(measured: DataFrame, names: DataFrame, measure: str, on: str = "id") -> DataFrame:
    """The row with the greatest measure, with its name. One row is broadcast."""
    best = measured.orderBy(F.col(measure).desc(), on).limit(1)
    return names.join(F.broadcast(best), on)
