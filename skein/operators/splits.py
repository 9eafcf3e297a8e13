"""Splits into folds, test and training rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.skew import lookup
from skein.operators.order import first_ranks, with_row_index
from skein.operators.shape import hash_share
from skein.session import cut


def contiguous_folds(df: DataFrame, k: int, order: list[str], name: str = "fold") -> DataFrame:
    """Number ``k`` contiguous folds (from 1) of the rows in ``order``; the first ones take the rest."""
    indexed = with_row_index(df, order, "_index")
    n = indexed.count()
    size, larger = divmod(n, k)
    border = larger * (size + 1)
    index = F.col("_index")
    fold = F.when(index < border, F.floor(index / (size + 1)))
    if size:
        fold = fold.otherwise(larger + F.floor((index - border) / size))
    return indexed.withColumn(name, (fold + 1).cast("int")).drop("_index")


def fold_pair(folds: DataFrame, number: int, sort: list[str], name: str = "fold") -> tuple[DataFrame, DataFrame]:
    """Test rows (one fold) and training rows (all others), each sorted."""
    is_test = F.col(name) == number
    return (folds.filter(is_test).drop(name).orderBy(*sort),
            folds.filter(~is_test).drop(name).orderBy(*sort))


def leave_n_per_user(df: DataFrame, user: str, order: list[str], start: int, stop: int,
                     max_test: int = 0, name: str = "is_test") -> DataFrame:
    """Mark rows ``start`` to ``stop`` of every user as test rows, the rest as training rows.

    With ``max_test`` above 0 only the first that many test rows in ``order`` stay test rows.
    ``order`` must be a total order. Only the ranked rows of a user travel; all rows then compare
    their place with the user's first and last test row.
    """
    place = F.struct(*order)
    ranked = cut(first_ranks(df.select(*dict.fromkeys([user, *order])), user, order, start, stop))
    span = ranked.groupBy(user).agg(F.min(place).alias("_from"), F.max(place).alias("_to"))
    marked = lookup(df, cut(span), user, "left")
    is_test = F.coalesce((place >= F.col("_from")) & (place <= F.col("_to")), F.lit(False))
    if max_test > 0:
        last = with_row_index(ranked.select(*order), order, "_index").filter(
            F.col("_index") == max_test - 1).select(place.alias("_last"))
        is_test = is_test & F.coalesce(place <= last.scalar(), F.lit(True))
    return marked.withColumn(name, is_test).drop("_from", "_to")


def random_split(df: DataFrame, weights: list[float], seed: int | None = None,
                 keys: list[str] | None = None) -> list[DataFrame]:
    """Split at random by weights.

    With ``keys`` a row's part depends on its key and the seed alone, so the split needs no sort and
    repeats under any partitioning, also when tasks are run again.
    """
    if not keys:
        return df.randomSplit(weights, seed)
    numbered = df.withColumn("_part", split_number(weights, seed or 0, keys))
    return [numbered.filter(F.col("_part") == at).drop("_part") for at in range(len(weights))]


def split_number(weights: list[float], seed: int, keys: list[str]) -> Column:
    """Number of the part (from 0) a row falls into."""
    share, whole = hash_share(keys, seed), float(sum(weights))
    borders = [limit / whole for limit in accumulate(weights)][:-1]
    return sum((F.when(share >= border, 1).otherwise(0) for border in borders), F.lit(0))
