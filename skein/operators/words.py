"""Word and letter statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.fixed import CZECH_LETTERS
from skein.functions.text import (clean_tokens, initial, is_clean_word, is_letter, letters_in_words,
                                  normal_word, occurrences, token_count, tokens)
from skein.operators.aggregates import value_counts
from skein.operators.order import top_k


def explode_words(df: DataFrame, col: str, lower: bool = False, keep: list[str] | None = None) -> DataFrame:
    """One row per word in column ``word``, next to the kept columns."""
    text = F.lower(F.col(col)) if lower else F.col(col)
    return df.select(*(keep or []), F.explode(tokens(text)).alias("word"))


def word_count(df: DataFrame, col: str) -> DataFrame:
    """Occurrences of every word."""
    return explode_words(df, col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def normalised_word_count(df: DataFrame, col: str, n: int | None = 20) -> DataFrame:
    """Most frequent words after dropping non-ASCII, links and punctuation and lowering the case.

    Words are counted raw first and normalised after: the expensive text functions run once per
    distinct word and task instead of once per word, and the counts of equal results are added. The empty word goes
    by a condition that also needs the sum, so it cannot be moved below the first count.
    """
    raw = word_count(df, col)
    counted = raw.withColumn("word", normal_word("word")).groupBy("word").agg(F.sum("n").alias("n")).filter(
        F.when(F.col("word") != "", F.col("n")).isNotNull())
    return counted if n is None else top_k(counted, "n", n, ["word"])


def top_words(df: DataFrame, col: str, k: int, order: str | None = None, min_len: int = 1,
              lower: bool = False) -> DataFrame:
    """``k`` most frequent words of at least ``min_len`` letters.

    With ``order`` (a row position) the word seen first wins ties, else the alphabetically smaller.
    """
    text = F.lower(F.col(col)) if lower else F.col(col)
    if order is None:
        words = df.select(F.explode(tokens(text)).alias("word"))
        counted = words.filter(F.length("word") >= min_len).groupBy("word").agg(
            F.count(F.lit(1)).alias("n"))
        return top_k(counted, "n", k, ["word"])
    words = df.select(order, F.posexplode(tokens(text)).alias("_at", "word"))
    counted = words.filter(F.length("word") >= min_len).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(order, "_at")).alias("_first"))
    return top_k(counted, "n", k, ["_first"]).select("word", "n")


def total_words(df: DataFrame, col: str, name: str = "n_words") -> DataFrame:
    """Number of words in all rows."""
    return df.agg(F.sum(token_count(col)).alias(name))


def mean_word_length(df: DataFrame, col: str, name: str = "mean_length") -> DataFrame:
    """Average length of all words, without producing a row per word."""
    return df.agg((F.sum(letters_in_words(col)) / F.sum(token_count(col))).alias(name))


def top_by_occurrences(df: DataFrame, phrase: str, k: int, title: str = "title", text: str = "text",
                       order: str = "pos") -> DataFrame:
    """Titles whose text holds the phrase most often.

    The last row of a title gives its count; among equal counts the title seen first wins.
    """
    counted = df.select(title, order, occurrences(text, phrase).alias("_hits"))
    per_title = counted.groupBy(title).agg(
        F.max_by("_hits", order).alias("hits"), F.min(order).alias("_first"))
    return top_k(per_title, "hits", k, ["_first"]).select(title, "hits")


def most_and_least_words(df: DataFrame, col: str, order: str) -> DataFrame:
    """The rows with most and fewest words, marked in column ``which``; the first in order wins ties."""
    counted = df.withColumn("n_words", token_count(col))
    row, n = F.struct(*counted.columns), F.col("n_words")
    missing = n.isNull().cast("int")
    most = F.min_by(row, F.struct(missing, -n, F.col(order)))
    least = F.min_by(row, F.struct(missing, n, F.col(order)))
    found = counted.agg(F.array(F.struct(F.lit("most").alias("which"), most.alias("row")),
                                F.struct(F.lit("least").alias("which"), least.alias("row"))).alias("both"))
    return found.select(F.inline("both")).filter(F.col("row").isNotNull()).select("row.*", "which")


def words_per_row_histogram(df: DataFrame, col: str) -> DataFrame:
    """Rows per number of words."""
    return value_counts(df, token_count(col), "n_words")


def word_length_histogram(df: DataFrame, col: str, width: int = 1) -> DataFrame:
    """Words per length, or per bucket of ``width`` lengths named by its lower end."""
    lengths = F.transform(tokens(col), F.length)
    length = F.explode(lengths)
    bucketed = df.select(length.alias("_len"))
    value = F.col("_len") if width == 1 else (F.floor(F.col("_len") / width) * width).cast("int")
    return value_counts(bucketed, value, "word_length")


def first_letter_count(df: DataFrame, col: str) -> DataFrame:
    """Words per lower-cased first letter; words that do not start with a letter are left out."""
    letters = explode_words(df, col, lower=True).select(initial("word").alias("letter"))
    return letters.filter(is_letter("letter")).groupBy("letter").agg(F.count(F.lit(1)).alias("n"))


def clean_words(df: DataFrame, col: str, extra_letters: str = CZECH_LETTERS,
                keep: list[str] | None = None) -> DataFrame:
    """One row per lower-cased word of accepted letters. Works on batch and streaming frames."""
    words = df.select(*(keep or []), F.explode(clean_tokens(col, extra_letters)).alias("word"))
    return words.filter(is_clean_word("word"))


def clean_word_count(df: DataFrame, col: str, extra_letters: str = CZECH_LETTERS) -> DataFrame:
    """Occurrences of every clean word, most frequent first, then by word."""
    counted = clean_words(df, col, extra_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.col("n").desc(), "word")
