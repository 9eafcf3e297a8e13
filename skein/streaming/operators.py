"""Operators over streaming frames. The stateless ones work on batch frames as well."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import DataType, StructType, TimestampNTZType

from skein.functions.fixed import MATCH_PATTERN, MATCH_WINDOW, WORD_WINDOW
from skein.operators.order import day_of
from skein.operators.words import clean_words, first_letter_count


def with_watermark(stream: DataFrame, col: str, delay: str | None = "0 seconds") -> DataFrame:
    """Declare event time: rows later than ``delay`` behind the newest may be dropped.

    Spark takes an instant for that, so a time without zone is read in the session's zone.
    """
    if delay is None:
        return stream
    if stream.schema[col].dataType == TimestampNTZType():
        stream = stream.withColumn(col, F.col(col).cast("timestamp"))
    return stream.withWatermark(col, delay)


def window_bounds(time: DataType) -> list[Column]:
    """Start and end of column ``window``, in the type the event time came in."""
    return [F.col(f"window.{end}").cast(time).alias(f"window_{end}") for end in ("start", "end")]


def time_window(time: str, size: str, slide: str | None = None) -> Column:
    """Sliding window, or a tumbling one without ``slide``."""
    return F.window(time, size, slide) if slide else F.window(time, size)


def windowed_word_count(stream: DataFrame, size: str = WORD_WINDOW[0], slide: str | None = WORD_WINDOW[1],
                        time_col: str | None = None, watermark: str | None = None,
                        col: str = "value") -> DataFrame:
    """Clean words per window of arrival time, or of ``time_col``.

    Without a watermark the whole result is kept and sorted by window and count (complete mode
    only), and its state grows for ever. With one, closed windows leave the state and no sort is made.
    """
    time = time_col or "_arrival"
    timed = stream if time_col else stream.withColumn(time, F.current_timestamp())
    counted = (
        clean_words(with_watermark(timed, time, watermark), col, keep=[time])
        .groupBy(time_window(time, size, slide).alias("window"), "word")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*window_bounds(timed.schema[time].dataType), "word", "n")
    )
    return counted if watermark else counted.orderBy("window_start", F.col("n").desc(), "word")


def running_word_count(stream: DataFrame, col: str = "value", ordered: bool = True) -> DataFrame:
    """Clean words over all rows so far: most frequent first (complete mode), or, not ``ordered``, only the words
    that a batch changed (update mode), which is all that is written for it."""
    counted = clean_words(stream, col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.col("n").desc(), "word") if ordered else counted


def running_letter_count(stream: DataFrame, col: str = "value") -> DataFrame:
    """First letters over all rows so far; in update mode each batch gives the changed letters."""
    return first_letter_count(stream, col)


def parse_json_stream(stream: DataFrame, schema: StructType | str, col: str = "value",
                      keep: list[str] | None = None) -> DataFrame:
    """Fields of a JSON text; a field that does not parse is null."""
    return stream.select(F.from_json(col, schema).alias("_json"), *(keep or [])).select(
        "_json.*", *(keep or []))


def active_rows(stream: DataFrame, col: str = "comment_count", above: int = 1,
                columns: tuple[str, ...] = ("title", "comment_count")) -> DataFrame:
    """Rows with more than ``above`` comments."""
    return stream.filter(F.col(col) > above).select(*columns)


def windowed_match_counts(stream: DataFrame, size: str = MATCH_WINDOW[0], slide: str | None = MATCH_WINDOW[1],
                          pattern: str = MATCH_PATTERN, time_col: str = "event_time",
                          watermark: str | None = None, title: str = "title",
                          text: str = "text") -> DataFrame:
    """Rows with a title, and rows whose text fits a LIKE pattern, per window."""
    return (
        with_watermark(stream, time_col, watermark).groupBy(time_window(time_col, size, slide).alias("window"))
        .agg(F.count(title).alias("total_articles"),
             F.sum(F.col(text).like(pattern).cast("int")).alias("matching_articles"))
        .select(*window_bounds(stream.schema[time_col].dataType), "total_articles", "matching_articles")
    )


def advanced_since_previous_stream(stream: DataFrame, key: str, time: str, order: str,
                                   columns: list[str] | None = None, zone: str = "UTC") -> DataFrame:
    """Rows whose calendar day is later than that of the key's row before (append mode).

    The last day of each key is kept in the state store. One call sees the rows of one key in one
    micro-batch, narrowed to the columns needed, and sorts them by ``order``; the source's batch limit
    bounds them. Streams without a key, or with a key that dominates a batch, take
    :func:`skein.streaming.sinks.advances_by_batch`, which splits such a sequence.
    """
    columns = columns or []
    narrow = stream.select(key, order, *columns, day_of(stream, time, zone).alias("event_date"))
    fields = {f.name: f.dataType.simpleString() for f in narrow.schema}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in [key, order, *columns, "event_date"])
    names = [key, order, *columns, "event_date", "previous_date"]

    def step(_, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(chunks)).sort_values(order)
        before = state.get[0] if state.exists else None
        rows["previous_date"] = rows["event_date"].shift(1)
        rows.iloc[0, rows.columns.get_loc("previous_date")] = before
        state.update((rows["event_date"].iloc[-1],))
        known = rows[rows["previous_date"].notna() & rows["event_date"].notna()]
        yield known[known["previous_date"] < known["event_date"]][names]

    return narrow.groupBy(key).applyInPandasWithState(
        step, f"{schema}, previous_date date", "last_date date", "append", GroupStateTimeout.NoTimeout)
