"""Parts of ISO-8601 time text. Year to weekday come from the written local time, not the instant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def written(time: Column | str) -> Column:
    """The time text, with '' read as missing."""
    return F.nullif(F.col(time) if isinstance(time, str) else time, F.lit(""))


def year_text(time: Column | str) -> Column:
    return F.substring(written(time), 1, 4)


def month_text(time: Column | str) -> Column:
    return F.substring(written(time), 6, 2)


def day_text(time: Column | str) -> Column:
    return F.substring(written(time), 1, 10)


def local_date(time: Column | str) -> Column:
    """Calendar day where the text was written."""
    return F.try_to_date(day_text(time), "yyyy-MM-dd")


def weekday_number(time: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(local_date(time))


def instant(time: Column | str) -> Column:
    """Point in time the text stands for; null when it cannot be parsed."""
    return F.try_to_timestamp(written(time))


TIME_PARTS = {"year": year_text, "month": month_text, "day": day_text, "weekday": weekday_number}
