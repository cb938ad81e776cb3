"""Lenient dates and epoch formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_DAY = r"^(\d{4}-\d{1,2}-\d{1,2})(?:[T ](?:[01]?\d|2[0-3]):[0-5]?\d(?::[0-5]?\d(?:\.\d+)?)?(?: ?(?:Z|UTC|[+-]\d{2}(?::?\d{2})?))?)?$"


def lenient_date(text: Column) -> Column:
    """Date or null.

    The day may be followed by a time of at least hour and minute, with or without seconds and zone, and by nothing else.  A bare year or
    year-month is no date here, although Spark's own cast would take it.
    """
    day = F.regexp_extract(F.trim(text), _DAY, 1)
    return F.when(day != "", day.try_cast("date"))


def epoch_day_text(millis: Column, pattern: str = "dd-MM-yyyy") -> Column:
    """Epoch milliseconds to day text in the session time zone (pinned to UTC by the session)."""
    return F.date_format(F.timestamp_millis(millis), pattern)
