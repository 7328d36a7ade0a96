"""Date and time Column functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampType


def as_date_lit(d: dt.date | str) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def month_boundaries_between(later: Column, earlier: Column) -> Column:
    """Number of month boundaries crossed from ``earlier`` to ``later``.

    2024-05-31 -> 2025-02-01 is 9, not the 8 whole months that
    ``timestampdiff(MONTH)`` counts.
    """
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("bigint")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def whole_minutes_between(end: Column, start: Column) -> Column:
    """Whole elapsed minutes from ``start`` to ``end`` (truncated)."""
    return F.timestamp_diff("MINUTE", start, end)


_OFFSET = r"(?i)(?:z|utc|gmt|[+-][0-9]{1,2}(?::?[0-9]{2}){0,2})\s*$"
_HAS_TIME = "[0-9]:[0-9]"


def _wall_clock_utc(instant: Column) -> Column:
    """The UTC wall clock of an instant, whatever the session's zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01").cast("timestamp_ntz"))


def to_utc_timestamp_ntz(df: DataFrame, column: str) -> Column:
    """A text, timestamp or date column of ``df`` as a zone-free UTC wall clock.

    Text with an offset or a Z, and zoned timestamps, are instants; text and
    timestamps without a zone are UTC already.
    """
    c, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, TimestampType):
        return _wall_clock_utc(c)
    if isinstance(kind, StringType):
        return F.transform(F.array(c), _text_to_utc)[0]
    return c.cast("timestamp_ntz")


def _text_to_utc(text: Column) -> Column:
    """The wall clock of a lambda's ``text``.

    The text is bound once, so a filter on the time that Spark pushes below the staging evaluates the
    expression behind the text once a row, not for each of its uses here.
    """
    zoned = text.rlike(_HAS_TIME) & text.rlike(_OFFSET)
    return F.when(zoned, _wall_clock_utc(text.cast("timestamp"))).otherwise(text.cast("timestamp_ntz"))


def date_from_text(df: DataFrame, column: str) -> Column:
    """The UTC DATE of ``YYYY-MM-DD`` or timestamp text (or of a date or timestamp)."""
    return to_utc_timestamp_ntz(df, column).cast("date")


def trailing_days_start(as_of: dt.date, days: int) -> Column:
    """``as_of - days``: lower bound (inclusive) of a trailing window."""
    return F.date_sub(as_date_lit(as_of), days)


def trailing_months_start(as_of: dt.date, months: int) -> Column:
    return F.add_months(as_date_lit(as_of), -months)
