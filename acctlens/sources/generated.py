"""Generated relations: literal rows (S7) and a date series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_values(spark: SparkSession, column: str, values: Sequence[str]) -> DataFrame:
    """A one-column relation of fixed literal values (``unnest([...])``)."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(column))


def date_series(spark: SparkSession, start: dt.date, end: dt.date, column: str = "date_day") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive.

    Built from ``spark.range`` so the days are spread over tasks rather than
    exploded from one array in one task.
    """
    days = (end - start).days + 1
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(column))


def date_series_between(bounds: DataFrame, start: Column | str, end: Column | str, column: str = "date_day") -> DataFrame:
    """Day series between two dates held by a one-row ``bounds`` frame.

    The span is a calendar range (days, not data rows), so exploding it from
    the single bounds row is bounded by the calendar, not by the data volume.
    """
    lo = F.col(start) if isinstance(start, str) else start
    hi = F.col(end) if isinstance(end, str) else end
    return bounds.select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias(column))
