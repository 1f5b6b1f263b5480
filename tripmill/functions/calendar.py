"""Month and hour keys."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _month_number(ym: str) -> int:
    year, month = ym.split("-")
    return int(year) * 12 + int(month) - 1


def month_keys(first: str, last: str) -> list[str]:
    """``YYYY-MM`` keys from first to last inclusive; empty when reversed."""
    span = range(_month_number(first), _month_number(last) + 1)
    return [f"{n // 12}-{n % 12 + 1:02d}" for n in span]


def hour_keys(first: datetime, last: datetime) -> list[str]:
    """``YYYY-MM-DD-H`` keys (hour without padding), inclusive."""
    hours = int((last - first) / timedelta(hours=1))
    stamps = (first + timedelta(hours=i) for i in range(hours + 1))
    return [f"{s:%Y-%m-%d}-{s.hour}" for s in stamps]


def month_sequence(first: Column, last: Column) -> Column:
    """Array of month starts; Spark's sequence raises on reversed bounds, this gives none."""
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    return F.when(F.trunc(first, "month") <= F.trunc(last, "month"), months).otherwise(
        F.expr("cast(array() as array<date>)")
    )


def month_calendar(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per month (``ym``) between two date columns of each row of ``bounds``."""
    months = month_sequence(F.col(first).cast("date"), F.col(last).cast("date"))
    return bounds.select(F.explode(months).alias("month")).select(
        F.date_format("month", "yyyy-MM").alias("ym")
    )
