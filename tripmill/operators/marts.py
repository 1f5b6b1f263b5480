"""Pre-aggregated marts over the trip facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.scalars import money_sum, month_floor
from tripmill.schemas import REVENUE_COLUMNS


def month_range(df: DataFrame, ts_col: str, ym: str) -> DataFrame:
    """Rows of one calendar month, as a half-open range that reaches the file scan."""
    start = F.lit(f"{ym}-01").cast("timestamp_ntz")
    end = F.add_months(F.lit(f"{ym}-01").cast("date"), 1).cast("timestamp_ntz")
    return df.where((F.col(ts_col) >= start) & (F.col(ts_col) < end))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("c"))


def monthly_zone_revenue(facts: DataFrame) -> DataFrame:
    """One row per pickup zone name, month and service.

    Partial aggregation leaves at most zones x months x services rows per task to shuffle, so a
    zone that holds a third of all trips costs its reducer no more than any other.
    """
    types = {f.name: f.dataType for f in facts.schema.fields}
    totals = [money_sum(name, types[name]).alias(label) for name, label in REVENUE_COLUMNS.items()]
    return facts.groupBy(
        F.col("pickup_zone").alias("revenue_zone"),
        month_floor(F.col("pickup_datetime")).alias("revenue_month"),
        "service_type",
    ).agg(
        *totals,
        F.count("tripid").alias("total_monthly_trips"),
        F.avg("passenger_count").alias("avg_monthly_passenger_count"),
        F.avg("trip_distance").alias("avg_monthly_trip_distance"),
    )


def citywide_monthly(zone_mart: DataFrame) -> DataFrame:
    """Zones rolled up: one row per month and service (averages are not additive, so not kept)."""
    total = zone_mart.schema["revenue_monthly_total_amount"].dataType
    rolled = zone_mart.groupBy("revenue_month", "service_type").agg(
        F.sum("total_monthly_trips").alias("trips"),
        money_sum("revenue_monthly_total_amount", total).alias("revenue_total"),
    )
    return rolled.select(
        "revenue_month",
        F.year("revenue_month").cast("bigint").alias("trip_year"),
        F.month("revenue_month").cast("bigint").alias("trip_month"),
        "service_type",
        "trips",
        "revenue_total",
    )


def service_type_totals(citywide: DataFrame) -> DataFrame:
    return citywide.groupBy("service_type").agg(F.sum("trips").alias("trip_total"))
