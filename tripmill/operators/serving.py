"""Dashboard and validation queries on the marts and on the live window table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.scalars import money_sum
from tripmill.sinks.tables import MONTH_COLUMN


def monthly_totals(zone_mart: DataFrame) -> DataFrame:
    return (
        zone_mart.groupBy("revenue_month", "service_type")
        .agg(F.sum("total_monthly_trips").alias("total_monthly_trips"))
        .orderBy(F.asc("revenue_month"), F.desc("service_type"))
    )


def top_zones(zone_mart: DataFrame, n: int = 5) -> DataFrame:
    """Zones with the highest revenue; equal revenue is ordered by name."""
    revenue = money_sum(
        "revenue_monthly_total_amount", zone_mart.schema["revenue_monthly_total_amount"].dataType
    )
    return (
        zone_mart.groupBy("revenue_zone")
        .agg(revenue.alias("total_revenue"), F.sum("total_monthly_trips").alias("total_trips"))
        .orderBy(F.desc("total_revenue"), F.asc("revenue_zone"))
        .limit(n)
    )


def filter_mart(
    mart: DataFrame, first_month: str, last_month: str, service_type: str | None = None
) -> DataFrame:
    """Dashboard filters: months from first to last (``YYYY-MM-DD``), optionally one service.

    Of a mart stored by month only the months in question are read.
    """
    if MONTH_COLUMN in mart.columns:
        mart = mart.where(F.col(MONTH_COLUMN).between(first_month[:7], last_month[:7])).drop(MONTH_COLUMN)
    kept = mart.where(
        F.col("revenue_month").between(
            F.lit(first_month).cast("timestamp_ntz"), F.lit(last_month).cast("timestamp_ntz")
        )
    )
    return kept.where(F.col("service_type") == service_type) if service_type else kept


def service_share(totals: DataFrame) -> DataFrame:
    """Share of all trips per service; the window spans one row per service."""
    everything = F.sum("trip_total").over(Window.partitionBy())
    return totals.select("service_type", "trip_total", (F.col("trip_total") / everything).alias("share"))


def month_by_year(citywide: DataFrame, years: Sequence[int]) -> DataFrame:
    """Trips per calendar month with one column per year (``y2019`` ...) and one for all others."""
    per_year = [F.sum(F.when(F.col("trip_year") == y, F.col("trips"))).alias(f"y{y}") for y in years]
    others = F.sum(F.when(~F.col("trip_year").isin(list(years)), F.col("trips"))).alias("other_years")
    return citywide.groupBy("trip_month").agg(*per_year, others)


def yoy_monthly(citywide: DataFrame) -> DataFrame:
    """Trips per month and service beside the same month one year earlier.

    Every mart row is counted once for its own year and once as the next year's comparison, so
    the mart is computed once where a self-join would compute it twice.
    """
    shifted = citywide.select(
        "trip_year", "trip_month", "service_type", "trips", F.explode(F.array(F.lit(0), F.lit(1))).alias("ago")
    )

    def of_year(ago: int):
        return F.sum(F.when(F.col("ago") == ago, F.col("trips")))

    return (
        shifted.groupBy((F.col("trip_year") + F.col("ago")).alias("trip_year"), "trip_month", "service_type")
        .agg(
            F.max(F.col("ago") == 0).alias("has_year"),
            of_year(0).alias("trips"),
            of_year(1).alias("trips_year_before"),
        )
        .where("has_year")
        .select(
            "trip_year",
            "trip_month",
            "service_type",
            "trips",
            "trips_year_before",
            (F.col("trips") / F.when(F.col("trips_year_before") != 0, F.col("trips_year_before")) - 1).alias(
                "change"
            ),
        )
    )


def latest_windows(stats: DataFrame, n: int = 15) -> DataFrame:
    """Newest windows first, vendors in text order within a window."""
    return stats.orderBy(F.desc("window_start"), F.asc("vendor_id")).limit(n)


def vendor_activity(stats: DataFrame, n: int = 10) -> DataFrame:
    """Labels and counts of the newest windows, oldest first for the chart."""
    label = F.concat(
        F.lit("Vendor "), F.col("vendor_id"), F.lit(" ("), F.date_format("window_start", "HH:mm"), F.lit(")")
    )
    return (
        latest_windows(stats, n)
        .orderBy(F.asc("window_start"), F.asc("vendor_id"))
        .select(label.alias("label"), "trip_count")
    )
