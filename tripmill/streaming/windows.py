"""Tumbling counts per vendor, for streams and for stored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: window size of the live statistics.
WINDOW = "5 minutes"


def tumbling_counts(
    rows: DataFrame, ts_col: str, vendor_col: str = "vendor_id", size: str = WINDOW
) -> DataFrame:
    """Rows per vendor and half-open window: vendor_id, trip_count, window_start, window_end."""
    return (
        rows.groupBy(F.window(ts_col, size).alias("w"), F.col(vendor_col).alias("v"))
        .agg(F.count("*").alias("trip_count"))
        .select(
            F.col("v").cast("string").alias("vendor_id"),
            "trip_count",
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        )
    )


def with_event_time(stream: DataFrame, ts_col: str, lateness: str | None = "0 seconds") -> DataFrame:
    """Make a column usable as event time: zoned timestamp, and a watermark unless ``None``.

    Rows older than the newest seen time minus ``lateness`` are dropped once their window has
    closed; raise it where files do not arrive in time order. Text that is no time becomes null,
    and null times are in no window.
    """
    timed = stream.withColumn(ts_col, F.col(ts_col).try_cast("timestamp"))
    return timed.withWatermark(ts_col, lateness) if lateness is not None else timed


def with_arrival_time(stream: DataFrame, name: str = "proc_time") -> DataFrame:
    """Processing time as a column; it never runs backwards, so no row is late."""
    return stream.withColumn(name, F.current_timestamp()).withWatermark(name, "0 seconds")
