"""Staged trips: not-null vendor, one row per vendor and pickup time, casts and key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.scalars import id_text, to_int64, trip_key
from tripmill.schemas import ID_COLUMNS, PASSED_COLUMNS, SERVICES


def drop_null_vendor(df: DataFrame) -> DataFrame:
    return df.where(F.col("VendorID").isNotNull())


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, nulls first.

    With ``order`` naming all other columns the survivor is unique up to identical rows, so a
    task that runs again keeps the same row. Spark limits each key to one row per input
    partition before it shuffles, so a key that holds a large share of the rows ships at most
    one row per task. List the most selective key first: it leads the sort.
    """
    by = ", ".join(f"`{k}`" for k in keys)
    first = ", ".join(f"`{c}` asc nulls first" for c in order)
    rank = F.expr(f"row_number() over (partition by {by} order by {first})")
    return df.withColumn("rn", rank).where("rn = 1").drop("rn")


def stage_trips(raw: DataFrame, service: str, ts_suffix: str = "") -> DataFrame:
    """The 18 staged columns of one service's raw trips.

    Only the 17 source columns are shuffled; casts and the key are computed on the survivors.
    """
    pickup, dropoff = SERVICES[service]
    columns = [*ID_COLUMNS, pickup, dropoff, *PASSED_COLUMNS, "congestion_surcharge"]
    keys = [pickup, "VendorID"]
    order = [dropoff, *[c for c in columns if c not in (*keys, dropoff)]]
    trips = dedup_first(drop_null_vendor(raw.select(*columns)), keys, order)
    types = {f.name: f.dataType for f in trips.schema.fields}
    vendor = id_text(F.col("VendorID"), types["VendorID"])
    return trips.select(
        trip_key(vendor, F.col(pickup), ts_suffix).alias("tripid"),
        *[to_int64(F.col(c), types[c]).alias(alias) for c, alias in ID_COLUMNS.items()],
        F.col(pickup).cast("timestamp_ntz").alias("pickup_datetime"),
        F.col(dropoff).cast("timestamp_ntz").alias("dropoff_datetime"),
        *PASSED_COLUMNS,
        F.col("congestion_surcharge").cast("double").alias("congestion_surcharge"),
    )
