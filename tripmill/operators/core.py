"""Zone dimension and trip facts.

No join here carries a broadcast hint. Spark broadcasts a dimension by its own size check
(``spark.sql.autoBroadcastJoinThreshold``, on file statistics when planning and on real sizes
while running). Beyond that both sides shuffle, and the adaptive skew join splits the trips of a
hot id over several tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.schemas import PASSED_COLUMNS


def dim_zones(seed: DataFrame) -> DataFrame:
    """Zone dimension; every literal 'Boro' in service_zone reads 'Green'."""
    return seed.select(
        "locationid",
        "borough",
        "zone",
        F.replace("service_zone", F.lit("Boro"), F.lit("Green")).alias("service_zone"),
    )


def _role(zones: DataFrame, role: str) -> DataFrame:
    return zones.select(
        F.col("locationid").alias(f"{role}_locationid"),
        F.col("borough").alias(f"{role}_borough"),
        F.col("zone").alias(f"{role}_zone"),
    )


def join_zone(trips: DataFrame, zones: DataFrame, role: str) -> DataFrame:
    """Add borough and zone of one role (pickup or dropoff); trips with unknown ids fall away."""
    return trips.join(_role(zones, role), f"{role}_locationid", "inner")


def union_services(staged: dict[str, DataFrame]) -> DataFrame:
    """All services' staged trips, each tagged with its service_type."""
    tagged = [df.withColumn("service_type", F.lit(name)) for name, df in staged.items()]
    return reduce(DataFrame.unionByName, tagged)


def fact_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips of all services with the zone dimension in its two roles (23 columns)."""
    joined = join_zone(join_zone(trips, zones, "pickup"), zones, "dropoff")
    return joined.select(
        "tripid",
        "vendorid",
        "service_type",
        "ratecodeid",
        "pickup_locationid",
        "pickup_borough",
        "pickup_zone",
        "dropoff_locationid",
        "dropoff_borough",
        "dropoff_zone",
        "pickup_datetime",
        "dropoff_datetime",
        *PASSED_COLUMNS,
        "congestion_surcharge",
    )


def unmatched_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips whose pickup or dropoff id the dimension does not know, counted per service and role."""
    ids = trips.select(
        "service_type",
        F.explode(
            F.create_map(
                F.lit("pickup"), F.col("pickup_locationid"), F.lit("dropoff"), F.col("dropoff_locationid")
            )
        ).alias("role", "locationid"),
    )
    per_id = ids.groupBy("service_type", "role", "locationid").agg(F.count("*").alias("n"))
    return (
        per_id.join(zones.select("locationid"), "locationid", "left_anti")
        .groupBy("service_type", "role")
        .agg(F.sum("n").alias("dropped_trips"))
    )
