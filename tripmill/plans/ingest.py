"""Monthly files to one day-partitioned raw table per service."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tripmill.operators.align import align_to_schema, merge_months
from tripmill.operators.quality import Volume, volume_checks
from tripmill.schemas import SERVICES, warehouse_schema
from tripmill.sinks.tables import DAY_COLUMN, write_by_day, write_flat

log = logging.getLogger(__name__)

# Lowest plausible row counts of the checked month.
VOLUME_CHECKS = [
    Volume("Yellow", "tpep_pickup_datetime", "2019-03", 500_000),
    Volume("Green", "lpep_pickup_datetime", "2019-03", 10_000),
]


def load_types(df: DataFrame) -> DataFrame:
    """Columns in their loaded types; a frame with a type that has none is passed as it is."""
    try:
        return align_to_schema(df, warehouse_schema(df.schema))
    except ValueError as err:
        log.warning("keeping the files' own types: %s", err)
        return df


def ingest_service(
    spark: SparkSession,
    service: str,
    template: str,
    months: Sequence[str],
    out: str,
    checks: Sequence[Volume] = VOLUME_CHECKS,
    skip_checks: bool = False,
) -> DataFrame:
    """Merge a service's months, replace its raw table and check the loaded volume."""
    timestamps = SERVICES[service]
    trips = load_types(merge_months(spark, template, months, timestamps))
    if timestamps[0] in trips.columns:
        write_by_day(trips, out, timestamps[0])
        loaded = spark.read.schema(trips.schema.add(DAY_COLUMN, "date")).parquet(out)
    else:
        write_flat(trips, out)
        loaded = spark.read.schema(trips.schema).parquet(out)
    mine = [c for c in checks if c.table == service]
    if mine and not skip_checks:
        short = [r for r in volume_checks({service: loaded}, mine).collect() if not r.passed]
        if short:
            raise RuntimeError(f"too few rows: {[(r.table_name, r.ym, r.row_count) for r in short]}")
    return loaded
