"""Hourly event files to an appended raw table, flat tables and an NDJSON sample."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmill.operators.flatten import normalize_json
from tripmill.session import scratch_dir
from tripmill.sinks.tables import append_rows, export_ndjson, write_flat


def load_archive(
    records: DataFrame, out: str, name: str = "events", key: str = "id"
) -> dict[str, DataFrame]:
    """Append nested records to one flat table per nesting level and read the tables back.

    The text is parsed once, into a columnar copy in the shared scratch folder; every table then
    reads only the columns it needs from there.
    """
    spark = records.sparkSession
    parsed = scratch_dir(spark, "parsed-events")
    write_flat(records, parsed)
    tables = normalize_json(spark.read.schema(records.schema).parquet(parsed), name, key)
    for label, df in tables.items():
        append_rows(df, f"{out}/{label}")
    return {label: spark.read.schema(df.schema).parquet(f"{out}/{label}") for label, df in tables.items()}


def export_sample(events: DataFrame, path: str, n: int = 100) -> None:
    export_ndjson(events, path, ["id"], n)
