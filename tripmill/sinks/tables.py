"""Table writers: day-partitioned trips, views and tables by layer, NDJSON, appends."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLUSTER_COLUMNS = ("VendorID", "PULocationID")
DAY_COLUMN = "pickup_date"
MONTH_COLUMN = "ym"
JSON_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# How each layer is stored.
LAYERS = {"staging": "view", "core": "table", "mart": "table"}


def write_by_day(
    df: DataFrame, path: str, ts_col: str, cluster_by: Sequence[str] = CLUSTER_COLUMNS
) -> None:
    """Replace a table partitioned by day of ``ts_col`` and sorted by the cluster columns.

    The rebalance hint sends a day's rows together, after which adaptive execution joins small
    days into one task and splits a day that is too large for one, so neither many sparse days
    nor one huge day hurts. Sorting by day first keeps the writer from sorting again, which
    would undo the clustering; sorted files let a vendor or zone filter skip row groups.
    """
    dated = df.withColumn(DAY_COLUMN, F.to_date(ts_col))
    (
        dated.hint("rebalance", DAY_COLUMN)
        .sortWithinPartitions(DAY_COLUMN, *cluster_by)
        .write.mode("overwrite")
        .partitionBy(DAY_COLUMN)
        .parquet(path)
    )


def load_catalog(
    df: DataFrame, name: str, ts_col: str, grain: str = "day", cluster_by: Sequence[str] = CLUSTER_COLUMNS
) -> DataFrame:
    """Load a catalog table partitioned by day or month of ``ts_col`` and sorted by the cluster columns.

    The first load creates the table. Later ones replace the partitions they hold rows of and leave
    the others, so a month that is loaded again replaces its own days only. Rows without a time are
    a partition of their own. Filter on the partition column to prune.
    """
    spark, column = df.sparkSession, f"pickup_{'date' if grain == 'day' else grain}"
    dated = df.withColumn(column, F.to_date(F.date_trunc(grain, ts_col)))
    dated = dated.hint("rebalance", column).sortWithinPartitions(column, *cluster_by)
    if spark.catalog.tableExists(name):
        key = "spark.sql.sources.partitionOverwriteMode"  # an insert reads it from the session alone
        before = spark.conf.get(key)
        spark.conf.set(key, "dynamic")
        try:
            dated.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set(key, before)
    else:
        dated.write.format("parquet").partitionBy(column).saveAsTable(name)
    return spark.table(name)


def write_by_month(df: DataFrame, path: str, ts_col: str) -> None:
    """Replace a table partitioned by the month of ``ts_col``, as text in column ``ym``."""
    monthly = df.withColumn(MONTH_COLUMN, F.date_format(ts_col, "yyyy-MM"))
    monthly.hint("rebalance", MONTH_COLUMN).write.mode("overwrite").partitionBy(MONTH_COLUMN).parquet(path)


def write_flat(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table."""
    df.write.mode("overwrite").parquet(path)


def between_dates(df: DataFrame, ts_col: str, first: date, end: date) -> DataFrame:
    """Rows with ``first <= ts_col < end`` of a table written by day.

    Spark does not derive the partition from the timestamp, so both are filtered: the first
    prunes folders, the second is exact.
    """
    return df.where(
        (F.col(DAY_COLUMN) >= F.lit(first))
        & (F.col(DAY_COLUMN) < F.lit(end))
        & (F.col(ts_col) >= F.lit(first).cast("timestamp_ntz"))
        & (F.col(ts_col) < F.lit(end).cast("timestamp_ntz"))
    )


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database unless it exists."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def materialize(df: DataFrame, name: str, layer: str) -> DataFrame:
    """Store a model the way its layer says and give back a frame that reads what was stored."""
    if LAYERS.get(layer, "view") == "view":
        df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def export_ndjson(df: DataFrame, path: str, order_by: Sequence[str], n: int = 100) -> None:
    """First ``n`` rows as a folder of newline-delimited JSON.

    Null fields are kept, and so are microseconds, which the default format would cut.
    """
    (
        df.orderBy(*order_by)
        .limit(n)
        .write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .option("timestampFormat", JSON_TIMESTAMP)
        .option("timestampNTZFormat", JSON_TIMESTAMP)
        .json(path)
    )
