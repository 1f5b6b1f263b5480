"""The star-schema test tables seen as trips, zones and events.

``lineitem`` becomes two services' raw trips, ``nation`` and ``region`` the zones, ``events`` the
event archive and the event stream. Trips are a plain projection of ``lineitem``, so the cost of
a query is the cost of its operators. Supplier 0 stands for an unknown vendor, zone ids 25 and 26
are unknown to the dimension and two zones share a name: the cases the models have to handle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmill.functions.calendar import hour_keys, month_keys
from tripmill.schemas import SERVICES
from tripmill.session import scratch_dir
from tripmill.sinks.tables import MONTH_COLUMN, write_by_month

STATUS = {"Yellow": "O", "Green": "F"}
ZONE_IDS = 27
DRIFT_YEARS = (1997, 1999)

_written: dict[tuple, tuple] = {}
_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the footer once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def raw_trips(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """Raw trips of one service in the shape of a monthly trip file."""
    pickup, dropoff = SERVICES[service]
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == STATUS[service])
    return lines.selectExpr(
        "nullif(l_suppkey, 0L) as VendorID",
        f"l_shipdate as {pickup}",
        f"l_shipdate + make_dt_interval(0, l_linenumber) as {dropoff}",
        "l_linenumber as passenger_count",
        "l_quantity as trip_distance",
        "l_quantity / 2 as RatecodeID",
        f"l_partkey % {ZONE_IDS} as PULocationID",
        f"l_orderkey % {ZONE_IDS} as DOLocationID",
        "cast(instr('ANR', l_returnflag) as bigint) as payment_type",
        "l_extendedprice as fare_amount",
        "l_discount as extra",
        "l_tax as mta_tax",
        "l_discount * 100 as tip_amount",
        "l_quantity as tolls_amount",
        "0.3D as improvement_surcharge",
        "l_extendedprice + l_quantity as total_amount",
        "case when l_tax > 0 then 2.5D end as congestion_surcharge",
        "case when l_discount > 0 then 1.25D end as airport_fee",
    )


def zone_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("locationid"),
        F.col("r_name").alias("borough"),
        F.when(F.col("n_nationkey") == 24, F.lit("NATION_23")).otherwise(F.col("n_name")).alias("zone"),
        F.when(F.col("n_regionkey") == 1, F.lit("Yellow Zone"))
        .otherwise(F.lit("Boro Zone"))
        .alias("service_zone"),
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested archive records, plus the hour they belong to."""
    k = F.from_json("props", "k bigint")["k"]

    def point(name, amount):
        return F.struct(F.lit(name).alias("name"), amount.cast("double").alias("amount"))

    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.struct(
            F.col("user_id").alias("id"), F.concat(F.lit("user-"), F.col("user_id")).alias("login")
        ).alias("actor"),
        F.struct(
            F.struct(F.col("value").alias("amount"), k.alias("k")).alias("size"),
            F.array(point("value", F.col("value")), point("k", k)).alias("points"),
        ).alias("payload"),
        F.date_format("ts", "yyyy-MM-dd-H").alias("hour"),
    )


EVENT_SCHEMA = """
    id string, type string, created_at string,
    actor struct<id: bigint, login: string>,
    payload struct<size: struct<amount: double, k: bigint>,
                   points: array<struct<name: string, amount: double>>>
"""


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    return stream.parquet(f"{sf_dir}/events.parquet*").select(
        F.col("event_type").alias("vendor_id"), "ts", "value"
    )


def event_files(spark: SparkSession, sf_dir: str, files: int = 4) -> DataFrame:
    """The events as a stream of several files in the order of time, one for each batch."""
    events = table(spark, sf_dir, "events")

    def write(root: str) -> str:
        events.repartitionByRange(files, "ts").write.parquet(root)
        return root

    root = _once(spark, sf_dir, "event-files", write)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(root)
    return stream.select(F.col("event_type").alias("vendor_id"), "ts", "value")


def _once(spark: SparkSession, sf_dir: str, kind: str, write) -> tuple:
    """Input files that several queries read are written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _written:
        _written[key] = write(scratch_dir(spark, kind))
    return _written[key]


def _write_months(df: DataFrame, ts_col: str, root: str) -> None:
    _write_by_ym(df.withColumn("ym", F.date_format(ts_col, "yyyy-MM")), root)


def _write_by_ym(monthly: DataFrame, root: str) -> None:
    """Month folders straight from the scan: each task sorts its own rows by month, nothing is shuffled.

    A month has a file from each task that met it, as many as the scan has splits.
    """
    monthly.write.mode("append").partitionBy("ym").parquet(root)


def _month_span(df: DataFrame, ts_col: str) -> list[str]:
    first, last = df.agg(
        F.date_format(F.min(ts_col), "yyyy-MM"), F.date_format(F.max(ts_col), "yyyy-MM")
    ).first()
    return month_keys(first, last)


def uniform_months(spark: SparkSession, sf_dir: str, service: str) -> tuple[str, list[str]]:
    """A service's month files of one schema: path template and month list."""
    pickup = SERVICES[service][0]

    def write(root: str) -> tuple[str, list[str]]:
        raw = raw_trips(spark, sf_dir, service)
        _write_months(raw, pickup, root)
        return f"{root}/ym={{ym}}", _month_span(raw, pickup)

    return _once(spark, sf_dir, f"uniform-{service}", write)


def drifting_months(spark: SparkSession, sf_dir: str, service: str = "Yellow") -> tuple[str, list[str]]:
    """A service's month files whose schema changes twice: path template and month list.

    The first years lack two columns, the middle years hold other numeric types and count pickup
    times in microseconds, the last years have every column.
    """

    def write(root: str) -> tuple[str, list[str]]:
        raw = raw_trips(spark, sf_dir, service)
        pickup, dropoff = SERVICES[service]
        second, third = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in DRIFT_YEARS)
        early = raw.where(F.col(pickup) < second).drop("congestion_surcharge", "airport_fee")
        middle = raw.where((F.col(pickup) >= second) & (F.col(pickup) < third)).drop("airport_fee")
        late = raw.where(F.col(pickup) >= third)
        middle = middle.withColumns(
            {
                "ym": F.date_format(pickup, "yyyy-MM"),
                "VendorID": F.col("VendorID").cast("int"),
                "passenger_count": F.col("passenger_count").cast("double"),
                "payment_type": F.col("payment_type").cast("double"),
                pickup: F.unix_micros(F.col(pickup).cast("timestamp")),
                dropoff: F.unix_micros(F.col(dropoff).cast("timestamp")),
            }
        )
        _write_months(early, pickup, root)
        _write_by_ym(middle, root)
        _write_months(late, pickup, root)
        return f"{root}/ym={{ym}}", _month_span(raw, pickup)

    return _once(spark, sf_dir, f"drifting-{service}", write)


def stored_by_month(spark: SparkSession, sf_dir: str, name: str, build, ts_col: str) -> DataFrame:
    """A mart stored by month, made once per session."""

    def write(root: str) -> tuple[str, StructType]:
        mart = build()
        write_by_month(mart, root, ts_col)
        return root, StructType([*mart.schema.fields, StructField(MONTH_COLUMN, StringType())])

    root, schema = _once(spark, sf_dir, name, write)
    return spark.read.schema(schema).parquet(root)


def event_archive(spark: SparkSession, sf_dir: str) -> tuple[str, list[str]]:
    """Hourly gzip NDJSON of all events: root folder and hour list (one hour past the end)."""

    def write(root: str) -> tuple[str, list[str]]:
        records = event_records(spark, sf_dir)
        writer = records.hint("rebalance", "hour").write.partitionBy("hour")
        writer.option("compression", "gzip").json(root)
        ts = table(spark, sf_dir, "events").agg(
            F.date_trunc("hour", F.min("ts")), F.date_trunc("hour", F.max("ts")) + F.expr("interval 1 hour")
        )
        return root, hour_keys(*ts.first())

    return _once(spark, sf_dir, "event-archive", write)


def written_zone_seed(spark: SparkSession, sf_dir: str) -> str:
    """Zone seed as a quoted CSV folder with a header."""

    def write(root: str) -> tuple[str]:
        zone_seed(spark, sf_dir).write.option("header", True).option("quoteAll", True).csv(root)
        return (root,)

    return _once(spark, sf_dir, "zone-seed", write)[0]


def drifting_archive(spark: SparkSession, sf_dir: str) -> str:
    """Hour folders of all events whose shape goes by the hour modulo 3.

    0: whole amounts, users by number; 1: amounts with a fraction, users by text and a note that is
    null; 2: no amounts, users as objects.
    """

    def write(root: str) -> str:
        events = table(spark, sf_dir, "events").withColumn("kind", F.hour("ts") % 3)
        cents = F.floor("value").cast("decimal(18, 0)") + F.lit("0.25").cast("decimal(3, 2)")
        shapes = [
            (F.floor("value").alias("amount"), F.col("user_id").alias("user")),
            (
                cents.alias("amount"),
                F.concat(F.lit("u"), "user_id").alias("user"),
                F.lit(None).cast("string").alias("note"),
            ),
            (F.struct(F.col("user_id").alias("id")).alias("user"),),
        ]
        texts = [
            F.when(
                F.col("kind") == i, F.to_json(F.struct(F.col("event_id").alias("id"), *shape), {"ignoreNullFields": "false"})
            )
            for i, shape in enumerate(shapes)
        ]
        lines = events.select(F.coalesce(*texts).alias("value"), F.date_format("ts", "yyyy-MM-dd-H").alias("hour"))
        lines.hint("rebalance", "hour").write.partitionBy("hour").option("compression", "gzip").text(root)
        return root

    return _once(spark, sf_dir, "drifting-archive", write)
