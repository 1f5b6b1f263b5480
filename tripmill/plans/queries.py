"""Every registered query: (spark, folder of test tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.calendar import month_calendar
from tripmill.operators import align, core, flatten, marts, quality, serving, staging
from tripmill.plans import archive, warehouse
from tripmill.plans.ingest import ingest_service, load_types
from tripmill.plans.live_stats import rejected, trip_stats
from tripmill.schemas import SERVICES, TRIP_STATS, TRIP_STATS_KEY
from tripmill.session import prepare, scratch_dir
from tripmill.sinks import keyed, tables
from tripmill.sources import events as event_source
from tripmill.sources import months, testtables, topics, zones
from tripmill.streaming import arrival, live, messages, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

YEARS = list(range(1995, 2002))
VOLUMES = [
    quality.Volume("Yellow", "tpep_pickup_datetime", "1999-03", 100),
    quality.Volume("Green", "lpep_pickup_datetime", "1999-03", 10_000),
]


def query(*inputs: str):
    """Register a query over the named tables."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[fn.__name__] = run
        return run

    return register


def _raw(spark, sf_dir):
    return {s: testtables.raw_trips(spark, sf_dir, s) for s in SERVICES}


def _both(spark, sf_dir):
    """Raw trips of both services, with the service and the pickup time under one name."""
    parts = [
        df.withColumn("service_type", F.lit(s)).withColumnRenamed(SERVICES[s][0], "pickup").drop(SERVICES[s][1])
        for s, df in _raw(spark, sf_dir).items()
    ]
    return parts[0].unionByName(parts[1])


def _staged(spark, sf_dir):
    return {s: staging.stage_trips(df, s) for s, df in _raw(spark, sf_dir).items()}


def _facts(spark, sf_dir):
    return warehouse.facts(_raw(spark, sf_dir), testtables.zone_seed(spark, sf_dir))


def _zone_mart(spark, sf_dir):
    return marts.monthly_zone_revenue(_facts(spark, sf_dir))


def _stored_mart(spark, sf_dir):
    """The zone mart as dashboards find it: stored by month."""
    return testtables.stored_by_month(spark, sf_dir, "zone-mart", lambda: _zone_mart(spark, sf_dir), "revenue_month")


def _citywide(spark, sf_dir):
    return marts.citywide_monthly(_stored_mart(spark, sf_dir))


def _one_name(df, service):
    """A service's rows with the service, and its times under common names."""
    pickup, dropoff = SERVICES[service]
    named = df.withColumnRenamed(pickup, "pickup").withColumnRenamed(dropoff, "dropoff")
    return named.withColumn("service_type", F.lit(service))


def _merged(spark, sf_dir, service):
    return align.merge_months(spark, *testtables.drifting_months(spark, sf_dir, service), SERVICES[service])


def _per_service(part):
    """What ``part`` gives for each service, one under the other."""
    parts = [part(s) for s in SERVICES]
    return parts[0].unionByName(parts[1])


def _event_counts(spark, sf_dir):
    return windows.tumbling_counts(testtables.table(spark, sf_dir, "events"), "ts", "event_type")


def _archive(spark, sf_dir):
    root, hours = testtables.event_archive(spark, sf_dir)
    schema = T.StructType.fromDDL(testtables.EVENT_SCHEMA)
    return event_source.read_hour_folders(spark, root, hours, schema)


# --- sources and ingest -----------------------------------------------------------------------


@query("lineitem")
def scan_trips(spark, sf_dir):
    """Scan of a monthly file set with one schema."""

    def scan(service):
        trips = months.scan_months(spark, *testtables.uniform_months(spark, sf_dir, service))
        return _one_name(trips, service).select(
            "service_type", "VendorID", "pickup", "PULocationID", "trip_distance", "total_amount"
        )

    return _per_service(scan)


@query("lineitem")
def month_calendar_keys(spark, sf_dir):
    bounds = testtables.table(spark, sf_dir, "lineitem").agg(
        F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last")
    )
    return month_calendar(bounds, "first", "last")


@query("lineitem")
def month_coverage(spark, sf_dir):
    """Months without a file, two months around the files included; no file is opened."""

    def absent(service):
        template, _ = testtables.uniform_months(spark, sf_dir, service)
        listed = months.listed_months(spark, template)
        first = F.to_date(F.concat("ym", F.lit("-01")))
        bounds = listed.agg(F.add_months(F.min(first), -2).alias("first"), F.add_months(F.max(first), 2).alias("last"))
        return months.missing_months(month_calendar(bounds, "first", "last"), listed).select(
            F.lit(service).alias("service_type"), "ym"
        )

    return _per_service(absent)


@query("nation", "region")
def dim_zones(spark, sf_dir):
    seed = zones.read_zone_seed(spark, testtables.written_zone_seed(spark, sf_dir))
    return core.dim_zones(seed)


@query("lineitem")
def schema_unify(spark, sf_dir):
    """The unified schema of the drifting months, with each column's non-null count."""

    def columns(service):
        merged = _merged(spark, sf_dir, service)
        counts = merged.agg(*[F.count(c).alias(c) for c in merged.columns])
        rows = [
            F.struct(
                F.lit(service).alias("service_type"),
                F.lit(i).cast("bigint").alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("type_name"),
                F.col(f.name).alias("non_null"),
            )
            for i, f in enumerate(merged.schema.fields)
        ]
        return counts.select(F.inline(F.array(*rows)))

    return _per_service(columns)


@query("lineitem")
def schema_align(spark, sf_dir):
    """Trips forced into another schema: truncated, widened, padded, reordered, cut."""
    target = T.StructType(
        [
            T.StructField("fare_amount", T.LongType()),
            T.StructField("RatecodeID", T.LongType()),
            T.StructField("VendorID", T.DoubleType()),
            T.StructField("ehail_fee", T.DoubleType()),
            T.StructField("passenger_count", T.LongType()),
            T.StructField("pickup", T.TimestampNTZType()),
            T.StructField("service_type", T.StringType()),
        ]
    )
    return _per_service(lambda s: align.align_to_schema(_one_name(testtables.raw_trips(spark, sf_dir, s), s), target))


@query("lineitem")
def ts_normalize(spark, sf_dir):
    """Integer microseconds and zoned timestamps back to zone-less timestamps."""
    lines = testtables.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("tpep_pickup_datetime"),
        F.col("l_shipdate").cast("timestamp").alias("tpep_dropoff_datetime"),
    )
    return align.normalize_timestamps(lines, SERVICES["Yellow"])


@query("lineitem")
def merge_months(spark, sf_dir):
    return _per_service(lambda s: _one_name(_merged(spark, sf_dir, s), s))


@query("lineitem")
def load_schema(spark, sf_dir):
    """Raw trips in the warehouse's types."""
    return _per_service(lambda s: _one_name(load_types(testtables.raw_trips(spark, sf_dir, s)), s))


@query("lineitem")
def profile_years(spark, sf_dir):

    def profile(service):
        years = align.profile_years(_merged(spark, sf_dir, service), SERVICES[service][0])
        return years.withColumn("service_type", F.lit(service))

    return _per_service(profile)


@query("lineitem")
def partitioned_write(spark, sf_dir):
    """Months merged into the day-partitioned, clustered raw table; all days read back."""
    template, keys = testtables.drifting_months(spark, sf_dir)
    out = scratch_dir(spark, "raw-yellow")
    loaded = ingest_service(spark, "Yellow", template, keys, out, VOLUMES, skip_checks=True)
    return loaded.groupBy(F.col(tables.DAY_COLUMN).cast("string").alias("day")).agg(
        F.count("*").alias("trips"),
        F.sum("passenger_count").cast("bigint").alias("passengers"),
    )


@query("lineitem")
def catalog_reload(spark, sf_dir):
    """A catalog table by month of both services, in which one month, first loaded wrong, is loaded again."""
    database, again = f"trips_{uuid.uuid4().hex[:12]}", "1999-03"
    place, out = scratch_dir(spark, database), scratch_dir(spark, "reloaded")
    trips = _both(spark, sf_dir)
    wrong = F.date_format("pickup", "yyyy-MM") == again
    try:
        tables.ensure_database(spark, database, place)
        first = trips.withColumn("passenger_count", F.when(wrong, -1).otherwise(F.col("passenger_count")))
        tables.load_catalog(first, f"{database}.trips", "pickup", "month")
        loaded = tables.load_catalog(marts.month_range(trips, "pickup", again), f"{database}.trips", "pickup", "month")
        by_month = loaded.groupBy("service_type", F.date_format("pickup_month", "yyyy-MM").alias("ym")).agg(
            F.count("*").alias("trips"), F.sum("passenger_count").cast("bigint").alias("passengers")
        )
        by_month.write.parquet(out)
        return spark.read.schema(by_month.schema).parquet(out)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


@query("lineitem")
def trip_payload(spark, sf_dir):
    return messages.trip_payload(testtables.raw_trips(spark, sf_dir, "Green"))


# --- staging and core -------------------------------------------------------------------------


@query("lineitem")
def filter_not_null(spark, sf_dir):
    kept = [staging.drop_null_vendor(df).select("VendorID") for df in _raw(spark, sf_dir).values()]
    return kept[0].unionByName(kept[1]).groupBy("VendorID").agg(F.count("*").alias("trips"))


@query("lineitem")
def dedup_first(spark, sf_dir):
    raw = testtables.raw_trips(spark, sf_dir, "Yellow").drop("airport_fee")
    keys = ["tpep_pickup_datetime", "VendorID"]
    order = ["tpep_dropoff_datetime", *[c for c in raw.columns if c not in (*keys, "tpep_dropoff_datetime")]]
    return staging.dedup_first(raw, keys, order)


@query("lineitem")
def stg_trips(spark, sf_dir):
    return core.union_services(_staged(spark, sf_dir))


@query("lineitem")
def stg_trips_warehouse_key(spark, sf_dir):
    """Keys over the text of a zoned warehouse timestamp."""
    staged = staging.stage_trips(testtables.raw_trips(spark, sf_dir, "Green"), "Green", "+00")
    return staged.select("tripid", "vendorid", "pickup_datetime")


@query("lineitem")
def union_services(spark, sf_dir):
    trips = core.union_services(_staged(spark, sf_dir))
    return trips.groupBy("service_type").agg(
        F.count("*").alias("trips"), F.sum("passenger_count").alias("passengers")
    )


@query("lineitem", "nation", "region")
def join_pickup_zone(spark, sf_dir):
    trips = _both(spark, sf_dir).withColumnRenamed("PULocationID", "pickup_locationid")
    dim = core.dim_zones(testtables.zone_seed(spark, sf_dir))
    return core.join_zone(trips, dim, "pickup").select(
        "service_type", "pickup_locationid", "pickup_borough", "pickup_zone", "pickup", "fare_amount"
    )


@query("lineitem", "nation", "region")
def join_role_playing(spark, sf_dir):
    trips = _both(spark, sf_dir).withColumnsRenamed(
        {"PULocationID": "pickup_locationid", "DOLocationID": "dropoff_locationid"}
    )
    dim = core.dim_zones(testtables.zone_seed(spark, sf_dir))
    both = core.join_zone(core.join_zone(trips, dim, "pickup"), dim, "dropoff")
    return both.groupBy("pickup_zone", "dropoff_zone", "dropoff_borough").agg(F.count("*").alias("trips"))


@query("lineitem", "nation", "region")
def unmatched_zones(spark, sf_dir):
    trips = core.union_services(_staged(spark, sf_dir))
    return core.unmatched_zones(trips, core.dim_zones(testtables.zone_seed(spark, sf_dir)))


@query("lineitem", "nation", "region")
def fact_trips(spark, sf_dir):
    return _facts(spark, sf_dir)


# --- marts and serving ------------------------------------------------------------------------


@query("lineitem", "nation", "region")
def monthly_zone_revenue(spark, sf_dir):
    return _zone_mart(spark, sf_dir)


@query("lineitem", "nation", "region")
def citywide_monthly(spark, sf_dir):
    return _citywide(spark, sf_dir)


@query("lineitem", "nation", "region")
def service_type_totals(spark, sf_dir):
    return marts.service_type_totals(_citywide(spark, sf_dir))


@query("lineitem", "nation", "region")
def monthly_totals(spark, sf_dir):
    return serving.monthly_totals(_stored_mart(spark, sf_dir))


@query("lineitem", "nation", "region")
def top_zones(spark, sf_dir):
    return serving.top_zones(_stored_mart(spark, sf_dir))


@query("lineitem", "nation", "region")
def mart_filtered(spark, sf_dir):
    return serving.filter_mart(_stored_mart(spark, sf_dir), "1998-01-01", "1999-12-31", "Green")


@query("lineitem", "nation", "region")
def service_share(spark, sf_dir):
    return serving.service_share(marts.service_type_totals(_citywide(spark, sf_dir)))


@query("lineitem", "nation", "region")
def month_by_year(spark, sf_dir):
    return serving.month_by_year(_citywide(spark, sf_dir), YEARS)


@query("lineitem", "nation", "region")
def yoy_monthly(spark, sf_dir):
    return serving.yoy_monthly(_citywide(spark, sf_dir))


@query("lineitem")
def month_filter_count(spark, sf_dir):
    """Trips of one month, by service."""
    counts = [
        marts.count_rows(marts.month_range(df, SERVICES[s][0], "1999-03")).withColumn("service_type", F.lit(s))
        for s, df in _raw(spark, sf_dir).items()
    ]
    return counts[0].unionByName(counts[1])


@query("lineitem", "nation", "region")
def warehouse_build(spark, sf_dir):
    """Every model stored in a database of its own; the citywide mart read back."""

    def build(seed, label):
        models = warehouse.build_models(spark, _raw(spark, sf_dir), seed, label, scratch_dir(spark, label))
        return models["citywide_monthly"]

    return _built(spark, sf_dir, build)


def _built(spark, sf_dir, build):
    """What a build returns, kept when its database has been dropped."""
    label = f"trips_{uuid.uuid4().hex[:12]}"
    seed = zones.read_zone_seed(spark, testtables.written_zone_seed(spark, sf_dir))
    try:
        result, out = build(seed, label), scratch_dir(spark, "built")
        result.write.parquet(out)
        return spark.read.schema(result.schema).parquet(out)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{label}` CASCADE")


# --- data quality -----------------------------------------------------------------------------


@query("lineitem")
def dq_not_null(spark, sf_dir):
    columns = ["VendorID", "PULocationID", "congestion_surcharge"]
    parts = [
        quality.column_checks(df, [quality.NotNull(s.lower(), c) for c in [SERVICES[s][0], *columns]])
        for s, df in _raw(spark, sf_dir).items()
    ]
    return parts[0].unionByName(parts[1])


@query("lineitem")
def dq_accepted_values(spark, sf_dir):
    accepted = {"VendorID": (1, 2), "payment_type": (1, 2, 3)}
    parts = [
        quality.column_checks(df, [quality.Accepted(s.lower(), c, v) for c, v in accepted.items()])
        for s, df in _raw(spark, sf_dir).items()
    ]
    return parts[0].unionByName(parts[1])


@query("lineitem")
def dq_unique(spark, sf_dir):
    """Trip keys that occur in both services."""
    return quality.unique_violations(core.union_services(_staged(spark, sf_dir)), "tripid")


@query("lineitem")
def grain_violations(spark, sf_dir):
    """Raw trips that repeat a vendor and pickup time."""
    return quality.grain_violations(_both(spark, sf_dir), ["service_type", "VendorID", "pickup"])


@query("lineitem", "nation", "region")
def mart_grain(spark, sf_dir):
    """Mart keys that occur twice; none should."""
    return quality.grain_violations(
        _zone_mart(spark, sf_dir), ["revenue_zone", "revenue_month", "service_type"]
    )


@query("lineitem")
def dq_volume(spark, sf_dir):
    return quality.volume_checks(_raw(spark, sf_dir), VOLUMES)


@query("lineitem", "nation", "region")
def dq_report(spark, sf_dir):
    """All 32 model checks over the stored models."""

    def build(seed, label):
        place = scratch_dir(spark, label)
        return warehouse.build_and_check(spark, _raw(spark, sf_dir), seed, label, place, report_only=True)[1]

    return _built(spark, sf_dir, build)


# --- event archive ----------------------------------------------------------------------------


@query("events")
def events_json_scan(spark, sf_dir):
    return _archive(spark, sf_dir).select("id", "type", "created_at", F.col("actor.id").alias("actor_id"))


@query("events")
def events_json_inferred(spark, sf_dir):
    root, _ = testtables.event_archive(spark, sf_dir)
    inferred = event_source.read_ndjson(spark, root)
    return inferred.groupBy("type").agg(
        F.count("*").alias("cnt"), F.sum("payload.size.k").alias("k_total")
    )


@query("events")
def events_field_shapes(spark, sf_dir):
    """Types of each field over hours whose payloads differ."""
    return event_source.field_shapes(event_source.read_texts(spark, testtables.drifting_archive(spark, sf_dir)))


@query("events")
def events_json_unified(spark, sf_dir):
    """The same hours read with the types that hold all of them."""
    texts = event_source.read_texts(spark, testtables.drifting_archive(spark, sf_dir))
    return event_source.read_unified(texts).select(
        "id",
        "hour",
        F.col("amount").cast("double").alias("amount"),
        F.variant_get("user", "$", "string").alias("user"),
        F.try_variant_get("user", "$.id", "bigint").alias("user_id"),
        F.col("note").isNull().alias("no_note"),
        F.col("_corrupt").isNull().alias("readable"),
    )


@query("events")
def events_count(spark, sf_dir):
    return event_source.row_count(_archive(spark, sf_dir))


@query("events")
def events_sample(spark, sf_dir):
    return event_source.sample_events(_archive(spark, sf_dir))


@query("events")
def json_flatten(spark, sf_dir):
    return flatten.normalize_json(_archive(spark, sf_dir), "events", "id")["events"]


@query("events")
def json_children(spark, sf_dir):
    return flatten.normalize_json(_archive(spark, sf_dir), "events", "id")["events__payload__points"]


@query("events")
def append_events(spark, sf_dir):
    """The archive loaded twice into the same tables: appends keep what is there."""
    out = scratch_dir(spark, "archive")
    for _ in range(2):
        loaded = archive.load_archive(_archive(spark, sf_dir), out)
    return loaded["events"].groupBy("type").agg(F.count("*").alias("cnt"))


@query("events")
def export_ndjson(spark, sf_dir):
    events = testtables.table(spark, sf_dir, "events")
    out = scratch_dir(spark, "sample")
    tables.export_ndjson(events, out, ["event_id"])
    return spark.read.schema(events.schema).option("timestampNTZFormat", tables.JSON_TIMESTAMP).json(out)


# --- windows and streams ----------------------------------------------------------------------


@query("events")
def tumble_counts(spark, sf_dir):
    return _event_counts(spark, sf_dir)


@query("events")
def latest_windows(spark, sf_dir):
    return serving.latest_windows(_event_counts(spark, sf_dir))


@query("events")
def vendor_activity(spark, sf_dir):
    return serving.vendor_activity(_event_counts(spark, sf_dir))


def _run_upsert(spark, counts):
    out = scratch_dir(spark, "upserts")
    live.upsert_open(counts, out, scratch_dir(spark, "offsets"), available_now=True).awaitTermination()
    return keyed.current_rows(spark, out, TRIP_STATS, TRIP_STATS_KEY)


def _run_append(spark, rows):
    out = scratch_dir(spark, "appends")
    live.append_closed(rows, out, scratch_dir(spark, "offsets"), available_now=True).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def _published_trips(spark, sf_dir):
    out = scratch_dir(spark, "topic")
    topics.publish_files(messages.trip_payload(testtables.raw_trips(spark, sf_dir, "Green")), out)
    return out


@query("lineitem")
def stream_json_parse(spark, sf_dir):
    """Trips published as JSON text and read back through a stream."""
    return _run_append(spark, messages.parse_messages(topics.file_topic(spark, _published_trips(spark, sf_dir))))


@query("lineitem")
def stream_replay(spark, sf_dir):
    """Published trips replayed a file at a time and counted per vendor and window."""
    topic = topics.file_topic(spark, _published_trips(spark, sf_dir), files_per_batch=4)
    return _run_upsert(spark, trip_stats(topic, event_time="lpep_pickup_datetime", lateness="3650 days"))


@query("events")
def stream_upsert(spark, sf_dir):
    """Counts of all windows, open ones included, kept current by key."""
    stream = windows.with_event_time(testtables.event_stream(spark, sf_dir), "ts", "30 days")
    return _run_upsert(spark, windows.tumbling_counts(stream, "ts"))


@query("events")
def stream_two_runs(spark, sf_dir):
    """Counts kept by key over two checkpoints in turn: the second adds to the log of the first."""
    out = scratch_dir(spark, "upserts")
    for _ in range(2):
        stream = windows.with_event_time(testtables.event_stream(spark, sf_dir), "ts", "30 days")
        counts = windows.tumbling_counts(stream, "ts")
        live.upsert_open(counts, out, scratch_dir(spark, "offsets"), available_now=True).awaitTermination()
    return keyed.current_rows(spark, out, TRIP_STATS, TRIP_STATS_KEY)


@query("events")
def stream_compacted(spark, sf_dir):
    """Counts kept by key over two checkpoints, a file at a time; every second batch compacts the log."""
    out = scratch_dir(spark, "upserts")
    for _ in range(2):
        stream = windows.with_event_time(testtables.event_files(spark, sf_dir), "ts", "3650 days")
        counts = windows.tumbling_counts(stream, "ts")
        live.upsert_open(
            counts, out, scratch_dir(spark, "offsets"), available_now=True, keys=TRIP_STATS_KEY, compact_every=2
        ).awaitTermination()
    return keyed.current_rows(spark, out, TRIP_STATS, TRIP_STATS_KEY)


@query("lineitem")
def stream_quarantine(spark, sf_dir):
    """A topic with broken texts and trips without a time: what is counted and what is kept apart."""
    trips = testtables.raw_trips(spark, sf_dir, "Green")
    no_time = F.col("passenger_count") == 7
    pickup = F.when(~no_time, F.col("lpep_pickup_datetime"))
    texts = messages.trip_payload(trips.withColumn("lpep_pickup_datetime", pickup))
    broken = F.col("value").contains('"passenger_count":6')
    texts = texts.select(F.when(broken, F.expr("left(value, 40)")).otherwise(F.col("value")).alias("value"))
    out = scratch_dir(spark, "topic")
    topics.publish_files(texts, out)
    counts = trip_stats(topics.file_topic(spark, out), "lpep_pickup_datetime", "3650 days", quarantine=True)
    counted = _run_upsert(spark, counts).agg(F.sum("trip_count").alias("messages"))
    apart = _run_append(spark, rejected(topics.file_topic(spark, out), "lpep_pickup_datetime"))
    return (
        apart.groupBy(F.col("reason").alias("outcome"))
        .agg(F.count("*").alias("messages"))
        .unionByName(counted.select(F.lit("counted").alias("outcome"), "messages"))
    )


@query("events")
def stream_closed_windows(spark, sf_dir):
    """Counts appended once per window, when the watermark has passed its end."""
    stream = windows.with_event_time(testtables.event_stream(spark, sf_dir), "ts")
    return _run_append(spark, windows.tumbling_counts(stream, "ts"))


@query("events")
def tumble_proctime(spark, sf_dir):
    """Counts per processing-time window, added up per vendor (arrival times differ by run)."""
    stream = windows.with_arrival_time(testtables.event_stream(spark, sf_dir))
    stats = _run_upsert(spark, windows.tumbling_counts(stream, "proc_time"))
    return stats.groupBy("vendor_id").agg(F.sum("trip_count").alias("trip_count"))


@query("events")
def stream_arrival_windows(spark, sf_dir):
    """Windows by arrival time that close by themselves: per vendor all rows, and what holds for every window."""
    seconds, out = 2, scratch_dir(spark, "arrivals")
    counts = arrival.arrival_counts(testtables.event_files(spark, sf_dir), f"{seconds} seconds")
    rows = testtables.table(spark, sf_dir, "events").count()
    query_ = live.append_arrivals(counts, out, scratch_dir(spark, "offsets"))

    def closed():
        # the sink's folder has no schema of its own before the first batch
        try:
            return spark.read.schema(TRIP_STATS).parquet(out)
        except AnalysisException as err:
            if "PATH_NOT_FOUND" not in str(err):
                raise
            return spark.createDataFrame([], TRIP_STATS)

    live.stop_when(query_, lambda: (closed().agg(F.sum("trip_count")).first()[0] or 0) >= rows)
    start, end = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("window_start", "window_end"))
    return closed().groupBy("vendor_id").agg(
        F.sum("trip_count").alias("trip_count"),
        F.min(end - start).alias("shortest"),
        F.max(end - start).alias("longest"),
        F.max(F.pmod(start, F.lit(seconds * 1_000_000))).alias("off_grid"),
        (F.count("*") - F.count_distinct("window_start")).alias("repeated"),
    )
