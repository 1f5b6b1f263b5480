from __future__ import annotations

import glob
import json
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from trips import raw

from tripmill.schemas import TRIP_STATS, TRIP_STATS_KEY
from tripmill.session import scratch_dir
from tripmill.sinks import keyed, tables

PICKUP = "tpep_pickup_datetime"


def days(spark):
    rows = [
        {"pickup": f"2019-03-{d:02d} 1{h}:00:00", "VendorID": v, "PULocationID": p}
        for d in (1, 2, 3)
        for h in range(3)
        for v in (2, 1)
        for p in (5, 4)
    ]
    return raw(spark, rows + [{"pickup": None}])


def test_day_partitions_prune_and_filter_exactly(spark, tmp_path):
    out = str(tmp_path / "t")
    tables.write_by_day(days(spark), out, PICKUP)
    stored = spark.read.parquet(out)
    assert stored.count() == 37
    part = tables.between_dates(stored, PICKUP, date(2019, 3, 2), date(2019, 3, 3))
    assert part.count() == 12
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "pickup_date" in filters
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan


def test_files_are_sorted_by_the_cluster_columns(spark, tmp_path):
    out = str(tmp_path / "t")
    tables.write_by_day(days(spark), out, PICKUP)
    files = glob.glob(f"{out}/pickup_date=2019*/*.parquet")
    assert len(files) == 3
    for f in files:
        t = pq.read_table(f, partitioning=None).select(["VendorID", "PULocationID"]).to_pylist()
        pairs = [(r["VendorID"], r["PULocationID"]) for r in t]
        assert pairs == sorted(pairs)


def test_a_huge_day_is_split_over_tasks(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    out = str(tmp_path / "t")
    hot = spark.range(200_000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, F.lit("2019-03-01 10:00:00"))
        .otherwise(F.concat(F.lit("2019-03-"), F.lpad((F.col("id") % 20 + 5).cast("string"), 2, "0")))
        .cast("timestamp_ntz")
        .alias(PICKUP),
        (F.col("id") % 7).alias("VendorID"),
        F.xxhash64("id").alias("PULocationID"),
    )
    tables.write_by_day(hot, out, PICKUP)
    assert len(glob.glob(f"{out}/pickup_date=2019-03-01/*.parquet")) > 4
    assert spark.read.parquet(out).count() == 200_000


def test_overwrite_replaces_and_append_adds(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.range(3)
    tables.write_flat(df, out)
    tables.write_flat(df, out)
    assert spark.read.parquet(out).count() == 3
    tables.append_rows(df, out)
    assert spark.read.parquet(out).count() == 6


@pytest.mark.parametrize("grain, column", [("day", "pickup_date"), ("month", "pickup_month")])
def test_a_reload_replaces_its_own_partitions(spark, grain, column):
    def trips(*rows):
        return spark.createDataFrame([(v, datetime(*t) if t else None) for v, *t in rows], "VendorID long, t timestamp_ntz").withColumn(
            "PULocationID", F.lit(7)
        )

    name = f"reload_{grain}.trips"
    tables.ensure_database(spark, f"reload_{grain}")
    tables.load_catalog(trips((1, 2020, 1, 5), (2, 2020, 1, 5), (3, 2020, 2, 6), (4,)), name, "t", grain)
    loaded = tables.load_catalog(trips((9, 2020, 1, 5)), name, "t", grain)
    assert sorted(r.VendorID for r in loaded.collect()) == [3, 4, 9]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    one = loaded.where(F.col(column) == F.lit("2020-02-01" if grain == "month" else "2020-02-06").cast("date"))
    assert [r.VendorID for r in one.collect()] == [3]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({column}" in plan and len(one.inputFiles()) == 1
    spark.sql(f"drop database reload_{grain} cascade")


def test_export_is_bounded_ordered_and_keeps_nulls(spark, tmp_path):
    out = str(tmp_path / "e")
    df = spark.createDataFrame([(i, None) for i in range(200, 0, -1)], "id int, note string")
    df = df.withColumn("at", F.lit("2024-01-01 00:00:00.123456").cast("timestamp_ntz"))
    tables.export_ndjson(df, out, ["id"])
    lines = [json.loads(line) for f in glob.glob(f"{out}/*.json") for line in open(f)]
    assert sorted(r["id"] for r in lines) == list(range(1, 101))
    assert lines[0]["note"] is None and lines[0]["at"] == "2024-01-01 00:00:00.123456"


def test_database_is_created_once(spark):
    tables.ensure_database(spark, "made_once")
    tables.ensure_database(spark, "made_once")
    assert spark.catalog.databaseExists("made_once")


@pytest.fixture
def changes(spark):
    def batch(*counts):
        start = datetime(2021, 1, 1)
        rows = [(v, n, start, start.replace(minute=5)) for v, n in counts]
        return spark.createDataFrame(rows, TRIP_STATS)

    return batch


def state(spark, path):
    rows = keyed.current_rows(spark, path, TRIP_STATS, TRIP_STATS_KEY)
    assert rows.columns == TRIP_STATS.names
    return {r.vendor_id: r.trip_count for r in rows.collect()}


def test_newest_row_of_a_key_wins(spark, tmp_path, changes):
    path = str(tmp_path / "log")
    write = keyed.upsert_writer(path)
    write(changes(("1", 5), ("2", 1)), 0)
    write(changes(("1", 7)), 1)
    write(changes(("3", 2)), 10)
    assert state(spark, path) == {"1": 7, "2": 1, "3": 2}


def test_replayed_batch_counts_once(spark, tmp_path, changes):
    path = str(tmp_path / "log")
    write = keyed.upsert_writer(path)
    write(changes(("1", 5)), 0)
    write(changes(("1", 5), ("2", 2)), 0)
    assert state(spark, path) == {"1": 5, "2": 2}


def test_compaction_keeps_the_state_and_yields_to_new_batches(spark, tmp_path, changes):
    path = str(tmp_path / "log")
    write = keyed.upsert_writer(path)
    write(changes(("1", 5), ("2", 1)), 0)
    write(changes(("1", 7)), 1)
    assert keyed.compact(spark, path, TRIP_STATS, TRIP_STATS_KEY) == 1
    assert state(spark, path) == {"1": 7, "2": 1}
    write(changes(("3", 4)), 2)
    keyed.upsert_writer(path)(changes(("2", 9)), 0)
    assert state(spark, path) == {"1": 7, "2": 9, "3": 4}
    assert keyed.compact(spark, path, TRIP_STATS, TRIP_STATS_KEY) == 2
    assert keyed.compact(spark, path, TRIP_STATS, TRIP_STATS_KEY) is None
    # an older run that goes on does not undo the newer one
    write(changes(("2", 1), ("4", 4)), 3)
    assert state(spark, path) == {"1": 7, "2": 9, "3": 4, "4": 4}


def test_compaction_rewrites_changed_buckets_only(spark, tmp_path, changes):
    path = str(tmp_path / "log")
    write = keyed.upsert_writer(path)
    write(changes(*[(str(i), i) for i in range(40)]), 0)
    keyed.compact(spark, path, TRIP_STATS, TRIP_STATS_KEY, buckets=8)
    write(changes(("7", 70)), 1)
    keyed.compact(spark, path, TRIP_STATS, TRIP_STATS_KEY, buckets=8)
    assert len(list((tmp_path / "log/base/gen=1").glob("bucket=*"))) == 8
    assert len(list((tmp_path / "log/base/gen=2").glob("bucket=*"))) == 1
    assert state(spark, path) == {str(i): 70 if i == 7 else i for i in range(40)}


def test_a_reader_outlives_the_next_compaction_and_old_files_go_after_it(spark, tmp_path, changes):
    path = str(tmp_path / "log")
    write = keyed.upsert_writer(path)
    write(changes(("1", 1), ("2", 2)), 0)
    reader = keyed.current_rows(spark, path, TRIP_STATS, TRIP_STATS_KEY)
    for batch in range(1, 5):
        keyed.compact(spark, path, TRIP_STATS, TRIP_STATS_KEY, buckets=1)
        if batch == 1:
            assert {r.vendor_id: r.trip_count for r in reader.collect()} == {"1": 1, "2": 2}
        write(changes(("1", 10 * batch)), batch)
    assert state(spark, path) == {"1": 40, "2": 2}
    left = sorted(p.name for p in (tmp_path / "log/manifest").glob("gen=*"))
    assert left == ["gen=3", "gen=4"] and not (tmp_path / "log/changes/run=1/batch_id=0").exists()


def test_what_is_not_whole_is_not_seen(spark, tmp_path, changes):
    path = str(tmp_path / "log")
    write = keyed.upsert_writer(path)
    write(changes(("1", 1)), 0)
    # a batch whose writer stopped before its mark, and a compaction that stopped before its manifest
    changes(("1", 99)).write.parquet(f"{path}/changes/run=1/batch_id=1")
    changes(("1", 99)).selectExpr("*", "9L as run", "9L as batch_id", "0 as bucket").write.partitionBy("bucket").parquet(f"{path}/base/gen=1")
    assert keyed.create_once(spark, f"{path}/claims/gen/1", "compaction")
    assert state(spark, path) == {"1": 1}
    assert keyed.compact(spark, path, TRIP_STATS, TRIP_STATS_KEY) == 2
    assert state(spark, path) == {"1": 1}
    write(changes(("1", 2)), 1)
    assert state(spark, path) == {"1": 2}


def test_runs_are_ordered_by_claim_and_known_by_their_checkpoint(spark, tmp_path):
    path = str(tmp_path / "log")
    assert [keyed.open_run(spark, path, x) for x in ("a", "b", "a", "", "")] == [1, 2, 1, 3, 4]


def test_scratch_lies_in_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_a_new_checkpoint_adds_to_the_log(spark, tmp_path, changes):
    path = str(tmp_path / "log")
    first = keyed.upsert_writer(path)
    first(changes(("1", 5), ("2", 1)), 0)
    first(changes(("1", 7)), 1)
    keyed.upsert_writer(path)(changes(("1", 9)), 0)
    assert state(spark, path) == {"1": 9, "2": 1}


def test_an_empty_log_has_no_rows(spark, tmp_path):
    assert state(spark, str(tmp_path / "nothing")) == {}
