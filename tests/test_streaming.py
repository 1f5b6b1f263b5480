from __future__ import annotations

import json
import os
import time
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from trips import raw

from tripmill.plans.live_stats import trip_stats
from tripmill.schemas import TRIP_MESSAGE, TRIP_STATS, TRIP_STATS_KEY
from tripmill.sinks.keyed import current_rows
from tripmill.sources.topics import file_topic, publish_files
from tripmill.streaming import live, messages, windows
from tripmill.streaming.arrival import arrival_counts

PICKUP = "lpep_pickup_datetime"


def test_payload_fields_and_null_rules(spark):
    df = raw(
        spark,
        [{"VendorID": None, "passenger_count": float("nan"), "trip_distance": float("nan"), "total_amount": None}],
        "Green",
        {"passenger_count": "double"},
    )
    text = messages.trip_payload(df).first().value
    assert list(json.loads(text).items()) == [
        ("vendor_id", 0),
        ("lpep_pickup_datetime", "2019-03-05 10:00:00"),
        ("lpep_dropoff_datetime", "2019-03-05 10:30:00"),
        ("passenger_count", 0),
        ("trip_distance", None),
        ("total_amount", None),
    ]


def test_payload_needs_its_columns(spark):
    with pytest.raises(ValueError, match=r"\['total_amount', 'trip_distance'\]"):
        messages.trip_payload(raw(spark, [{}], "Green").drop("trip_distance", "total_amount"))


def test_bounded_replay_takes_the_first_rows(spark):
    rows = [{"pickup": f"2019-03-05 10:{m:02d}:00"} for m in range(59, -1, -1)]
    out = messages.trip_payload(raw(spark, rows, "Green"), max_rows=50).collect()
    minutes = sorted(json.loads(r.value)[PICKUP][14:16] for r in out)
    assert minutes == [f"{m:02d}" for m in range(50)]


def send(folder, *batches):
    """One text file per batch, with file times in order."""
    os.makedirs(folder, exist_ok=True)
    have = len(os.listdir(folder))
    for i, batch in enumerate(batches, have):
        path = f"{folder}/{i:04d}.txt"
        with open(f"{path}.tmp", "w") as f:
            f.write("\n".join(m if isinstance(m, str) else json.dumps(m) for m in batch) + "\n")
        os.utime(f"{path}.tmp", (1_600_000_000 + i, 1_600_000_000 + i))
        os.replace(f"{path}.tmp", path)


def msg(vendor, at):
    return {"vendor_id": vendor, PICKUP: f"2021-01-01 {at}", "trip_distance": 1.5}


def rows_of(df):
    return {(r.vendor_id, f"{r.window_start:%H:%M}"): r.trip_count for r in df.collect()}


def stream_counts(spark, folder, lateness="0 seconds"):
    topic = file_topic(spark, folder, files_per_batch=1)
    return trip_stats(topic, event_time=PICKUP, lateness=lateness)


def run_append(spark, counts, tmp_path):
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")
    live.append_closed(counts, out, offsets, available_now=True).awaitTermination()
    return spark.read.schema(TRIP_STATS).parquet(out)


def test_absent_fields_are_null(spark, tmp_path):
    folder = str(tmp_path / "topic")
    send(folder, [msg(1, "00:00:00")])
    parsed = messages.parse_messages(spark.read.text(folder))
    assert parsed.schema == TRIP_MESSAGE
    assert parsed.first().passenger_count is None and parsed.first().trip_distance == 1.5


def test_malformed_message_stops_the_stream(spark, tmp_path):
    folder = str(tmp_path / "topic")
    send(folder, [msg(1, "00:00:00"), "{broken"])
    with pytest.raises(StreamingQueryException):
        run_append(spark, stream_counts(spark, folder), tmp_path)


def test_quarantine_keeps_the_text(spark, tmp_path):
    folder = str(tmp_path / "topic")
    send(folder, [msg(1, "00:00:00"), "{broken"])
    good, bad = messages.split_malformed(messages.parse_messages(spark.read.text(folder), quarantine=True))
    assert good.schema == TRIP_MESSAGE and good.count() == 1
    assert [r.value for r in bad.collect()] == ["{broken"]


BATCHES = [
    [msg(1, "00:00:00"), msg(1, "00:04:59"), msg(2, "00:01:00")],
    [msg(1, "00:05:00"), msg(2, "00:07:00"), msg(2, "00:09:59.999")],
    [msg(1, "00:12:00")],
]


def test_closed_windows_equal_the_batch_counts(spark, tmp_path):
    folder = str(tmp_path / "topic")
    send(folder, *BATCHES)
    got = rows_of(run_append(spark, stream_counts(spark, folder), tmp_path))
    trips = messages.parse_messages(spark.read.text(folder))
    batch = rows_of(windows.tumbling_counts(trips.withColumn(PICKUP, F.col(PICKUP).cast("timestamp_ntz")), PICKUP))
    assert batch == {("1", "00:00"): 2, ("2", "00:00"): 1, ("1", "00:05"): 1, ("2", "00:05"): 2, ("1", "00:10"): 1}
    # the window of the newest event is still open
    assert got == {k: n for k, n in batch.items() if k[1] != "00:10"}


def test_late_rows_are_dropped_unless_lateness_allows_them(spark, tmp_path):
    late = [*BATCHES, [msg(9, "00:01:00")], [msg(1, "00:20:00")]]
    send(str(tmp_path / "topic"), *late)
    strict = rows_of(run_append(spark, stream_counts(spark, str(tmp_path / "topic")), tmp_path / "a"))
    assert ("9", "00:00") not in strict
    patient = stream_counts(spark, str(tmp_path / "topic"), "15 minutes")
    assert rows_of(run_append(spark, patient, tmp_path / "b"))["9", "00:00"] == 1


def test_a_restart_goes_on_from_its_checkpoint(spark, tmp_path):
    folder = str(tmp_path / "topic")
    send(folder, *BATCHES[:2])
    run_append(spark, stream_counts(spark, folder), tmp_path)
    send(folder, *BATCHES[2:], [msg(1, "00:30:00")])
    got = rows_of(run_append(spark, stream_counts(spark, folder), tmp_path))
    assert got == {("1", "00:00"): 2, ("2", "00:00"): 1, ("1", "00:05"): 1, ("2", "00:05"): 2, ("1", "00:10"): 1}


def test_upserts_keep_open_windows_current(spark, tmp_path):
    folder, out = str(tmp_path / "topic"), str(tmp_path / "out")
    send(folder, *BATCHES, [msg(1, "00:13:00"), msg(1, "00:01:00")])
    counts = stream_counts(spark, folder, None)
    live.upsert_open(counts, out, str(tmp_path / "offsets"), available_now=True).awaitTermination()
    now = rows_of(current_rows(spark, out, TRIP_STATS, TRIP_STATS_KEY))
    assert now == {("1", "00:00"): 3, ("2", "00:00"): 1, ("1", "00:05"): 1, ("2", "00:05"): 2, ("1", "00:10"): 2}


def test_a_stream_goes_on_through_compactions(spark, tmp_path):
    topic, out, offsets = (str(tmp_path / x) for x in ("topic", "stats", "offsets"))
    for day in range(3):
        send(topic, [msg(1, f"0{day}:01:00"), msg(2, "00:02:00")])
        counts = stream_counts(spark, topic, lateness="30 days")
        live.upsert_open(counts, out, offsets, available_now=True, keys=TRIP_STATS_KEY, compact_every=2).awaitTermination()
    now = rows_of(current_rows(spark, out, TRIP_STATS, TRIP_STATS_KEY))
    assert now == {("1", "00:00"): 1, ("1", "01:00"): 1, ("1", "02:00"): 1, ("2", "00:00"): 3}
    # one checkpoint is one run, whatever the number of restarts
    assert [p.name for p in (tmp_path / "stats/claims/run").glob("[0-9]*")] == ["1"]
    assert list((tmp_path / "stats/manifest").glob("gen=*"))


def test_a_topic_can_start_at_its_latest_files(spark, tmp_path):
    folder = str(tmp_path / "topic")
    send(folder, *BATCHES)
    since = datetime.fromtimestamp(1_600_000_002)  # file time of the third batch
    topic = file_topic(spark, folder, files_per_batch=1, since=since)
    out = str(tmp_path / "out")
    counts = trip_stats(topic, event_time=PICKUP, lateness=None)
    live.upsert_open(counts, out, str(tmp_path / "offsets"), available_now=True).awaitTermination()
    assert rows_of(current_rows(spark, out, TRIP_STATS, TRIP_STATS_KEY)) == {("1", "00:10"): 1}


def test_processing_time_counts_every_row(spark, tmp_path):
    folder, out = str(tmp_path / "topic"), str(tmp_path / "out")
    send(folder, *BATCHES)
    counts = trip_stats(file_topic(spark, folder))
    live.upsert_open(counts, out, str(tmp_path / "offsets"), available_now=True).awaitTermination()
    stats = current_rows(spark, out, TRIP_STATS, TRIP_STATS_KEY).collect()
    per_vendor = {}
    for r in stats:
        per_vendor[r.vendor_id] = per_vendor.get(r.vendor_id, 0) + r.trip_count
        assert (r.window_end - r.window_start).seconds == 300 and r.window_start.minute % 5 == 0
        assert abs(r.window_start.timestamp() - time.time()) < 86_400
    assert per_vendor == {"1": 4, "2": 3}


def test_arrival_windows_close_without_further_input(spark, tmp_path):
    topic, out, offsets = (str(tmp_path / x) for x in ("topic", "stats", "offsets"))
    os.makedirs(topic)

    def closed():
        if not os.path.isdir(f"{out}/_spark_metadata"):
            return {}
        rows = spark.read.schema(TRIP_STATS).parquet(out).collect()
        assert all(r.window_end - r.window_start == timedelta(seconds=2) and r.window_start.second % 2 == 0 for r in rows)
        return Counter({v: sum(r.trip_count for r in rows if r.vendor_id == v) for v in {r.vendor_id for r in rows}})

    def run(until):
        vendors = spark.readStream.schema("vendor_id string").json(topic)
        query = live.append_arrivals(arrival_counts(vendors, "2 seconds"), out, offsets)
        live.stop_when(query, lambda: sum(closed().values()) >= until, 120)

    send(topic, [{"vendor_id": "1"}, {"vendor_id": "1"}, {"vendor_id": None}])
    run(3)
    assert closed() == {"1": 2, None: 1}
    send(topic, [{"vendor_id": "1"}])
    run(4)
    assert closed() == {"1": 3, None: 1}


def test_published_text_is_what_the_topic_reads(spark, tmp_path):
    folder = str(tmp_path / "topic")
    sent = messages.trip_payload(raw(spark, [{}, {"VendorID": 2}], "Green"))
    publish_files(sent, folder)
    got = messages.parse_messages(spark.read.text(folder)).orderBy("vendor_id").collect()
    assert [(r.vendor_id, r.lpep_dropoff_datetime) for r in got] == [
        (1, "2019-03-05 10:30:00"),
        (2, "2019-03-05 10:30:00"),
    ]


def test_window_of_a_zone_less_time_is_half_open(spark):
    df = spark.createDataFrame(
        [(1, datetime(2021, 1, 1, 0, 4, 59, 999999)), (1, datetime(2021, 1, 1, 0, 5))],
        "vendor_id int, t timestamp_ntz",
    )
    assert rows_of(windows.tumbling_counts(df, "t")) == {("1", "00:00"): 1, ("1", "00:05"): 1}
