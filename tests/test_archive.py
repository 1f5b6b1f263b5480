from __future__ import annotations

import glob
import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.operators.flatten import normalize_json
from tripmill.plans.archive import export_sample, load_archive
from tripmill.sources import events

RECORDS = [
    {
        "id": "1",
        "type": "PushEvent",
        "created_at": "2024-01-01T00:00:01Z",
        "actor": {"id": 7, "org": {"name": "o"}},
        "tags": ["x", "y"],
        "commits": [
            {"sha": "a", "author": {"name": "n"}, "files": [{"p": "f1"}, {"p": "f2"}]},
            {"sha": "b", "author": None, "files": []},
        ],
    },
    {"id": "2", "type": "WatchEvent", "created_at": "2024-01-01T01:00:00Z", "actor": {"id": 8}, "tags": []},
]
DDL = """id string, type string, created_at string, actor struct<id: bigint, org: struct<name: string>>,
    tags array<string>,
    commits array<struct<sha: string, author: struct<name: string>, files: array<struct<p: string>>>>"""
HOURS = ["2024-01-01-0", "2024-01-01-1", "2024-01-01-2"]


@pytest.fixture
def root(tmp_path):
    for hour, record in zip(HOURS, RECORDS):
        with gzip.open(tmp_path / f"{hour}.json.gz", "wt") as f:
            f.write(json.dumps(record) + "\n")
    return str(tmp_path)


@pytest.fixture
def schema():
    return T.StructType.fromDDL(DDL)


def test_hours_without_a_file_give_no_rows(spark, root, schema):
    assert events.read_hours(spark, root, HOURS, schema).count() == 2
    assert events.read_hours(spark, root, HOURS[1:], schema).first().id == "2"
    nothing = events.read_hours(spark, root, ["2030-01-01-0"], schema)
    assert nothing.count() == 0 and nothing.schema == schema


def test_hour_folders_are_pruned(spark, root, schema, tmp_path):
    out = str(tmp_path / "folders")
    records = events.read_hours(spark, root, HOURS, schema)
    hourly = records.withColumn("hour", F.concat(F.lit("2024-01-01-"), F.col("id").cast("int") - 1))
    hourly.write.partitionBy("hour").option("compression", "gzip").json(out)
    some = events.read_hour_folders(spark, out, HOURS[1:], schema)
    assert some.schema == schema and [r.id for r in some.collect()] == ["2"]
    assert "PartitionFilters: [hour" in some._jdf.queryExecution().executedPlan().toString()
    assert sorted(events.read_hour_folders(spark, out, HOURS, schema).collect()) == sorted(records.collect())


def test_malformed_line_stops_the_load(spark, root, schema):
    with gzip.open(f"{root}/2024-01-01-2.json.gz", "wt") as f:
        f.write('{"id": \n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        events.read_hours(spark, root, HOURS, schema).collect()


def test_inferred_schema(spark, root):
    df = events.read_ndjson(spark, f"{root}/*.json.gz")
    assert df.schema["actor"].dataType.simpleString() == "struct<id:bigint,org:struct<name:string>>"


def test_count_and_sample(spark, root, schema):
    df = events.read_hours(spark, root, HOURS, schema)
    assert events.row_count(df).first().cnt == 2
    assert [tuple(r) for r in events.sample_events(df).collect()] == [
        ("1", "PushEvent", "2024-01-01T00:00:01Z"),
        ("2", "WatchEvent", "2024-01-01T01:00:00Z"),
    ]


def test_nested_records_become_flat_tables(spark, root, schema):
    tables = normalize_json(events.read_hours(spark, root, HOURS, schema), "events", "id")
    assert set(tables) == {"events", "events__tags", "events__commits", "events__commits__files"}
    assert tables["events"].columns == ["id", "type", "created_at", "actor__id", "actor__org__name"]
    assert sorted(tuple(r) for r in tables["events__tags"].collect()) == [("1", 0, "x"), ("1", 1, "y")]
    commits = tables["events__commits"]
    assert commits.columns == ["parent_id", "list_idx", "sha", "author__name"]
    assert sorted(tuple(r)[:3] for r in commits.collect()) == [("1", 0, "a"), ("1", 1, "b")]
    files = tables["events__commits__files"]
    assert sorted(tuple(r) for r in files.collect()) == [("1", 0, 0, "f1"), ("1", 0, 1, "f2")]
    assert files.columns == ["parent_parent_id", "parent_list_idx", "list_idx", "p"]


def test_loads_append(spark, root, schema, tmp_path):
    out = str(tmp_path / "out")
    for n in (1, 2):
        tables = load_archive(events.read_hours(spark, root, HOURS, schema), out)
        assert tables["events"].count() == 2 * n and tables["events__tags"].count() == 2 * n


def test_sample_export(spark, root, schema, tmp_path):
    out = str(tmp_path / "sample")
    export_sample(events.read_hours(spark, root, HOURS, schema), out, n=1)
    lines = [json.loads(line) for f in glob.glob(f"{out}/*.json") for line in open(f)]
    assert [r["id"] for r in lines] == ["1"] and lines[0]["actor"] == {"id": 7, "org": {"name": "o"}}


def _texts(spark, rows):
    return spark.createDataFrame(rows, "hour string, value string")


def test_field_shapes_report_what_differs_between_hours(spark):
    texts = _texts(
        spark,
        [
            ("a", '{"n": 1, "s": "x", "o": {"p": 1}}'),
            ("a", '{"n": 2.5, "s": null}'),
            ("b", '{"n": "7", "o": {"p": 1, "q": [true]}}'),
            ("b", "{broken"),
            ("b", "[1]"),
            ("b", None),
        ],
    )
    got = {r.field: tuple(r)[1:] for r in events.field_shapes(texts).collect()}
    assert got == {
        "n": (2, 3, "DECIMAL; STRING", "VARIANT"),
        "s": (1, 2, "STRING", "STRING"),
        "o": (2, 2, "OBJECT<p: BIGINT, q: ARRAY<BOOLEAN>>; OBJECT<p: BIGINT>", "OBJECT<p: BIGINT, q: ARRAY<BOOLEAN>>"),
    }
    assert events.field_shapes(texts.limit(0)).count() == 0


def test_unified_events_keep_every_value(spark):
    big = 2**53 + 1
    texts = _texts(
        spark,
        [
            ("a", f'{{"n": {big}, "odd name": {{"VOID": 1}}, "m": 1, "z": null}}'),
            ("b", '{"n": 0.5, "m": "one"}'),
            ("b", "{broken"),
            ("b", "[1, 2]"),
            ("b", None),
        ],
    )
    out = events.read_unified(texts)
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert types["m"] == "variant" and types["z"] == "string" and types["odd name"] == "struct<VOID:bigint>"
    rows = out.withColumn("m", F.variant_get("m", "$", "string")).collect()
    assert sorted(int(r.n * 2) for r in rows if r.n is not None) == [1, 2 * big]
    assert {r.m for r in rows} == {"1", "one", None}
    assert {r._corrupt for r in rows} == {"{broken", "[1, 2]", None} and len(rows) == 5
    assert events.read_unified(texts.where("value is null")).columns == ["hour", "_corrupt"]
    with pytest.raises(ValueError, match="HOUR"):
        events.read_unified(_texts(spark, [("a", '{"HOUR": 1}')]))
