from __future__ import annotations

import logging
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.operators import align
from tripmill.plans.ingest import ingest_service, load_types
from tripmill.operators.quality import Volume
from tripmill.sources import months

PICKUP = "tpep_pickup_datetime"


def ddl(text):
    return T.StructType.fromDDL(text)


def test_fields_keep_the_order_of_first_appearance():
    merged = align.unify_schemas([ddl("a int, b string"), ddl("c double, a int"), ddl("b string, d date")])
    assert merged.names == ["a", "b", "c", "d"]


def test_numeric_types_widen_unless_strict():
    schemas = [ddl("a int, b bigint"), ddl("a bigint, b double")]
    assert align.unify_schemas(schemas).simpleString() == "struct<a:bigint,b:double>"
    with pytest.raises(TypeError, match="'a'"):
        align.unify_schemas(schemas, strict=True)


def test_null_typed_column_takes_the_other_type():
    null = T.StructType([T.StructField("a", T.NullType())])
    for order in ([null, ddl("a double")], [ddl("a double"), null]):
        assert align.unify_schemas(order, strict=True)["a"].dataType == T.DoubleType()


def test_other_conflicts_raise():
    with pytest.raises(TypeError, match="'a'"):
        align.unify_schemas([ddl("a string"), ddl("a int")])


def test_timestamp_columns_unify_whatever_the_files_hold():
    merged = align.unify_schemas([ddl("t bigint"), ddl("t timestamp")], ["t"])
    assert merged["t"].dataType == T.TimestampNTZType()


def test_align_orders_casts_pads_and_drops(spark):
    df = spark.createDataFrame([(1.9, "x", 7)], "f double, gone string, n int")
    out = align.align_to_schema(df, ddl("n bigint, new string, f bigint"))
    assert out.dtypes == [("n", "bigint"), ("new", "string"), ("f", "bigint")]
    assert out.first() == (7, None, 1)


def test_align_truncates_toward_zero_and_raises_on_overflow(spark):
    df = spark.createDataFrame([(-1.9,)], "f double")
    assert align.align_to_schema(df, ddl("f int")).first().f == -1
    with pytest.raises(ArithmeticException):
        align.align_to_schema(df.withColumn("f", F.lit(1e30)), ddl("f int")).collect()


def test_float_timestamps_are_refused(spark):
    with pytest.raises(TypeError, match="t"):
        align.normalize_timestamps(spark.createDataFrame([(1.0,)], "t double"), ["t"])


def test_required_columns_are_listed_sorted(spark):
    df = spark.createDataFrame([(1,)], "b int")
    assert align.require_columns(df, ["b"]) is df
    with pytest.raises(ValueError, match=r"\['a', 'c'\]"):
        align.require_columns(df, ["c", "b", "a"])


@pytest.fixture
def month_folder(tmp_path):
    """Three months: doubles, ints with integer timestamps, and a null-typed column."""

    def write(ym, table):
        pq.write_table(table, tmp_path / f"yellow_{ym}.parquet")

    t = datetime(2019, 1, 5, 8)
    write(
        "2019-01",
        pa.table(
            {
                "VendorID": pa.array([1, 2], pa.int64()),
                PICKUP: pa.array([t, t.replace(day=6)], pa.timestamp("us")),
                "passenger_count": pa.array([1.0, None], pa.float64()),
                "congestion_surcharge": pa.nulls(2),
            }
        ),
    )
    write(
        "2019-02",
        pa.table(
            {
                "VendorID": pa.array([1], pa.int32()),
                PICKUP: pa.array([1_549_353_600_000_000], pa.int64()),
                "passenger_count": pa.array([3], pa.int64()),
                "congestion_surcharge": pa.array([2.5], pa.float64()),
                "airport_fee": pa.array([1.25], pa.float64()),
            }
        ),
    )
    write(
        "2019-04",
        pa.table(
            {
                "VendorID": pa.array([2], pa.int64()),
                PICKUP: pa.array([datetime(2019, 4, 1)], pa.timestamp("ms")),
                "passenger_count": pa.array([2.0], pa.float64()),
                "congestion_surcharge": pa.array([0.0], pa.float64()),
            }
        ),
    )
    # the result of an earlier merge lies in the same folder and must not be read
    write("merged", pa.table({"VendorID": pa.array([99], pa.int64())}))
    return f"{tmp_path}/yellow_{{ym}}.parquet"


MONTHS = ["2019-01", "2019-02", "2019-03", "2019-04"]


def test_merge_of_drifting_months(spark, month_folder):
    merged = align.merge_months(spark, month_folder, MONTHS, [PICKUP])
    assert merged.dtypes == [
        ("VendorID", "bigint"),
        (PICKUP, "timestamp_ntz"),
        ("passenger_count", "double"),
        ("congestion_surcharge", "double"),
        ("airport_fee", "double"),
    ]
    assert [tuple(r) for r in merged.orderBy(PICKUP).collect()] == [
        (1, datetime(2019, 1, 5, 8), 1.0, None, None),
        (2, datetime(2019, 1, 6, 8), None, None, None),
        (1, datetime(2019, 2, 5, 8), 3.0, 2.5, 1.25),
        (2, datetime(2019, 4, 1), 2.0, 0.0, None),
    ]


def test_merge_scans_once_per_schema_and_does_not_shuffle(spark, month_folder):
    merged = align.merge_months(spark, month_folder, MONTHS, [PICKUP]).where("VendorID = 1").select("VendorID")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3 and "Exchange" not in plan
    assert "passenger_count" not in plan


def test_absent_months_are_left_out(spark, month_folder):
    found = months.month_files(spark, month_folder, MONTHS)
    assert [f.ym for f in found] == ["2019-01", "2019-02", "2019-04"]


def test_no_month_at_all_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        months.month_files(spark, f"{tmp_path}/none_{{ym}}.parquet", MONTHS)


def test_few_months_draw_a_warning(spark, month_folder, caplog):
    with caplog.at_level(logging.WARNING):
        months.month_files(spark, month_folder, MONTHS)
    assert "3 of 4 months" in caplog.text


def test_scan_reads_agreeing_months_and_refuses_type_conflicts(spark, month_folder):
    alone = months.scan_months(spark, month_folder, ["2019-02", "2019-03"])
    assert alone.count() == 1
    with pytest.raises(Exception, match="CANNOT_MERGE_SCHEMAS"):
        months.scan_months(spark, month_folder, MONTHS)
    with pytest.raises(FileNotFoundError):
        months.scan_months(spark, month_folder, ["2030-01"])


def test_scan_fills_columns_that_a_month_lacks(spark, tmp_path):
    for ym, columns in (("2019-01", ["a"]), ("2019-02", ["a", "b"])):
        pq.write_table(pa.table({c: [1] for c in columns}), tmp_path / f"t_{ym}.parquet")
    got = months.scan_months(spark, f"{tmp_path}/t_{{ym}}.parquet", MONTHS)
    assert sorted(tuple(r) for r in got.na.fill(0).collect()) == [(1, 0), (1, 1)]


def test_profile_covers_all_rows(spark, month_folder):
    merged = align.merge_months(spark, month_folder, MONTHS, [PICKUP])
    assert align.profile_years(merged, PICKUP).first() == (2019, 2019, 4)


def test_unloadable_type_keeps_the_file_types(spark, caplog):
    df = spark.createDataFrame([(1, [1])], "n int, tags array<int>")
    with caplog.at_level(logging.WARNING):
        assert load_types(df).dtypes == df.dtypes
    assert "tags" in caplog.text


def test_ingest_checks_volume(spark, month_folder, tmp_path):
    out = str(tmp_path / "out")
    for ym in MONTHS:
        path = month_folder.format(ym=ym)
        try:
            table = pq.read_table(path)
        except FileNotFoundError:
            continue
        pq.write_table(table.append_column("PULocationID", pa.array([1] * len(table), pa.int64())), path)
    loaded = ingest_service(spark, "Yellow", month_folder, MONTHS, out, [Volume("Yellow", PICKUP, "2019-01", 2)])
    assert loaded.count() == 4
    with pytest.raises(RuntimeError, match="too few rows"):
        ingest_service(spark, "Yellow", month_folder, MONTHS, out, [Volume("Yellow", PICKUP, "2019-01", 3)])
    again = ingest_service(
        spark, "Yellow", month_folder, MONTHS, out, [Volume("Yellow", PICKUP, "2019-01", 3)], skip_checks=True
    )
    assert again.count() == 4


def test_every_footer_of_a_month_counts(spark, tmp_path):
    base = str(tmp_path / "ym=2019-01")
    spark.sql("select 1 as a").write.parquet(base)
    spark.sql("select 2 as a, 0.5D as airport_fee").write.mode("append").parquet(base)
    merged = align.merge_months(spark, str(tmp_path) + "/ym={ym}", ["2019-01", "2019-02"])
    assert sorted((r.a, r.airport_fee) for r in merged.fillna(-1.0).collect()) == [(1, -1.0), (2, 0.5)]


def test_files_of_a_month_may_differ_in_type(spark, tmp_path):
    base = str(tmp_path / "ym=2019-01")
    spark.sql("select 1 as a").write.parquet(base)
    spark.sql("select 2.5D as a").write.mode("append").parquet(base)
    merged = align.merge_months(spark, str(tmp_path) + "/ym={ym}", ["2019-01"])
    assert sorted(r.a for r in merged.collect()) == [1.0, 2.5]


def _month(path, **columns):
    pq.write_table(pa.table({k: pa.array(v, t) for k, (v, t) in columns.items()}), path)


def test_integers_that_doubles_hold_widen_and_others_are_refused(spark, tmp_path):
    template = f"{tmp_path}/m_{{ym}}.parquet"
    _month(tmp_path / "m_2020-01.parquet", n=([1.5], pa.float64()))
    _month(tmp_path / "m_2020-02.parquet", n=([2**53, -(2**53), None], pa.int64()))
    merged = align.merge_months(spark, template, ["2020-01", "2020-02"])
    assert {r.n for r in merged.collect()} == {1.5, float(2**53), -float(2**53), None}
    _month(tmp_path / "m_2020-03.parquet", n=([7, 2**53 + 1], pa.int64()))
    with pytest.raises(ValueError, match="'n' of .*m_2020-03"):
        align.merge_months(spark, template, ["2020-01", "2020-02", "2020-03"])
    # without a float among the files nothing is widened
    only = align.merge_months(spark, template, ["2020-02", "2020-03"])
    assert 2**53 + 1 in {r.n for r in only.collect()}


def test_the_look_for_large_integers_reaches_the_scan(spark, tmp_path):
    _month(tmp_path / "m.parquet", n=([1], pa.int64()), other=([1], pa.int64()))
    found = align.inexact_values(spark.read.parquet(f"{tmp_path}/m.parquet"), ddl("n double, other long"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(n,9007199254740992)" in plan and "ReadSchema: struct<n:bigint>" in plan
    assert align.inexact_values(spark.read.parquet(f"{tmp_path}/m.parquet"), ddl("n long, other long")) is None


def test_names_are_compared_without_case(spark, tmp_path):
    template = f"{tmp_path}/m_{{ym}}.parquet"
    _month(tmp_path / "m_2020-01.parquet", VendorID=([1], pa.int64()), Fee=([1.0], pa.float64()))
    _month(tmp_path / "m_2020-02.parquet", vendorid=([2], pa.int32()), FEE=([2], pa.int64()), t=([0], pa.int64()))
    merged = align.merge_months(spark, template, ["2020-01", "2020-02"], ["T"])
    assert merged.columns == ["VendorID", "Fee", "t"]
    assert {(r.VendorID, r.Fee) for r in merged.collect()} == {(1, 1.0), (2, 2.0)}


def test_months_are_listed_without_reading(spark, tmp_path):
    for ym in ("2020-01", "2020-03"):
        (tmp_path / f"ym={ym}").mkdir()
        (tmp_path / f"ym={ym}" / "part.parquet").write_bytes(b"no parquet at all")
    (tmp_path / "ym=2020-02").mkdir()
    (tmp_path / "ym=2020-02" / "part.parquet").write_bytes(b"")
    (tmp_path / "ym=merged").mkdir()
    (tmp_path / "ym=merged" / "part.parquet").write_bytes(b"x")
    listed = months.listed_months(spark, f"{tmp_path}/ym={{ym}}")
    assert sorted((r.ym, r.files, r.bytes) for r in listed.collect()) == [("2020-01", 1, 17), ("2020-03", 1, 17)]
    for ym in ("2021-05", "2021-06"):
        (tmp_path / f"green_{ym}.parquet").write_bytes(b"x")
    assert {r.ym for r in months.listed_months(spark, f"{tmp_path}/green_{{ym}}.parquet").collect()} == {"2021-05", "2021-06"}
