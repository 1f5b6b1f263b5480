from __future__ import annotations

import pytest
from trips import raw, zones

from tripmill.operators import quality
from tripmill.operators.quality import Accepted, NotNull, Unique, Volume
from tripmill.plans.warehouse import build_models
from tripmill.sources import months


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (4, "b"), (None, None), (None, "c")], "k bigint, v string")


def test_column_checks_in_one_pass(df):
    checks = [NotNull("t", "k"), NotNull("t", "v"), Accepted("t", "k", (1, 2)), Accepted("t", "v", ("a", "b", "c"))]
    out = quality.column_checks(df, checks)
    assert [tuple(r) for r in out.collect()] == [
        ("not_null", "t", "k", 2),
        ("not_null", "t", "v", 1),
        ("accepted_values", "t", "k", 1),  # 4 fails, nulls pass
        ("accepted_values", "t", "v", 0),
    ]


def test_unique_ignores_nulls(df):
    assert [tuple(r) for r in quality.unique_violations(df, "k").collect()] == [(1, 2)]


def test_grain_counts_combinations(df):
    assert quality.grain_violations(df, ["k", "v"]).count() == 0
    assert {tuple(r) for r in quality.grain_violations(df.unionAll(df), ["k", "v"]).collect()} == {
        (1, "a", 2), (1, "b", 2), (4, "b", 2), (None, None, 2), (None, "c", 2),
    }


def test_key_checks_equal_the_separate_ones(df):
    both = {r.check_name: r.violations for r in quality.key_checks(df, Unique("t", ("k",)), NotNull("t", "k")).collect()}
    assert both == {"unique": 1, "not_null": 2}
    empty = quality.key_checks(df.limit(0), Unique("t", ("k",)), NotNull("t", "k"))
    assert [r.violations for r in empty.collect()] == [0, 0]


def test_report_lists_every_check(df):
    checks = [NotNull("t", "k"), Unique("t", ("k",)), Unique("t", ("k", "v")), NotNull("u", "v"), Accepted("u", "v", ("a",))]
    rows = quality.report({"t": df, "u": df.where("v = 'a'")}, checks).collect()
    assert {(r.table_name, r.check_name, r.column_name, r.violations, r.passed) for r in rows} == {
        ("t", "not_null", "k", 2, False),
        ("t", "unique", "k", 1, False),
        ("t", "grain", "k,v", 0, True),
        ("u", "not_null", "v", 0, True),
        ("u", "accepted_values", "v", 0, True),
    }


def test_volume_per_month(spark):
    rows = [{"pickup": f"2019-03-{d:02d} 10:00:00"} for d in range(1, 6)] + [{"pickup": "2019-04-01 00:00:00"}]
    out = quality.volume_checks(
        {"Yellow": raw(spark, rows)},
        [Volume("Yellow", "tpep_pickup_datetime", "2019-03", n) for n in (5, 6)],
    )
    assert [(r.row_count, r.min_rows, r.passed) for r in out.collect()] == [(5, 5, True), (5, 6, False)]


def test_model_checks_have_the_known_counts():
    kinds = [c.name for c in quality.model_checks()]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 19, "unique": 6, "accepted_values": 5, "grain": 2,
    }


def test_model_report_shows_colliding_keys_and_unknown_vendors(spark):
    raws = {
        "Yellow": raw(spark, [{}, {"VendorID": 4, "pickup": "2019-03-06 10:00:00"}]),
        "Green": raw(spark, [{}], "Green"),  # same vendor and second as the first Yellow trip
    }
    models = build_models(spark, raws, zones(spark), "report_test")
    failed = {
        (r.table_name, r.check_name, r.column_name, r.violations)
        for r in quality.report(models, quality.model_checks()).where("not passed").collect()
    }
    assert failed == {("fact_trips", "unique", "tripid", 1), ("fact_trips", "accepted_values", "vendorid", 1)}


def test_month_coverage(spark):
    trips = raw(spark, [{"pickup": "2019-01-31 23:00:00"}, {"pickup": "2019-03-01 00:00:00"}, {"pickup": None}])
    observed = months.observed_months(trips, "tpep_pickup_datetime")
    calendar = spark.createDataFrame([("2019-01",), ("2019-02",), ("2019-03",), ("2019-04",)], "ym string")
    missing = months.missing_months(calendar, observed)
    assert sorted(r.ym for r in missing.collect()) == ["2019-02", "2019-04"]


def test_volume_checks_open_the_days_of_their_month(spark, tmp_path):
    out = str(tmp_path / "t")
    rows = spark.sql("select timestamp_ntz '2019-03-05 10:00:00' as t, date '2019-03-05' as pickup_date")
    rows.write.partitionBy("pickup_date").parquet(out)
    table = spark.read.schema("t timestamp_ntz, pickup_date date").parquet(out)
    checked = quality.volume_checks({"Yellow": table}, [quality.Volume("Yellow", "t", "2019-03", 1)])
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "pickup_date" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert checked.first().passed
