from __future__ import annotations

import hashlib
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from trips import raw, zones

from tripmill.operators import core, marts, serving, staging
from tripmill.plans.warehouse import ChecksFailed, build_and_check, build_models, facts
from tripmill.sinks.tables import write_by_month
from tripmill.sources.zones import read_zone_seed

STAGED = [
    "tripid", "vendorid", "ratecodeid", "pickup_locationid", "dropoff_locationid", "pickup_datetime",
    "dropoff_datetime", "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "total_amount", "payment_type", "congestion_surcharge",
]


def test_staged_columns_are_the_same_for_both_services(spark):
    for service in ("Yellow", "Green"):
        staged = staging.stage_trips(raw(spark, [{}], service), service)
        assert staged.columns == STAGED


def test_extra_source_columns_are_dropped(spark):
    df = raw(spark, [{}]).withColumn("airport_fee", F.lit(1.0))
    assert staging.stage_trips(df, "Yellow").columns == STAGED


def test_null_vendor_is_dropped_and_codes_are_rounded(spark):
    rows = [{"VendorID": None}, {"RatecodeID": 1.5}]
    staged = staging.stage_trips(raw(spark, rows), "Yellow").collect()
    assert [(r.vendorid, r.ratecodeid) for r in staged] == [(1, 2)]


def test_float_vendor_has_the_key_of_the_integer_one(spark):
    df = raw(spark, [{"VendorID": 2.0}], types={"VendorID": "double"})
    row = staging.stage_trips(df, "Yellow").first()
    assert row.tripid == hashlib.md5(b"2|2019-03-05 10:00:00").hexdigest() and row.vendorid == 2


def test_first_row_per_key_survives(spark):
    rows = [
        {"dropoff": "2019-03-05 10:40:00", "fare_amount": 1.0},
        {"dropoff": "2019-03-05 10:20:00", "fare_amount": 9.0},
        {"dropoff": "2019-03-05 10:20:00", "fare_amount": 8.0},
        {"VendorID": 2, "fare_amount": 7.0},
    ]
    staged = staging.stage_trips(raw(spark, rows), "Yellow").orderBy("vendorid").collect()
    assert [(r.vendorid, r.fare_amount) for r in staged] == [(1, 8.0), (2, 7.0)]


def test_null_sorts_before_values(spark):
    rows = [{"fare_amount": 1.0}, {"fare_amount": None}]
    assert staging.stage_trips(raw(spark, rows), "Yellow").first().fare_amount is None


def test_null_pickups_collapse_to_one_row_without_key(spark):
    rows = [{"pickup": None, "fare_amount": float(i)} for i in range(3)]
    staged = staging.stage_trips(raw(spark, rows), "Yellow").collect()
    assert [(r.tripid, r.fare_amount) for r in staged] == [(None, 0.0)]


def test_dedup_matches_brute_force_with_a_hot_key(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(3000):
        minute = 0 if rng.random() < 0.35 else rng.randrange(60)
        rows.append(
            {
                "VendorID": 1 if minute == 0 else rng.choice([1, 2]),
                "pickup": f"2019-03-05 10:{minute:02d}:00",
                "dropoff": f"2019-03-05 11:{rng.randrange(60):02d}:00",
                "fare_amount": float(rng.randrange(500)),
                "PULocationID": rng.randrange(5),
            }
        )
    df = raw(spark, rows)
    order = ["tpep_dropoff_datetime", *[c for c in df.columns if c not in (
        "tpep_dropoff_datetime", "tpep_pickup_datetime", "VendorID")]]
    best = {}
    for r in df.collect():
        key = (r.tpep_pickup_datetime, r.VendorID)
        best[key] = min(best.get(key, r), r, key=lambda x: tuple(x[c] for c in order))
    for partitions in (1, 13):
        kept = staging.dedup_first(df.repartition(partitions), ["tpep_pickup_datetime", "VendorID"], order)
        assert {(r.tpep_pickup_datetime, r.VendorID): r for r in kept.collect()} == best


def test_dedup_limits_rows_before_the_shuffle(spark):
    staged = staging.stage_trips(raw(spark, [{}]), "Yellow")
    plan = staged._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle
    assert plan.count("Exchange") == 1


def test_zone_seed_keeps_na_texts(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        '"locationid","borough","zone","service_zone"\n1,"EWR","Newark","EWR"\n'
        '2,"Queens","Jamaica, Bay","Boro Zone Boro"\n264,"Unknown","NV","N/A"\n265,"NA","NA","N/A"'
    )
    dim = core.dim_zones(read_zone_seed(spark, str(path))).orderBy("locationid").collect()
    assert [tuple(r) for r in dim] == [
        (1, "EWR", "Newark", "EWR"),
        (2, "Queens", "Jamaica, Bay", "Green Zone Green"),
        (264, "Unknown", "NV", "N/A"),
        (265, "NA", "NA", "N/A"),
    ]


def two_services(spark):
    yellow = [
        {"PULocationID": 2, "DOLocationID": 1},
        {"PULocationID": 3, "DOLocationID": 1, "pickup": "2019-03-06 10:00:00", "passenger_count": None},
        {"PULocationID": 2, "DOLocationID": 99, "pickup": "2019-03-07 10:00:00"},
        {"PULocationID": 98, "DOLocationID": 99, "pickup": "2019-03-08 10:00:00"},
        {"PULocationID": None, "DOLocationID": 1, "pickup": "2019-03-09 10:00:00"},
        {"PULocationID": 2, "DOLocationID": 1, "pickup": "2020-03-05 10:00:00", "total_amount": 20.1},
    ]
    green = [{"PULocationID": 4, "DOLocationID": 4, "total_amount": None}]
    return {"Yellow": raw(spark, yellow), "Green": raw(spark, green, "Green")}


def test_facts_join_both_roles_and_drop_unknown_zones(spark):
    got = facts(two_services(spark), zones(spark))
    assert got.columns[:10] == [
        "tripid", "vendorid", "service_type", "ratecodeid", "pickup_locationid", "pickup_borough",
        "pickup_zone", "dropoff_locationid", "dropoff_borough", "dropoff_zone",
    ]
    assert len(got.columns) == 23
    rows = got.orderBy("pickup_datetime", "service_type").collect()
    assert [(r.service_type, r.pickup_zone, r.dropoff_zone) for r in rows] == [
        ("Green", "Alphabet", "Alphabet"),
        ("Yellow", "Corona", "Newark"),
        ("Yellow", "Corona", "Newark"),
        ("Yellow", "Corona", "Newark"),
    ]
    # the key does not hold the service, so both services' trips of one vendor and second collide
    assert rows[0].tripid == rows[1].tripid


def test_lost_trips_are_counted_per_role(spark):
    staged = {s: staging.stage_trips(df, s) for s, df in two_services(spark).items()}
    lost = core.unmatched_zones(core.union_services(staged), core.dim_zones(zones(spark)))
    assert {(r.service_type, r.role, r.dropped_trips) for r in lost.collect()} == {
        ("Yellow", "pickup", 2),
        ("Yellow", "dropoff", 2),
    }


def test_large_dimension_joins_by_shuffle_and_splits_a_hot_zone(spark, conf):
    hot = F.when(F.col("id") % 3 == 0, F.lit(2)).otherwise(F.col("id") % 500 + 1000)
    many = spark.range(60_000, numPartitions=8).select(
        hot.alias("pickup_locationid"), F.md5(F.col("id").cast("string")).alias("tripid")
    )
    dim = spark.range(5000).selectExpr("id as locationid", "'b' as borough", "concat('z', id) as zone")
    broadcasted = core.join_zone(many, dim, "pickup").groupBy("pickup_zone").count()
    expected = {r.pickup_zone: r["count"] for r in broadcasted.collect()}
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "200k")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    shuffled = core.join_zone(many, dim, "pickup").select("pickup_zone", "tripid")
    counted = {}
    for row in shuffled.collect():
        counted[row.pickup_zone] = counted.get(row.pickup_zone, 0) + 1
    assert counted == expected and expected["z2"] == 20_000
    assert "skew=true" in shuffled._jdf.queryExecution().executedPlan().toString()


def test_zone_mart_groups_by_name_month_and_service(spark):
    mart = marts.monthly_zone_revenue(facts(two_services(spark), zones(spark)))
    rows = {(r.revenue_zone, r.revenue_month, r.service_type): r for r in mart.collect()}
    march = rows["Corona", datetime(2019, 3, 1), "Yellow"]
    assert march.total_monthly_trips == 2  # ids 2 and 3 share the name
    assert march.revenue_monthly_total_amount == 26.6
    assert march.revenue_monthly_fare == 20.0
    assert march.avg_monthly_passenger_count == 1.0  # nulls do not count
    assert rows["Alphabet", datetime(2019, 3, 1), "Green"].revenue_monthly_total_amount is None
    assert set(rows) == {
        ("Corona", datetime(2019, 3, 1), "Yellow"),
        ("Corona", datetime(2020, 3, 1), "Yellow"),
        ("Alphabet", datetime(2019, 3, 1), "Green"),
    }
    assert mart.columns == [
        "revenue_zone", "revenue_month", "service_type", "revenue_monthly_fare", "revenue_monthly_extra",
        "revenue_monthly_mta_tax", "revenue_monthly_tip_amount", "revenue_monthly_tolls_amount",
        "revenue_monthly_improvement_surcharge", "revenue_monthly_total_amount", "total_monthly_trips",
        "avg_monthly_passenger_count", "avg_monthly_trip_distance",
    ]


def test_decimal_amounts_sum_as_decimals(spark):
    trips = facts(two_services(spark), zones(spark))
    exact = trips.withColumn("total_amount", F.col("total_amount").cast("decimal(10,3)"))
    mart = marts.monthly_zone_revenue(exact)
    assert mart.schema["revenue_monthly_total_amount"].dataType.simpleString() == "decimal(20,3)"


def mart_rows(spark, rows):
    ddl = (
        "revenue_zone string, revenue_month timestamp_ntz, service_type string, "
        "revenue_monthly_total_amount double, total_monthly_trips bigint"
    )
    return spark.createDataFrame(rows, ddl)


@pytest.fixture
def mart(spark):
    jan19, feb19, jan20 = datetime(2019, 1, 1), datetime(2019, 2, 1), datetime(2020, 1, 1)
    return mart_rows(
        spark,
        [
            ("A", jan19, "Yellow", 10.0, 4),
            ("B", jan19, "Yellow", 20.0, 2),
            ("A", jan19, "Green", 5.0, 1),
            ("A", feb19, "Yellow", 1.0, 1),
            ("B", jan20, "Yellow", 6.0, 3),
            ("C", jan20, "Green", 16.0, 9),
        ],
    )


def test_citywide_rolls_zones_up(mart):
    rows = marts.citywide_monthly(mart).orderBy("revenue_month", "service_type").collect()
    assert [tuple(r)[1:] for r in rows] == [
        (2019, 1, "Green", 1, 5.0),
        (2019, 1, "Yellow", 6, 30.0),
        (2019, 2, "Yellow", 1, 1.0),
        (2020, 1, "Green", 9, 16.0),
        (2020, 1, "Yellow", 3, 6.0),
    ]


def test_service_totals_and_share(mart):
    totals = marts.service_type_totals(marts.citywide_monthly(mart))
    rows = {r.service_type: (r.trip_total, r.share) for r in serving.service_share(totals).collect()}
    assert rows == {"Yellow": (10, 0.5), "Green": (10, 0.5)}


def test_monthly_totals_order(mart):
    rows = serving.monthly_totals(mart).collect()
    assert [(r.revenue_month.month, r.service_type, r.total_monthly_trips) for r in rows] == [
        (1, "Yellow", 6), (1, "Green", 1), (2, "Yellow", 1), (1, "Yellow", 3), (1, "Green", 9),
    ]


def test_top_zones_break_ties_by_name(mart):
    rows = serving.top_zones(mart, 2).collect()
    assert [tuple(r) for r in rows] == [("B", 26.0, 5), ("A", 16.0, 6)]


def test_mart_filters(mart):
    assert serving.filter_mart(mart, "2019-01-01", "2019-12-31").count() == 4
    assert serving.filter_mart(mart, "2019-02-01", "2020-01-01", "Yellow").count() == 2


def test_months_by_year(mart):
    rows = serving.month_by_year(marts.citywide_monthly(mart), [2019, 2020]).orderBy("trip_month").collect()
    assert [tuple(r) for r in rows] == [(1, 7, 12, None), (2, 1, None, None)]
    other = serving.month_by_year(marts.citywide_monthly(mart), [2019]).orderBy("trip_month").collect()
    assert [tuple(r) for r in other] == [(1, 7, 12), (2, 1, None)]  # years not listed are kept


def test_year_over_year(mart):
    rows = serving.yoy_monthly(marts.citywide_monthly(mart)).where("trip_year = 2020").collect()
    got = {r.service_type: (r.trips, r.trips_year_before, r.change) for r in rows}
    assert got == {"Yellow": (3, 6, -0.5), "Green": (9, 1, 8.0)}
    first = serving.yoy_monthly(marts.citywide_monthly(mart)).where("trip_year = 2019").collect()
    assert len(first) == 3 and all(r.trips_year_before is None and r.change is None for r in first)


def test_month_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql(
        "select timestamp_ntz '2019-03-01 00:00:00' as t union all select timestamp_ntz '2019-04-01 00:00:00' "
        "union all select timestamp_ntz '2019-03-31 23:59:59.999999' union all select null"
    ).write.parquet(path)
    march = marts.month_range(spark.read.parquet(path), "t", "2019-03")
    assert marts.count_rows(march).first().c == 2
    assert "GreaterThanOrEqual(t,2019-03-01" in march._jdf.queryExecution().executedPlan().toString()


def test_latest_windows_and_labels(spark):
    rows = [
        ("10", 3, datetime(2021, 1, 1, 0, 5), datetime(2021, 1, 1, 0, 10)),
        ("2", 4, datetime(2021, 1, 1, 0, 5), datetime(2021, 1, 1, 0, 10)),
        ("1", 5, datetime(2021, 1, 1, 0, 0), datetime(2021, 1, 1, 0, 5)),
    ]
    stats = spark.createDataFrame(
        rows, "vendor_id string, trip_count bigint, window_start timestamp_ntz, window_end timestamp_ntz"
    )
    assert [r.vendor_id for r in serving.latest_windows(stats, 2).collect()] == ["10", "2"]  # text order
    assert [tuple(r) for r in serving.vendor_activity(stats).collect()] == [
        ("Vendor 1 (00:00)", 5),
        ("Vendor 10 (00:05)", 3),
        ("Vendor 2 (00:05)", 4),
    ]


def test_models_are_stored_by_layer(spark):
    models = build_models(spark, two_services(spark), zones(spark), "layer_test")
    tables = {t.name: t.tableType for t in spark.catalog.listTables("layer_test")}
    stored = {"dim_zones", "fact_trips", "monthly_zone_revenue", "citywide_monthly", "service_type_totals"}
    assert stored <= {n for n, kind in tables.items() if kind == "MANAGED"}
    assert tables["layer_test_stg_yellow"] == "TEMPORARY"
    assert {r.service_type: r.trip_total for r in models["service_type_totals"].collect()} == {
        "Yellow": 3,
        "Green": 1,
    }
    build_models(spark, two_services(spark), zones(spark), "layer_test")  # rebuilding replaces
    assert spark.table("layer_test.fact_trips").count() == 4


def test_a_failing_check_stops_the_build(spark):
    raw_trips = two_services(spark)
    bad = {s: df.withColumn("VendorID", F.lit(9).cast("bigint")) for s, df in raw_trips.items()}
    with pytest.raises(ChecksFailed, match="accepted_values"):
        build_and_check(spark, bad, zones(spark), "gate_test")
    _, report = build_and_check(spark, bad, zones(spark), "gate_test", report_only=True)
    assert report.where("not passed").count() > 0
    spark.sql("DROP DATABASE gate_test CASCADE")


def test_a_mart_stored_by_month_is_pruned_by_the_filter(spark, tmp_path):
    mart = spark.sql(
        "select timestamp_ntz'2020-01-01' + make_ym_interval(0, cast(id as int)) as revenue_month, 'Green' as service_type, id from range(12)"
    )
    write_by_month(mart, str(tmp_path), "revenue_month")
    stored = spark.read.schema("revenue_month timestamp_ntz, service_type string, id long, ym string").parquet(str(tmp_path))
    kept = serving.filter_mart(stored, "2020-03-01", "2020-04-30", "Green")
    assert sorted(r.id for r in kept.collect()) == [2, 3] and kept.columns == mart.columns
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan and "(ym#" in plan.split("PartitionFilters")[1].split("]")[0]
