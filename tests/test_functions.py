from __future__ import annotations

import hashlib
import random
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions import scalars
from tripmill.functions.calendar import hour_keys, month_calendar, month_keys
from tripmill.schemas import warehouse_schema


def value(spark, col, ddl="x int", data=((1,),)):
    return spark.createDataFrame(data, ddl).select(col.alias("v")).first().v


def test_month_keys_agree_with_calendar_periods():
    rng = random.Random(12)
    for _ in range(200):
        start = pd.Period(f"{rng.randint(1900, 2100)}-{rng.randint(1, 12):02d}", "M")
        end = start + rng.randint(-3, 40)
        assert month_keys(str(start), str(end)) == [str(p) for p in pd.period_range(start, end, freq="M")]


def test_month_calendar_covers_the_months_of_its_bounds(spark):
    """Bounds are days; the month of each counts whole, leap days and ends of years included."""
    bounds = {
        ("2024-02-29", "2024-02-29"): ["2024-02"],
        ("1999-12-31", "2000-03-01"): ["1999-12", "2000-01", "2000-02", "2000-03"],
        ("2031-07-02", "2031-06-30"): [],
    }
    for (first, last), months in bounds.items():
        days = spark.sql(f"select date '{first}' as a, date '{last}' as b")
        assert sorted(r.ym for r in month_calendar(days, "a", "b").collect()) == months


def test_hour_keys_have_no_padding():
    assert hour_keys(datetime(2024, 1, 1, 23), datetime(2024, 1, 2, 1)) == [
        "2024-01-01-23",
        "2024-01-02-0",
        "2024-01-02-1",
    ]


@pytest.mark.parametrize("x, expected", [(1.5, 2), (-1.5, -2), (2.5, 3), (1.4, 1), (None, None)])
def test_integer_cast_rounds_halves_away_from_zero(spark, x, expected):
    col = scalars.to_int64(F.col("x"), T.DoubleType())
    assert value(spark, col, "x double", [(x,)]) == expected


def test_key_is_hex_md5_of_vendor_and_time(spark):
    df = spark.sql("select 2L as v, timestamp_ntz '2019-01-01 00:00:00' as t")
    plain = df.select(scalars.trip_key(F.col("v").cast("string"), F.col("t"))).first()[0]
    zoned = df.select(scalars.trip_key(F.col("v").cast("string"), F.col("t"), "+00")).first()[0]
    assert plain == hashlib.md5(b"2|2019-01-01 00:00:00").hexdigest()
    assert zoned == hashlib.md5(b"2|2019-01-01 00:00:00+00").hexdigest()


def test_key_is_null_when_a_part_is_null(spark):
    df = spark.sql("select '2' as v, cast(null as timestamp_ntz) as t")
    assert df.select(scalars.trip_key(F.col("v"), F.col("t"))).first()[0] is None


def test_float_id_prints_like_an_integer(spark):
    col = scalars.id_text(F.col("x"), T.DoubleType())
    assert value(spark, col, "x double", [(2.0,)]) == "2"
    assert value(spark, col, "x double", [(2.5,)]) == "2.5"


@pytest.mark.parametrize(
    "unit, n, expected",
    [
        ("s", 1, datetime(1970, 1, 1, 0, 0, 1)),
        ("ms", 1500, datetime(1970, 1, 1, 0, 0, 1, 500000)),
        ("us", 1_546_300_800_000_001, datetime(2019, 1, 1, 0, 0, 0, 1)),
        ("ns", 1_546_300_800_000_001_999, datetime(2019, 1, 1, 0, 0, 0, 1)),
        ("ns", -1, datetime(1969, 12, 31, 23, 59, 59, 999999)),
    ],
)
def test_epoch_units(spark, unit, n, expected):
    assert value(spark, scalars.epoch_to_ts(F.col("x"), unit), "x bigint", [(n,)]) == expected


def test_unknown_epoch_unit():
    with pytest.raises(ValueError, match="weeks"):
        scalars.epoch_to_ts(F.lit(1), "weeks")


@pytest.mark.parametrize("x, expected", [(1.9, 1), (-1.9, -1), (float("nan"), 0), (None, 0)])
def test_integer_or_zero(spark, x, expected):
    assert value(spark, scalars.int_or_zero(F.col("x"), T.DoubleType()), "x double", [(x,)]) == expected


@pytest.mark.parametrize("x, expected", [(1.5, 1.5), (float("nan"), None), (None, None)])
def test_float_or_null(spark, x, expected):
    assert value(spark, scalars.float_or_null(F.col("x"), T.DoubleType()), "x double", [(x,)]) == expected


@pytest.mark.parametrize(
    "ts, expected",
    [
        (datetime(2021, 1, 1, 0, 15, 56), "2021-01-01 00:15:56"),
        (datetime(2021, 1, 1, 0, 15, 56, 500000), "2021-01-01 00:15:56.500000"),
        (None, "NaT"),
    ],
)
def test_timestamp_text(spark, ts, expected):
    assert value(spark, scalars.ts_text(F.col("x")), "x timestamp_ntz", [(ts,)]) == expected


def test_money_sum_does_not_depend_on_order(spark):
    amounts = [0.1, 0.2, 0.3, 1e9, -1e9, 33.33] * 50
    sums = set()
    for rows in (amounts, amounts[::-1], sorted(amounts)):
        df = spark.createDataFrame([(a,) for a in rows], "x double").repartition(7)
        sums.add(df.agg(scalars.money_sum("x", T.DoubleType())).first()[0])
    assert sums == {1696.5}


@pytest.mark.parametrize(
    "amounts, total", [([0.005] * 1000, 5.0), ([0.125, 0.25], 0.375), ([1.0, float("nan")], float("nan"))]
)
def test_money_is_summed_as_it_is(spark, amounts, total):
    df = spark.createDataFrame([(a,) for a in amounts], "x double")
    assert df.agg(scalars.money_sum("x", T.DoubleType())).first()[0] == pytest.approx(total, nan_ok=True)


def test_month_floor_keeps_the_zone_less_kind(spark):
    df = spark.sql("select timestamp_ntz '2019-03-31 23:59:59' as t").select(
        scalars.month_floor(F.col("t")).alias("m")
    )
    assert df.schema["m"].dataType == T.TimestampNTZType()
    assert df.first().m == datetime(2019, 3, 1)


@pytest.mark.parametrize(
    "source, loaded",
    [
        ("tinyint", "bigint"),
        ("smallint", "bigint"),
        ("int", "bigint"),
        ("bigint", "bigint"),
        ("decimal(20,0)", "bigint"),
        ("float", "double"),
        ("double", "double"),
        ("boolean", "boolean"),
        ("string", "string"),
        ("timestamp", "timestamp_ntz"),
        ("timestamp_ntz", "timestamp_ntz"),
        ("date", "date"),
        ("binary", "binary"),
        ("decimal(10,2)", "decimal(38,9)"),
    ],
)
def test_type_map(source, loaded):
    schema = T.StructType.fromDDL(f"c {source} not null")
    field = warehouse_schema(schema).fields[0]
    assert field.dataType.simpleString() == loaded and field.nullable


@pytest.mark.parametrize("source", ["array<int>", "struct<a: int>", "map<string, int>"])
def test_nested_types_are_refused_by_name(source):
    with pytest.raises(ValueError, match="tags"):
        warehouse_schema(T.StructType.fromDDL(f"tags {source}"))
