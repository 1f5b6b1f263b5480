"""Column expressions whose semantics differ from Spark's plain functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.schemas import is_float, is_integer


def to_int64(col: Column, source: T.DataType) -> Column:
    """Integer cast that rounds halves away from zero (Spark's own cast truncates)."""
    if isinstance(source, T.LongType):
        return col
    return col.cast("bigint") if is_integer(source) else F.round(col).cast("bigint")


def id_text(col: Column, source: T.DataType) -> Column:
    """Text of an id; a whole number held as float prints without its fraction."""
    if not is_float(source):
        return col.cast("string")
    return F.when(col == F.rint(col), col.cast("bigint").cast("string")).otherwise(col.cast("string"))


def trip_key(vendor_text: Column, pickup: Column, ts_suffix: str = "") -> Column:
    """MD5 hex of ``vendor|pickup``; null when either part is null.

    ``ts_suffix='+00'`` gives the text of a zoned warehouse timestamp.
    """
    stamp = pickup.cast("string")
    if ts_suffix:
        stamp = F.concat(stamp, F.lit(ts_suffix))
    return F.md5(F.concat(vendor_text, F.lit("|"), stamp))


def month_floor(ts: Column) -> Column:
    """First instant of the month; date_trunc alone would change a zone-less timestamp's kind."""
    return F.date_trunc("month", ts).cast("timestamp_ntz")


def epoch_to_ts(col: Column, unit: str = "us") -> Column:
    """Zone-less timestamp from an integer count of s, ms, us or ns since the epoch."""
    n = col.cast("bigint")
    if unit == "s":
        ts = F.timestamp_seconds(n)
    elif unit == "ms":
        ts = F.timestamp_millis(n)
    elif unit == "us":
        ts = F.timestamp_micros(n)
    elif unit == "ns":
        ts = F.timestamp_micros(F.floor(n / F.lit(1000).cast("decimal(4,0)")).cast("bigint"))
    else:
        raise ValueError(f"unknown epoch unit {unit!r}")
    return ts.cast("timestamp_ntz")


def money_sum(name: str, source: T.DataType) -> Column:
    """Sum of an amount as it is. A float total is rounded to a hundredth of a cent, which hides
    the order in which partitions were added; NaN amounts give a NaN total."""
    return F.round(F.sum(name), 4) if is_float(source) else F.sum(name)


def int_or_zero(col: Column, source: T.DataType) -> Column:
    """Integer, truncated toward zero; null and NaN become 0."""
    if is_float(source):
        col = F.when(~F.isnan(col), col)
    return F.coalesce(col.cast("bigint"), F.lit(0).cast("bigint"))


def float_or_null(col: Column, source: T.DataType) -> Column:
    """Double; NaN becomes null."""
    col = col.cast("double")
    return F.when(~F.isnan(col), col) if is_float(source) else col


def ts_text(col: Column) -> Column:
    """Second-precision text, six fraction digits only where there is a fraction, NaT for null."""
    whole = F.date_trunc("second", col).cast("timestamp_ntz") == col
    return (
        F.when(col.isNull(), F.lit("NaT"))
        .when(whole, F.date_format(col, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
