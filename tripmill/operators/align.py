"""Schema drift between month files: unify, normalise timestamps, align, merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.scalars import epoch_to_ts
from tripmill.schemas import is_float, is_integer
from tripmill.sources.months import by_schema, month_files, scan_group


#: Integers up to this one are doubles too.
EXACT = 2**53


def _common_type(name: str, a: T.DataType, b: T.DataType, strict: bool) -> T.DataType:
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if not strict:
        if is_integer(a) and is_integer(b):
            return T.LongType()
        if (is_integer(a) or is_float(a)) and (is_integer(b) or is_float(b)):
            return T.DoubleType()
    raise TypeError(f"column {name!r}: {a.simpleString()} and {b.simpleString()} do not unify")


def unify_schemas(
    schemas: Sequence[T.StructType], timestamp_cols: Sequence[str] = (), strict: bool = False
) -> T.StructType:
    """One schema for all files: fields in order of first appearance, all nullable.

    Names are compared without case, and the first spelling stays. A null-typed column takes the
    other files' type. Integers and floats widen to one numeric type unless ``strict``, where any
    conflict is an error; ``merge_months`` proves that no value changes by it. The named timestamp
    columns become zone-less timestamps whatever the files hold.
    """
    merged: dict[str, T.StructField] = {}
    times = {c.lower() for c in timestamp_cols}
    for schema in schemas:
        for f in schema.fields:
            key, kind = f.name.lower(), f.dataType
            if key in times:
                kind = T.TimestampNTZType()
            elif key in merged:
                kind = _common_type(merged[key].name, merged[key].dataType, kind, strict)
            merged[key] = T.StructField(merged[key].name if key in merged else f.name, kind, True)
    return T.StructType(list(merged.values()))


def inexact_values(df: DataFrame, target: T.StructType) -> DataFrame | None:
    """column_name, file of the integers that the target's type would change; None if its types cannot.

    Only the columns in question are read, and of these only the row groups whose minimum or maximum
    is beyond what a double holds, because the bounds reach the scan.
    """
    kinds = {f.name.lower(): f.dataType for f in target.fields}
    risky = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.LongType) and is_float(kinds.get(f.name.lower(), f.dataType))
    ]
    if not risky:
        return None
    beyond = {c: (F.col(c) > EXACT) | (F.col(c) < -EXACT) for c in risky}
    first = F.coalesce(*[F.when(x, F.lit(c)) for c, x in beyond.items()])
    found = df.where(reduce(Column.__or__, beyond.values()))
    return found.select(first.alias("column_name"), F.col("_metadata.file_path").alias("file"))


def _as_timestamp(name: str, source: T.DataType, unit: str) -> Column:
    if is_integer(source):
        return epoch_to_ts(F.col(name), unit)
    if isinstance(source, (T.TimestampType, T.DateType, T.NullType, T.StringType)):
        return F.col(name).cast("timestamp_ntz")
    raise TypeError(f"column {name!r}: {source.simpleString()} is no timestamp")


def normalize_timestamps(
    df: DataFrame, timestamp_cols: Sequence[str], unit: str = "us"
) -> DataFrame:
    """Turn the named columns into zone-less timestamps; integers count ``unit`` since the epoch."""
    changed = {
        f.name: _as_timestamp(f.name, f.dataType, unit)
        for f in df.schema.fields
        if f.name.lower() in {c.lower() for c in timestamp_cols} and not isinstance(f.dataType, T.TimestampNTZType)
    }
    return df.withColumns(changed) if changed else df


def align_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Exactly the target's columns, in its order and types: cast, pad with nulls, drop extras.

    Names are compared without case and become the target's. A float that becomes an integer is truncated; a value that does not fit raises.
    """
    have = {f.name.lower(): f for f in df.schema.fields}

    def column(f: T.StructField) -> Column:
        own = have.get(f.name.lower())
        if own is None:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if own == T.StructField(f.name, f.dataType, own.nullable):
            return F.col(f.name)
        return F.col(own.name).cast(f.dataType).alias(f.name)

    return df.select([column(f) for f in target.fields])


def merge_months(
    spark: SparkSession,
    template: str,
    months: Sequence[str],
    timestamp_cols: Sequence[str] = (),
    strict: bool = False,
    unit: str = "us",
) -> DataFrame:
    """All months of one service as one frame: one scan per distinct schema, then a union.

    Timestamps are normalised before the union because Spark does not unite integers with
    timestamps. Nothing shuffles, and filters and column lists still reach every scan. Where
    integers of one file meet floats of another, both become doubles, after a look whether any
    integer is too large for one: such a value is an error that names its column and file.
    """
    groups = by_schema(month_files(spark, template, months))
    target = unify_schemas([schema for schema, _ in groups], timestamp_cols, strict)
    scans = [scan_group(spark, schema, files) for schema, files in groups]
    looks = [x for scan in scans if (x := inexact_values(scan, target)) is not None]
    if looks and (bad := reduce(DataFrame.unionByName, looks).take(1)):
        raise ValueError(f"column {bad[0].column_name!r} of {bad[0].file} holds integers that a double cannot")
    parts = [align_to_schema(normalize_timestamps(scan, timestamp_cols, unit), target) for scan in scans]
    return reduce(DataFrame.unionByName, parts)


def require_columns(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """The frame itself, or an error that lists the absent columns in sorted order."""
    absent = sorted(set(needed) - set(df.columns))
    if absent:
        raise ValueError(f"missing columns: {absent}")
    return df


def profile_years(df: DataFrame, ts_col: str) -> DataFrame:
    """Row count and the range of years over all rows."""
    year = F.year(ts_col).cast("bigint")
    return df.agg(
        F.min(year).alias("min_year"),
        F.max(year).alias("max_year"),
        F.count("*").alias("row_count"),
    )
