"""Trip messages: rows to JSON text and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.scalars import float_or_null, int_or_zero, ts_text
from tripmill.operators.align import require_columns
from tripmill.schemas import MESSAGE_COLUMNS, TRIP_MESSAGE

CORRUPT = "_corrupt"


def trip_payload(trips: DataFrame, max_rows: int | None = None) -> DataFrame:
    """One JSON text per trip in column ``value``; null numbers stay as null fields.

    ``max_rows`` bounds a replay to the first rows by pickup time.
    """
    types = {f.name: f.dataType for f in require_columns(trips, MESSAGE_COLUMNS).schema.fields}
    if max_rows is not None:
        order = ["lpep_pickup_datetime", *[c for c in MESSAGE_COLUMNS if c != "lpep_pickup_datetime"]]
        trips = trips.orderBy(*order).limit(max_rows)

    def col(name, convert):
        return convert(F.col(name), types[name])

    record = F.struct(
        col("VendorID", int_or_zero).alias("vendor_id"),
        ts_text(F.col("lpep_pickup_datetime")).alias("lpep_pickup_datetime"),
        ts_text(F.col("lpep_dropoff_datetime")).alias("lpep_dropoff_datetime"),
        col("passenger_count", int_or_zero).alias("passenger_count"),
        col("trip_distance", float_or_null).alias("trip_distance"),
        col("total_amount", float_or_null).alias("total_amount"),
    )
    return trips.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def parse_messages(
    topic: DataFrame, schema: T.StructType = TRIP_MESSAGE, quarantine: bool = False
) -> DataFrame:
    """Message fields as columns; absent fields are null.

    Malformed text stops the query. With ``quarantine`` it goes on, and the text is kept in
    column ``_corrupt`` for ``split_malformed``.
    """
    if not quarantine:
        parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
        return topic.select(parsed.alias("m")).select("m.*")
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return topic.select(F.from_json("value", wide, options).alias("m")).select("m.*")


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the texts that did not parse."""
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = parsed.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))
    return good, bad
