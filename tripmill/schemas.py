"""Column lists, stream and result schemas, and the warehouse type map."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the raw files, the models and the stream messages.
MONEY_COLUMNS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
]
REVENUE_COLUMNS = {
    "fare_amount": "revenue_monthly_fare",
    "extra": "revenue_monthly_extra",
    "mta_tax": "revenue_monthly_mta_tax",
    "tip_amount": "revenue_monthly_tip_amount",
    "tolls_amount": "revenue_monthly_tolls_amount",
    "improvement_surcharge": "revenue_monthly_improvement_surcharge",
    "total_amount": "revenue_monthly_total_amount",
}
ID_COLUMNS = {
    "VendorID": "vendorid",
    "RatecodeID": "ratecodeid",
    "PULocationID": "pickup_locationid",
    "DOLocationID": "dropoff_locationid",
}
PASSED_COLUMNS = ["passenger_count", "trip_distance", *MONEY_COLUMNS, "payment_type"]
SERVICES = {
    "Yellow": ("tpep_pickup_datetime", "tpep_dropoff_datetime"),
    "Green": ("lpep_pickup_datetime", "lpep_dropoff_datetime"),
}
MESSAGE_COLUMNS = [
    "VendorID",
    "lpep_pickup_datetime",
    "lpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "total_amount",
]

ZONE_SEED = T.StructType(
    [
        T.StructField("locationid", T.LongType()),
        T.StructField("borough", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

TRIP_MESSAGE = T.StructType(
    [
        T.StructField("vendor_id", T.IntegerType()),
        T.StructField("lpep_pickup_datetime", T.StringType()),
        T.StructField("lpep_dropoff_datetime", T.StringType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)

TRIP_STATS = T.StructType(
    [
        T.StructField("vendor_id", T.StringType()),
        T.StructField("trip_count", T.LongType()),
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
    ]
)
TRIP_STATS_KEY = ["vendor_id", "window_start"]


def is_integer(t: T.DataType) -> bool:
    return isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def is_float(t: T.DataType) -> bool:
    return isinstance(t, (T.FloatType, T.DoubleType))


def warehouse_type(field: T.StructField) -> T.DataType:
    """The loaded type of one flat column; nested types are refused by name."""
    t = field.dataType
    if is_integer(t):
        return T.LongType()
    if is_float(t):
        return T.DoubleType()
    if isinstance(t, T.DecimalType):
        # an unsigned 64-bit file column arrives as decimal(20,0)
        return T.LongType() if (t.precision, t.scale) == (20, 0) else T.DecimalType(38, 9)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return T.TimestampNTZType()
    if isinstance(t, (T.BooleanType, T.StringType, T.DateType, T.BinaryType)):
        return t
    raise ValueError(f"column {field.name!r} has type {t.simpleString()}, which cannot be loaded")


def warehouse_schema(schema: T.StructType) -> T.StructType:
    """The loaded schema of a flat file schema, every column nullable."""
    return T.StructType([T.StructField(f.name, warehouse_type(f), True) for f in schema.fields])
