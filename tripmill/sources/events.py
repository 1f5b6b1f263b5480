"""Newline-delimited JSON archives, one gzip file (or folder) per hour."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_hours(
    spark: SparkSession,
    root: str,
    hours: Sequence[str],
    schema: T.StructType,
    suffix: str = ".json.gz",
    mode: str = "FAILFAST",
) -> DataFrame:
    """Events of the given ``YYYY-MM-DD-H`` hours; an hour without a file gives no rows.

    The folder is listed once and its files are chosen by name. gzip cannot be split, so each
    file is read by one task. Transformations that shuffle spread the rows again; a caller that
    does not shuffle can ``repartition``.
    """
    names = "{" + ",".join(hours) + "}" + suffix
    reader = spark.read.schema(schema).option("mode", mode).option("pathGlobFilter", names)
    return reader.json(root)


def read_hour_folders(
    spark: SparkSession,
    root: str,
    hours: Sequence[str],
    schema: T.StructType,
    mode: str = "FAILFAST",
) -> DataFrame:
    """The same for an archive that holds a folder ``hour=YYYY-MM-DD-H`` of files per hour."""
    with_hour = T.StructType([*schema.fields, T.StructField("hour", T.StringType())])
    events = spark.read.schema(with_hour).option("mode", mode).json(root)
    return events.where(F.col("hour").isin(*hours)).drop("hour")


def read_ndjson(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """NDJSON with the schema inferred; lower the ratio where a full inference pass is too dear."""
    return spark.read.option("samplingRatio", sampling_ratio).json(path)


def read_texts(spark: SparkSession, root: str) -> DataFrame:
    """Lines of an archive of hour folders as they are: value, hour."""
    return spark.read.schema("value string, hour string").text(root)


def _fields(texts: DataFrame, *by: str) -> DataFrame:
    """One row per field of each JSON object: the columns named, field, content (a variant)."""
    objects = texts.select(*by, F.try_parse_json("value").alias("v"))
    found = objects.lateralJoin(objects.sparkSession.tvf.variant_explode(F.col("v").outer()))
    return found.where("key is not null").select(*by, F.col("key").alias("field"), F.col("value").alias("content"))


def field_shapes(texts: DataFrame, hour: str = "hour") -> DataFrame:
    """How the fields of JSON objects drift: field, hours, events, shapes, unified.

    ``hours`` and ``events`` are those that have the field, ``shapes`` the distinct types it has over
    whole hours, and ``unified`` the type that holds every value (VARIANT where none does). Texts are
    parsed once; types merge within each task, so one small row per task, field and hour is shuffled.
    Nulls are of type VOID; numbers with a fraction are DECIMAL of any size. Texts that are no JSON,
    or no object, have no fields.
    """
    sets = _fields(texts, hour).groupingSets([("field", hour), ("field",)], "field", hour)
    plain = F.regexp_replace(F.schema_of_variant_agg("content"), r"DECIMAL\(\d+,\d+\)", "DECIMAL")
    merged = sets.agg(F.grouping_id().alias("level"), F.count("*").alias("n"), plain.alias("shape"))
    in_hour = F.col("level") == 0
    return merged.groupBy("field").agg(
        F.count_if(in_hour).alias("hours"),
        F.sum(F.when(in_hour, F.col("n"))).alias("events"),
        F.array_join(F.array_sort(F.collect_set(F.when(in_hour, F.col("shape")))), "; ").alias("shapes"),
        F.max(F.when(~in_hour, F.col("shape"))).alias("unified"),
    )


def shape_type(shape: str) -> str:
    """The Spark type of a variant's shape; fields that are always null become text."""
    named = {"OBJECT<": "STRUCT<", "VOID": "STRING"}
    return re.sub(r"`(?:[^`]|``)*`|\bOBJECT<|\bVOID\b(?!:)", lambda m: named.get(m.group(), m.group()), shape)


def read_unified(texts: DataFrame, corrupt: str = "_corrupt") -> DataFrame:
    """JSON objects as columns of the types that hold all of them, beside the columns of ``texts``.

    The type of the whole set is one row, found by one pass. A field whose types do not fit together
    stays a VARIANT. A text that is no JSON object is kept in column ``corrupt`` and its fields are
    null; null texts have null fields. Without any object there are no field columns. A field named like
    a column of ``texts`` (names are compared without case) raises.
    """
    others = [c for c in texts.columns if c != "value"]
    parsed = texts.select(*others, "value", F.try_parse_json("value").alias("v"))
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT<"), F.lit(False))
    kept = F.when(is_object, F.col("v"))
    shape = parsed.agg(F.schema_of_variant_agg(kept)).first()[0]
    bad = F.when(~is_object, F.col("value")).alias(corrupt)
    if not shape.startswith("OBJECT<") or shape == "OBJECT<>":
        return parsed.select(*others, bad)
    typed = parsed.select(*others, bad, F.variant_get(kept, "$", shape_type(shape)).alias("v"))
    names = typed.schema["v"].dataType.names
    taken = {c.lower() for c in (*others, corrupt)}
    clashes = [n for n in names if n.lower() in taken]
    if clashes:
        raise ValueError(f"fields named like columns of the texts: {clashes}")
    return typed.select(*others, *[F.col("v").getField(n).alias(n) for n in names], corrupt)


def row_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("cnt"))


def sample_events(events: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` events by id."""
    return events.select("id", "type", "created_at").orderBy("id").limit(n)
