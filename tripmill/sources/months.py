"""Monthly Parquet sets: explicit month paths, footers only, one scan per distinct schema."""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Fixed value: fewer files than this draws a warning for a two-year load.
EXPECTED_MONTHS_WARNING = 20


@dataclass(frozen=True)
class MonthFile:
    ym: str
    path: str
    schema: T.StructType


def _footers(spark: SparkSession, ym: str, path: str) -> list[MonthFile]:
    """A month with the schema of all its files, or its files one by one where their types differ."""
    try:
        return [MonthFile(ym, path, spark.read.option("mergeSchema", True).parquet(path).schema)]
    except (PySparkException, Py4JJavaError) as err:  # the second is what a failed merge comes as
        if "PATH_NOT_FOUND" in str(err):
            return []
        if "CANNOT_MERGE" not in str(err):
            raise
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path")
    files = sorted(r.path for r in names.collect())
    return [MonthFile(ym, f, spark.read.parquet(f).schema) for f in files]


def month_files(spark: SparkSession, template: str, months: Sequence[str]) -> list[MonthFile]:
    """The months that exist, with their schemas.

    ``template`` holds ``{ym}``, e.g. ``/raw/yellow_{ym}.parquet`` or ``/raw/ym={ym}``. The month
    list is explicit, so an earlier merge result in the same folder is never read back in. Only
    footers are read; the work here grows with the number of months, not with the rows.
    """
    with ThreadPoolExecutor(max_workers=16) as pool:
        files = [f for found in pool.map(lambda ym: _footers(spark, ym, template.format(ym=ym)), months) for f in found]
    if not files:
        raise FileNotFoundError(f"no Parquet month matches {template!r}")
    there = {f.ym for f in files}
    if len(there) < min(EXPECTED_MONTHS_WARNING, len(months)):
        absent = [ym for ym in months if ym not in there]
        log.warning("only %d of %d months found for %s, without %s", len(there), len(months), template, ", ".join(absent))
    return files


def by_schema(files: Sequence[MonthFile]) -> list[tuple[T.StructType, list[MonthFile]]]:
    """Files grouped by identical schema, in order of first appearance."""
    groups: dict[str, list[MonthFile]] = {}
    for f in files:
        groups.setdefault(f.schema.json(), []).append(f)
    return [(members[0].schema, members) for members in groups.values()]


def scan_group(spark: SparkSession, schema: T.StructType, files: Sequence[MonthFile]) -> DataFrame:
    """One distributed scan over files that share a schema."""
    return spark.read.schema(schema).parquet(*[f.path for f in files])


def scan_months(spark: SparkSession, template: str, months: Sequence[str]) -> DataFrame:
    """One scan of a month set whose files agree on types (drifting types: operators.align).

    The footers are read by one distributed job. A column that some months lack reads as null; a
    type conflict is an error. Months without a file are left out.
    """
    some_of = template.format(ym="{" + ",".join(months) + "}")
    try:
        return spark.read.option("mergeSchema", True).parquet(some_of)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            raise FileNotFoundError(f"no Parquet month matches {template!r}") from err
        raise


def listed_months(spark: SparkSession, template: str) -> DataFrame:
    """ym, files, bytes of the months that have files, from their metadata alone: no file is opened.

    Files without a byte are no month. The months are read from the paths, where ``{ym}`` stands.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(template.format(ym="*"))
    before, after = (re.escape(x) for x in template.split("{ym}", 1))
    pattern = before.split("/")[-1] + r"(\d{4}-\d{2})" + after
    listed = found.select(F.regexp_extract("path", pattern, 1).alias("ym"), "length").where("length > 0 and ym <> ''")
    return listed.groupBy("ym").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def missing_months(calendar: DataFrame, observed: DataFrame) -> DataFrame:
    """Calendar months (``ym``) without any observed row."""
    return calendar.join(observed.select("ym").distinct(), "ym", "left_anti")


def observed_months(df: DataFrame, ts_col: str) -> DataFrame:
    """Distinct months of a timestamp column; reduced per partition before the shuffle."""
    starts = df.where(F.col(ts_col).isNotNull()).select(F.trunc(ts_col, "month").alias("month"))
    return starts.distinct().select("month", F.date_format("month", "yyyy-MM").alias("ym"))
