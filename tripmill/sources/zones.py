"""Zone seed: a small CSV dimension whose path is a parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmill.schemas import ZONE_SEED


def read_zone_seed(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with quoted text; ``N/A`` and ``NA`` stay plain strings."""
    return (
        spark.read.schema(ZONE_SEED)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )
