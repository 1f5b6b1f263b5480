"""Message topics: a stream or batch of one text column named ``value``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_topic(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    since: datetime | None = None,
) -> DataFrame:
    """A folder of text files, one message per line, as a stream.

    ``since`` starts at the latest messages: files last changed before that moment are skipped.
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.load(path)
    if since is not None:
        changed = F.col("_metadata.file_modification_time")
        lines = lines.where(changed >= F.timestamp_micros(F.lit(int(since.timestamp() * 1_000_000))))
    return lines.select("value")


def kafka_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str
) -> DataFrame:
    """A broker topic as a stream; needs Spark's Kafka package on the class path.

    Positions live in the query's checkpoint, so a restart goes on where it stopped and
    ``starting`` matters only for the first start.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
        .selectExpr("cast(value as string) as value")
    )


def publish_files(messages: DataFrame, path: str) -> None:
    """Write a one-column frame of message texts, one message per line."""
    messages.select("value").write.mode("append").text(path)


def publish_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    (
        messages.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
