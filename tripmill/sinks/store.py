"""Single files of the shared store, by the file system that Spark itself uses for the path."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file unless there is one; of several callers one succeeds."""
    fs, place = _open(spark, path)
    try:
        out = fs.create(place, False)
    except Py4JJavaError as err:
        if fs.exists(place):
            return False
        raise err
    out.write(bytearray(text.encode()))
    out.close()
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that is no longer needed; one that is not there is no error."""
    fs, place = _open(spark, path)
    fs.delete(place, True)
