"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import scratch_dir

#: What separates words once A-Z are lower case: ASCII other than letters and digits.
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What separates tokens of the language model: ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, compression: str = "snappy", options: dict[str, int] | None = None) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage and makes the size known."""
    path = scratch_dir(df.sparkSession, label)
    df.write.options(compression=compression, **(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else changed; null becomes empty.

    ``lower`` is much faster than ``translate`` and differs from it for non-ASCII letters only,
    so it serves the texts that have none.
    """
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def split_words(text: Column, breaks: str = WORD_BREAK) -> Column:
    """Words of a text that is in lower case already; no empty ones."""
    return F.array_remove(F.split(text, breaks), "")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's text leaves the remainder; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == remainder


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone: 52 bits of the MD5 of their texts."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores after it until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The frame with columns of these names (in any case) under free ones, and what names them as before."""
    moved = {c: free_name(df, f"own_{c.lower()}") for c in df.columns if c.lower() in names}
    back = {free: name for name, free in moved.items()}
    return df.withColumnsRenamed(moved), lambda out: out.withColumnsRenamed(back)
