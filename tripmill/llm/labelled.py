"""Bounded, labelled samples and the quality of a fit on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import held_out


def label_sample(labels: DataFrame, label: str, modulus: int, remainder: int, bound: int) -> dict[int, int]:
    """At most ``bound`` labelled ids that are not held out, in the order of their hash.

    An id labelled twice takes the larger label; null ids and labels other than 0 and 1 are no labels.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"), modulus, remainder))
    one = known.groupBy("doc_id").agg(F.max(label).alias("y"))
    return {r.doc_id: r.y for r in one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).collect()}


def sampled_texts(docs: DataFrame, ids: dict[int, int]) -> DataFrame:
    """The texts of the sampled ids; one for each id where an id repeats."""
    picked = docs.filter(F.col("doc_id").isin(list(ids) or [None]))
    return picked.groupBy("doc_id").agg(F.max(F.coalesce("text", F.lit(""))).alias("text"))
