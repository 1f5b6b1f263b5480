"""Operator 10: mix sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored, uniform

#: Largest mean that one draw inverts; larger means are sums of independent draws.
DRAW_MEAN = 8.0
#: Terms of the distribution that one draw tells apart: the tail beyond is below 1e-30.
TERMS = 64
TEMPERATURE = 0.5


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0) -> DataFrame:
    """One row per source: its size, target weight and mean repetition rate.

    Size is the UTF-8 bytes of the texts plus one for each row. ``weights`` are relative; a source
    that is not named gets none. Without weights a source's weight is its size to the power
    ``TEMPERATURE``. ``epochs`` is the size of the mixture relative to the input. A null source
    is a source of its own, named by null.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    sizes = docs.groupBy("source").agg(F.sum(size).cast("bigint").alias("source_bytes"))
    if weights is None:
        raw = F.pow(F.col("source_bytes").cast("double"), F.lit(TEMPERATURE))
    elif weights:
        raw = F.coalesce(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])[F.col("source")], F.lit(0.0))
    else:
        raw = F.lit(0.0)
    sizes = stored(sizes.withColumn("raw_weight", raw), "mix-sizes")
    # rounded, so that the order of additions cannot show
    all_bytes, all_weight = sizes.agg(F.sum("source_bytes"), F.round(F.sum("raw_weight"), 6)).first()
    target = F.col("raw_weight") / F.lit(all_weight) if all_weight else F.lit(0.0)
    return sizes.select(
        "source",
        "source_bytes",
        target.alias("target_weight"),
        (target * F.lit(epochs) * F.lit(all_bytes) / F.col("source_bytes")).alias("rate"),
    )


def _draws(rates: DataFrame) -> DataFrame:
    """Adds the number of draws and the cumulative distribution of one draw."""
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / DRAW_MEAN)).cast("int")
    first = F.exp(-F.col("mean"))
    start = F.struct(F.array(first).alias("cdf"), first.alias("term"), first.alias("sum"))

    def extend(acc: Column, k: Column) -> Column:
        term = acc["term"] * F.col("mean") / k
        return F.struct(
            F.concat(acc["cdf"], F.array(acc["sum"] + term)).alias("cdf"), term.alias("term"), (acc["sum"] + term).alias("sum")
        )

    terms = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, extend)["cdf"]
    return rates.withColumn("draws", draws).withColumn("mean", F.col("rate") / F.col("draws")).withColumn("cdf", terms)


def poisson_mix(
    docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, seed: int = 17, by: tuple[Column, ...] = ()
) -> DataFrame:
    """Each document as often as a hash-seeded Poisson draw says, in a globally shuffled order.

    The mean is the source's repetition rate: target share of the mixture over the source's size.
    A draw inverts the distribution at a number made from seed and doc_id, so a rerun, a retry or
    another partitioning draws the same. Adds ``copies`` (of the document), ``copy`` (from 0) and
    ``order_key``; rows are dealt by the order key and sorted by it within each partition.

    Only the small table of rates is joined; Spark broadcasts it if its stored size allows, else
    the join is shuffled and a hot source is split as a skewed join. Rows of one doc_id (null
    included) draw alike, unless the expressions ``by`` tell them apart. Null and empty texts count as size one. Columns of the input named like
    the added ones are replaced. No rows give no rows.
    """
    own = [c for c in docs.columns if c.lower() not in ("copies", "copy", "order_key")]
    rates = stored(_draws(source_rates(docs, weights, epochs)), "mix-rates")
    rates = rates.select(F.col("source").alias("_source"), F.struct("draws", "cdf").alias("_law"))
    joined = docs.select(*own).join(rates, F.col("source").eqNullSafe(F.col("_source")))

    def drawn(i: Column) -> Column:
        u = uniform(F.lit(seed), F.col("doc_id"), *by, i)
        return F.size(F.filter(F.col("_law.cdf"), lambda c: c <= u))

    one = drawn(F.lit(0))
    many = F.aggregate(F.sequence(F.lit(0), F.col("_law.draws") - 1), F.lit(0), lambda acc, i: acc + drawn(i))
    counted = joined.withColumn("copies", F.when(F.col("_law.draws") == 1, one).otherwise(many))
    copies = counted.filter("copies > 0").select(
        *own, "copies", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    )
    order = uniform(F.lit(seed + 1), F.col("doc_id"), *by, F.col("copy"))
    return copies.withColumn("order_key", order).repartition("order_key").sortWithinPartitions("order_key", "doc_id", "copy")
