"""The corpus pipeline: stages over documents, each one of the corpus operators.

Each stage reads what the one before it kept, written as Parquet. Columns of documents stay as they
are up to the last stage, which returns each row's shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import decontaminate, histogram_shard, jaccard_join, poisson_mix, toxicity_fm
from tripmill.llm.common import set_aside, stored, table

SHARDS = 8


def _reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine, fit on their labels, does not reject."""
    machine = toxicity_fm.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    own, named_back = set_aside(docs, "score", "predicted", "_terms")
    return named_back(toxicity_fm.score_toxicity(own, machine).filter("predicted = 0").select(*own.columns))


def _keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one whose id names the class."""
    return jaccard_join.keep_one(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated so that sources take their target shares, in a shuffled order; drawn by id and text."""
    own, named_back = set_aside(docs, "copies", "copy", "order_key", "_source", "_law")
    return named_back(poisson_mix.poisson_mix(own, by=(F.md5("text"),)).select(*own.columns))


def _shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row, by bytes."""
    return histogram_shard.shard_documents(docs, SHARDS)


STAGES = [
    ("toxicity", _reject_toxic),
    ("ngram_jaccard_join", _keep_one),
    ("benchmark_decontamination", _decontaminate),
    ("source_mixing", _mix),
    ("sharding", _shard),
]
#: A factorization machine and MinHash bands cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return stored(STAGES[-1][1](spark, docs, sf_dir), f"pipeline-{STAGES[-1][0]}")
