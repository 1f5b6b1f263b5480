"""The pipeline against plain Python, and the queries against their SQL twins."""

from __future__ import annotations

import os
from functools import reduce

import duckdb
import pandas as pd
import pytest

from pyspark.sql import Column
from pyspark.sql import functions as F

import corpus_pipeline
from check import TABLES, compare
from tripmill.llm.queries import QUERIES
from tripmill.llm.twins import ORACLE

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    frame = QUERIES[name](spark, FOLDER)
    got = pd.DataFrame([r.asDict() for r in frame.collect()], columns=frame.columns, dtype=object)
    cursor = con.execute(ORACLE[name])
    want = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description], dtype=object)
    assert compare(got, want) == ""


def test_every_stage_keeps_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and ids <= before, name
        before = ids
    shards = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in shards} == before


def test_every_stage_keeps_columns_with_clashing_names(spark):
    """Columns named like those that the operators add come back with their own values."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = ["score", "Predicted", "_terms", "copies", "copy", "order_key", "_source", "_law", "_md5", "_ID", "_text", "fp", "label", "of_md5", "own_score"]
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")))
    for stage_name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns, stage_name
        strange = [F.col(n) != F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in names]
        assert kept.count() > 0 and kept.filter(reduce(Column.__or__, strange)).isEmpty(), stage_name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()
