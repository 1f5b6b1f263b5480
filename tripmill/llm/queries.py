"""Registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

import public_tokenizers

from tripmill.llm import (
    ann_scan,
    backoff_lm,
    decontaminate,
    histogram_shard,
    jaccard_join,
    language_kernel,
    license_scan,
    phrase_mining,
    poisson_mix,
    quality_crf,
    token_alignment,
    token_index,
    toxicity_fm,
)
from tripmill.llm.common import table

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_crf(spark, sf_dir):
    return quality_crf.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


@query
def op3_ann_scan(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return ann_scan.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


@query
def op4_license_scan(spark, sf_dir):
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@query
def op5_toxicity_fm(spark, sf_dir):
    return toxicity_fm.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_token_index(spark, sf_dir):
    return token_index.token_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_histogram_shard(spark, sf_dir):
    return histogram_shard.shard_documents(table(spark, sf_dir, "documents"), 8)


@query
def op8_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_backoff_lm(spark, sf_dir):
    return backoff_lm.lm_scores(table(spark, sf_dir, "documents"))


@query
def op10_poisson_mix(spark, sf_dir):
    return poisson_mix.poisson_mix(table(spark, sf_dir, "documents"))


@query
def op11_language_kernel(spark, sf_dir):
    return language_kernel.languages(table(spark, sf_dir, "documents"))


@query
def op12_token_alignment(spark, sf_dir):
    byte_level, pieces = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.alignment(table(spark, sf_dir, "documents"), byte_level, pieces)


@query
def op13_phrase_mining(spark, sf_dir):
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))
