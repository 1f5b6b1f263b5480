"""License scan, histogram shards and Poisson mixing."""

from __future__ import annotations

import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.corpus import docs, empty, odd
from tripmill.llm import histogram_shard, license_scan, poisson_mix


def test_license_phrases_and_templates(spark):
    texts = [
        "MIT License. mit\nlicense",
        "Licensed under CC BY-NC 4.0.",
        "version 2 0 of apache license the licensed",
        "mit licenses, amit license",
        None,
    ]
    rows = {r.doc_id: r for r in license_scan.license_scan(docs(spark, texts)).collect()}
    assert (rows[0].n_words, rows[0].n_base, rows[0].first_word, rows[0].last_word) == (4, 2, 0, 2)
    assert rows[0].base_labels == rows[0].labels == "mit" and rows[0].score == 1.0
    assert rows[1].base_labels == "" and rows[1].labels == "cc-by-nc" and rows[1].score == 1.0
    assert rows[2].labels == "apache"
    assert rows[3].labels == "" and rows[3].score == 0.0 and rows[3].first_word is None
    assert rows[4].n_words == 0


def test_license_containment_equals_brute_force(spark):
    templates = [("t", "a b c d e f g h i j"), ("u", "a x y z w")]
    lines = ["a b c d e f g h", "j i h g f e d", "x y z w", "a a a a x y z", "a b c d e f g h q r s t", "w z"]
    want = {}
    for i, line in enumerate(lines):
        held = set(line.split())
        want[i] = {t for t, s in templates if len(held & set(s.split())) >= 0.8 * len(s.split())}
    got = license_scan.license_scan(docs(spark, lines), templates).collect()
    assert {r.doc_id: set(filter(None, r.labels.split(","))) for r in got} == want


def test_wrapped_statements_are_found_and_scattered_words_are_not(spark):
    wrapped = [(label, text.split()) for label, text in license_scan.TEMPLATES]
    texts = [" ".join(["other"] * (7 * i)) + "\n" + "\n".join(w) + "\nmore" * 50 for i, (_, w) in enumerate(wrapped)]
    texts.append(" ".join(w + " filler" * 100 for w in "licensed under cc by nc 4 0".split()))
    got = {r.doc_id: r for r in license_scan.license_scan(docs(spark, texts)).collect()}
    for i, (label, _) in enumerate(wrapped):
        assert label in got[i].labels.split(",") and got[i].score == 1.0
    assert got[len(wrapped)].labels == "" and got[len(wrapped)].score == 0.0


def test_license_runs_equal_brute_force(spark):
    rng = random.Random(4)
    templates = [("t", "a b c d e"), ("u", "f g h")]
    texts = [" ".join(rng.choices("abcdefghijkl\n", k=rng.randint(0, 60))) for _ in range(150)]
    got = {r.doc_id: r.labels for r in license_scan.license_scan(docs(spark, texts), templates).collect()}
    for i, text in enumerate(texts):
        words = text.split()
        runs = [set(words[at : at + 10]) for at in range(0, max(1, len(words) - 5), 5)]
        want = {x for x, s in templates if any(len(run & set(s.split())) >= 0.8 * len(s.split()) for run in runs)}
        assert got[i] == ",".join(sorted(want))


def test_shards_are_near_equal_and_gapless(spark):
    texts = ["x" * (i % 97) for i in range(3000)] + ["the same text"] * 1500
    out = histogram_shard.shard_documents(docs(spark, texts), 8, bin_rows=200).collect()
    sizes, slots = Counter(), {}
    for r in out:
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(out) == 4500 and sorted(sizes) == list(range(8))
    assert max(sizes.values()) - min(sizes.values()) <= 200
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id]) + 1 for r in out)


def test_one_row_a_third_of_all_is_split(spark):
    out = histogram_shard.shard_documents(docs(spark, [(1, "copy")] * 900 + [f"text {i}" for i in range(1800)]), 8, 100)
    sizes = [r.s for r in out.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 1.1 * min(sizes)


def test_mix_follows_the_weights_and_repeats(spark):
    corpus = docs(spark, [f"document number {i:05d}" for i in range(4000)], lambda i: "hot" if i % 3 else "cold")
    mixed = poisson_mix.poisson_mix(corpus, {"hot": 1.0, "cold": 3.0}, epochs=2.0)
    count = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(count["cold"] / count["hot"] - 3) < 0.3 and abs(sum(count.values()) - 8000) < 400
    again = poisson_mix.poisson_mix(corpus.repartition(7), {"hot": 1.0, "cold": 3.0}, epochs=2.0)
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, again.collect()))


def test_rows_without_ids_draw_apart_in_the_pipeline(spark):
    corpus = docs(spark, [(None, f"text {i}") for i in range(400)])
    mixed = corpus_pipeline._mix(spark, corpus, "")
    assert abs(mixed.count() - 400) < 100 and 200 < mixed.distinct().count() < 300


def test_large_rates_are_sums_of_draws(spark):
    corpus = docs(spark, [f"t{i}" for i in range(50)], lambda i: "rare" if i < 5 else "most")
    mixed = poisson_mix.poisson_mix(corpus, {"rare": 1.0}, epochs=10.0)
    assert {r.source for r in mixed.select("source").distinct().collect()} == {"rare"}
    # ten times all 190 bytes, in rows of three bytes
    assert abs(mixed.count() - 633) < 80


def test_odd_rows_and_empty_tables(spark):
    assert license_scan.license_scan(odd(spark)).count() == 7
    out = histogram_shard.shard_documents(odd(spark), 4).collect()
    assert len(out) == 7 and {r.size for r in out if r.doc_id in (0, 1)} == {1}
    poisson_mix.poisson_mix(odd(spark).withColumn("copy", F.lit("clash"))).collect()
    for op in (license_scan.license_scan, histogram_shard.shard_documents, poisson_mix.poisson_mix):
        assert op(empty(spark)).count() == 0
