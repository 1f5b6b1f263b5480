"""Quality field, toxicity machine and language model."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np

from tests.llm.corpus import docs, empty, odd, words
from tripmill.llm import backoff_lm, quality_crf, toxicity_fm


def _held(doc_id, modulus, remainder):
    return zlib.crc32(str(doc_id).encode()) % modulus == remainder


def test_quality_separates_held_out_documents(spark):
    good = [". ".join(" ".join(words(12, i * 7 + k)).capitalize() for k in range(6)) for i in range(150)]
    bad = ["\n".join(f"{w}{w.upper()}### " * 9 for w in words(4, 1000 + i)) for i in range(150)]
    corpus = docs(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)], "doc_id long, quality int")
    rows = quality_crf.quality(corpus, labels).collect()
    out = [r for r in rows if r.held_out]
    assert len(rows) == 300 and len(out) > 30
    assert all(r.held_out == _held(r.doc_id, 5, 0) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([(r.predicted == 1) == (r.doc_id < 150) for r in out]) > 0.95


def test_marginals_equal_enumeration():
    unary, pairs = np.array([0.3, -1.2, 0.8, 2.0]), np.array([[0.5, -0.2], [0.1, 0.9]])
    chance, _ = quality_crf.marginals(unary, np.array([3, 1]), pairs)
    total, good = 0.0, np.zeros(3)
    for code in range(8):
        y = [(code >> i) & 1 for i in range(3)]
        w = math.exp(sum(unary[i] * y[i] for i in range(3)) + pairs[y[0], y[1]] + pairs[y[1], y[2]])
        total, good = total + w, good + w * np.array(y)
    assert np.allclose(chance[:3], good / total) and math.isclose(chance[3], 1 / (1 + math.exp(-2.0)))


def test_toxicity_learns_insults(spark):
    texts = [" ".join(words(40, i)) + (" you vequar" if i % 4 == 0 else "") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    rows = toxicity_fm.toxicity(docs(spark, texts), labels).collect()
    out = [r for r in rows if r.held_out]
    assert all(r.held_out == _held(r.doc_id, 4, 2) for r in rows)
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in out]) > 0.9


def test_machine_margin_is_linear_plus_pairs():
    rng = np.random.default_rng(0)
    slots = np.zeros(toxicity_fm.BUCKETS, np.int32)
    slots[[5, 6, 7]] = [1, 2, 3]
    w, v = np.append(0, rng.normal(size=3)), np.vstack([np.zeros(4), rng.normal(size=(3, 4))])
    machine = toxicity_fm.Machine(0.1, slots, w, v)
    pairs = (v[1] @ v[2] + v[1] @ v[3] + v[2] @ v[3]) / 3
    got = machine.margins(np.array([5, 6, 7, 9, 9]), np.array([0, 4, 4, 5]))
    assert np.allclose(got, [0.1 + w[1:].sum() + pairs, 0.1, 0.1])


def test_models_without_labels_and_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    for fit in (quality_crf.quality, toxicity_fm.toxicity):
        assert {r.score for r in fit(odd(spark), none).collect()} == {0.5}
        assert all(0 <= r.score <= 1 for r in fit(odd(spark), some).collect())
        assert fit(empty(spark), some).count() == 0


def test_lm_equals_brute_force(spark):
    texts = [" ".join(words(60, i % 9)) + " The the" for i in range(60)] + ["", None, "\t \n"]
    rows = {r.doc_id: r for r in backoff_lm.lm_scores(docs(spark, texts), part_bytes=500).collect()}
    lists = [[*("" if t is None else t).lower().split(), None] for t in texts]
    train = [i for i in range(len(texts)) if not _held(i, 7, 2)]
    uni = Counter(w for i in train for w in lists[i])
    pair = Counter(p for i in train for p in zip(["^", *lists[i]], lists[i], strict=False))
    n, v, mu = sum(uni.values()), len(uni), backoff_lm.MU
    state = {**uni, "^": len(train)}
    for i, tokens in enumerate(lists):
        base = score = 0.0
        for h, w in zip(["^", *tokens], tokens, strict=False):
            p = (uni[w] + 1) / (n + v + 1)
            base += math.log10(p)
            score += math.log10((pair[h, w] + mu * p) / (state.get(h, 0) + mu))
        r = rows[i]
        assert math.isclose(r.base_score, base, abs_tol=1e-6) and math.isclose(r.score, score, abs_tol=1e-6)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(uni[w] > 0 for w in tokens), n)
        assert r.held_out == _held(i, 7, 2)


def test_lm_does_not_depend_on_blocks(spark, monkeypatch):
    corpus = docs(spark, [" ".join(words(50, i % 11)) for i in range(80)])
    whole = sorted(map(tuple, backoff_lm.lm_scores(corpus).collect()))
    # rows of several scan tasks and many parts give the same sums
    parted = sorted(map(tuple, backoff_lm.lm_scores(corpus.repartition(5), part_bytes=300).collect()))
    assert whole == parted


def test_lm_odd_rows(spark):
    assert backoff_lm.lm_scores(odd(spark)).count() == 7
    assert backoff_lm.lm_scores(empty(spark)).count() == 0


def test_language_model_survives_another_split_of_the_scan(spark, tmp_path, conf):
    docs(spark, [" ".join(words(300, i)) for i in range(60)]).repartition(6).write.parquet(str(tmp_path / "d"))
    frame = spark.read.parquet(str(tmp_path / "d"))
    want = sorted(tuple(r) for r in backoff_lm.lm_scores(frame).collect())
    made = backoff_lm.lm_scores(frame)
    conf("spark.sql.files.maxPartitionBytes", "4096")
    conf("spark.sql.files.openCostInBytes", "64")
    assert sorted(tuple(r) for r in made.collect()) == want


def test_machine_learns_pairs_that_linear_weights_cannot():
    """An insult with a group is toxic; two insults or two groups are not, so no term alone tells."""
    rng = np.random.default_rng(8)
    rows, y = [], []
    for _ in range(6000):
        kinds = rng.integers(0, 2, 2)
        pair = [100 * k + rng.integers(0, 5) for k in kinds]
        rows.append(np.unique(np.array([*pair, *rng.integers(1000, 1200, 4)])))
        y.append(float(kinds[0] != kinds[1]))
    y = np.array(y)
    right = {}
    for factors in (0, toxicity_fm.FACTORS):
        machine = toxicity_fm.fit_machine(rows[:5000], y[:5000], epochs=60, factors=factors)
        offsets = np.cumsum([0, *[len(r) for r in rows[5000:]]])
        right[factors] = np.mean((machine.margins(np.concatenate(rows[5000:]), offsets) > 0) == y[5000:])
    assert right[0] < 0.65 and right[toxicity_fm.FACTORS] > 0.8


def test_rare_terms_count_alike_in_every_sample_size():
    for size in (30, 30_000):
        rows = [np.array([7, 9])] * 4 + [np.array([9])] * size
        machine = toxicity_fm.fit_machine(rows, np.array([1.0] * 4 + [0.0] * size), epochs=1)
        assert machine.slots[7] > 0
