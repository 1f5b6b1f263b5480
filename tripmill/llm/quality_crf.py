"""Operator 1: document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import held_out
from tripmill.llm.labelled import label_sample, sampled_texts

#: Labelled documents that a fit may read.
SAMPLE = 10_000
MODULUS, REMAINDER = 5, 0
THRESHOLD = 0.3
#: Bytes of text that are turned into features at a time; a longer text is taken alone.
SLICE_BYTES = 8 << 20

UPPER, LETTER, DIGIT, SPACE, STOP, MARK, SYMBOL = range(7)
_CLASS = np.full(256, SYMBOL, np.uint8)
_CLASS[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)] = LETTER
_CLASS[128:] = LETTER
_CLASS[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)] = UPPER
_CLASS[np.frombuffer(b"0123456789", np.uint8)] = DIGIT
_CLASS[np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8)] = SPACE
_CLASS[np.frombuffer(b".,;:?'\"()-", np.uint8)] = STOP
_CLASS[np.frombuffer(b"!", np.uint8)] = MARK

#: Bin edges of a line's features.
EDGES = {
    "upper": [0.01, 0.03, 0.06, 0.12, 0.3, 0.7],
    "symbols": [0.001, 0.01, 0.03, 0.08, 0.2],
    "marks": [0.001, 0.01, 0.03, 0.08],
    "digits": [0.001, 0.02, 0.1, 0.3],
    "stops": [0.005, 0.01, 0.02, 0.04, 0.1],
    "distinct": [0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.97],
    "words": [1, 2, 4, 8, 16, 32, 64, 128, 256],
    "word_bytes": [2, 3, 4, 5, 6, 8, 12],
    "repeats": [0.01, 0.05, 0.2, 0.5],
    "new_lines": [0.2, 0.5, 0.8, 0.99],
}
_OFFSETS = np.cumsum([0, *[len(e) + 1 for e in EDGES.values()]])
FEATURES = int(_OFFSETS[-1])


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature index per line and kind, line lengths in bytes, lines per text); every text has a line."""
    raw = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-8", "replace"), np.uint8)
    ends = np.flatnonzero(raw == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    kinds = _CLASS[raw]
    count = [np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(7)]
    length = ends - starts
    lines_of, words, distinct, repeats, fresh = [], [], [], [], []
    for text in texts:
        lines = text.split("\n")
        lines_of.append(len(lines))
        fresh.extend([len(set(lines)) / len(lines)] * len(lines))
        for line in lines:
            w = line.split()
            words.append(len(w))
            distinct.append(len(set(w)))
            repeats.append(sum(map(str.__eq__, w, w[1:])))
    words, distinct, repeats = np.array(words), np.array(distinct), np.array(repeats)
    chars, some = np.maximum(1, length), np.maximum(1, words)
    values = {
        "upper": count[UPPER] / np.maximum(1, count[UPPER] + count[LETTER]),
        "symbols": count[SYMBOL] / chars,
        "marks": count[MARK] / chars,
        "digits": count[DIGIT] / chars,
        "stops": count[STOP] / chars,
        "distinct": distinct / some,
        "words": words,
        "word_bytes": length / some,
        "repeats": repeats / some,
        "new_lines": np.array(fresh),
    }
    bins = [_OFFSETS[i] + np.searchsorted(EDGES[k], values[k], side="right") for i, k in enumerate(EDGES)]
    return np.stack(bins, axis=1), length, np.array(lines_of)


@dataclass
class Chain:
    """Weights of the field: for a good line over a bad one, and of label pairs."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    pairs: np.ndarray  # label of a line, label of the next: 0 bad, 1 good
    slope: float = 1.0
    shift: float = 0.0

    def unary(self, bins: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        score = self.own[bins].sum(1)
        score[1:] += np.where(first[1:], 0, self.before[bins[:-1]].sum(1))
        score[:-1] += np.where(last[:-1], 0, self.after[bins[1:]].sum(1))
        return score


def _ends(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    first, last = np.zeros(counts.sum(), bool), np.zeros(counts.sum(), bool)
    first[starts], last[starts + counts - 1] = True, True
    return starts, first, last


def marginals(unary: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once: (P(good) per line, expected label pairs)."""
    starts = _ends(counts)[0]
    order = np.argsort(-counts, kind="stable")
    at = starts[order]
    active = np.searchsorted(-counts[order], -np.arange(1, counts.max() + 1), side="right")
    score = np.stack([np.zeros_like(unary), unary], axis=1)
    forward, backward = score.copy(), np.zeros_like(score)
    for t in range(1, len(active)):
        here = at[: active[t]] + t
        forward[here] += np.logaddexp.reduce(forward[here - 1][:, :, None] + pairs, axis=1)
    expected = np.zeros((2, 2))
    total = np.logaddexp.reduce(forward[starts + counts - 1], axis=1)
    for t in range(len(active) - 1, 0, -1):
        here = at[: active[t]] + t
        onward = pairs + (score[here] + backward[here])[:, None, :]
        backward[here - 1] = np.logaddexp.reduce(onward, axis=2)
        expected += np.exp(forward[here - 1][:, :, None] + onward - total[order[: active[t]], None, None]).sum(0)
    both = forward + backward
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -40, 40))), expected


def _by_document(chance: np.ndarray, length: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean P(good) of each document's lines, weighted by their length; empty lines weigh one byte."""
    starts, weight = _ends(counts)[0], length + 1
    return np.add.reduceat(chance * weight, starts) / np.add.reduceat(weight, starts)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_chain(texts: list[str], y: np.ndarray, epochs: int = 16, rate: float = 0.05, penalty: float = 1e-3) -> Chain:
    """Maximum conditional likelihood; a document's lines all take its label.

    Adam over mini-batches of documents, then a logistic curve from the weighted marginals to the
    labels. Without both labels the chain is blank and the curve gives the prior.
    """
    prior = (y.sum() + 1) / (len(y) + 2)
    chain = Chain(np.zeros(FEATURES), np.zeros(FEATURES), np.zeros(FEATURES), np.zeros((2, 2)), 0.0, float(_logit(prior)))
    if len(y) == 0 or y.min() == y.max():
        return chain
    parts_of = [line_features(part) for part in _slices(texts)]
    bins, length, counts = (np.concatenate(x) for x in zip(*parts_of, strict=True))
    del parts_of
    starts, _, _ = _ends(counts)
    rng = np.random.default_rng(3)
    theta = np.zeros(3 * FEATURES + 4)
    first_moment, second_moment, step = np.zeros_like(theta), np.zeros_like(theta), 0

    def parts(v: np.ndarray) -> Chain:
        return Chain(v[:FEATURES], v[FEATURES : 2 * FEATURES], v[2 * FEATURES : 3 * FEATURES], v[-4:].reshape(2, 2))

    def rows(documents: np.ndarray) -> np.ndarray:
        return np.concatenate([np.arange(starts[d], starts[d] + counts[d]) for d in documents])

    for _ in range(epochs):
        shuffled = rng.permutation(len(y))
        for at in range(0, len(y), 512):
            picked = shuffled[at : at + 512]
            b, n = bins[rows(picked)], counts[picked]
            _, first, last = _ends(n)
            chain = parts(theta)
            chance, expected = marginals(chain.unary(b, first, last), n, chain.pairs)
            # each document counts once, whatever its number of lines
            share = np.repeat(1 / n, n)
            error = (chance - np.repeat(y[picked], n)) * share / len(picked)
            wide = np.repeat(error[:, None], b.shape[1], axis=1)
            grad = np.zeros_like(theta)
            grad[:FEATURES] = np.bincount(b.ravel(), wide.ravel(), FEATURES)
            grad[FEATURES : 2 * FEATURES] = np.bincount(b[:-1][~first[1:]].ravel(), wide[1:][~first[1:]].ravel(), FEATURES)
            grad[2 * FEATURES : 3 * FEATURES] = np.bincount(b[1:][~last[:-1]].ravel(), wide[:-1][~last[:-1]].ravel(), FEATURES)
            seen = np.zeros((2, 2))
            seen[1, 1], seen[0, 0] = (n[y[picked] == 1] - 1).sum(), (n[y[picked] == 0] - 1).sum()
            grad[-4:] = ((expected - seen) / max(1, n.sum())).ravel()
            grad += penalty * theta
            step += 1
            first_moment = 0.9 * first_moment + 0.1 * grad
            second_moment = 0.999 * second_moment + 0.001 * grad**2
            theta = theta - rate * (first_moment / (1 - 0.9**step)) / (np.sqrt(second_moment / (1 - 0.999**step)) + 1e-8)
    chain = parts(theta)
    _, first, last = _ends(counts)
    x = _logit(_by_document(marginals(chain.unary(bins, first, last), counts, chain.pairs)[0], length, counts))
    a, c = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic regression on x
        p = 1 / (1 + np.exp(-np.clip(a * x + c, -30, 30)))
        w, e = p * (1 - p) + 1e-9, p - y
        hessian = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        move = np.linalg.solve(hessian, [(e * x).sum(), e.sum()])
        a, c = a - move[0], c - move[1]
    chain.slope, chain.shift = max(0.01, float(a)), float(c)
    return chain


def fit_quality(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Chain:
    """Fit on at most ``bound`` labelled documents that are not held out."""
    ids = label_sample(labels, "quality", MODULUS, REMAINDER, bound)
    sample = sampled_texts(docs, ids).toArrow().to_pylist()
    sample.sort(key=lambda r: r["doc_id"])
    return fit_chain([r["text"] for r in sample], np.array([ids[r["doc_id"]] for r in sample], float))


def _slices(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= SLICE_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def score_quality(docs: DataFrame, chain: Chain) -> DataFrame:
    """Adds score (0 to 1), predicted (score >= 0.3), n_lines and line_scores to the documents.

    ``line_scores`` holds P(good) of every line. Null and empty texts are one empty line. Input
    columns of these names are replaced. Texts are read whole.
    """
    added = ("score", "n_lines", "line_scores")
    kept = [c for c in docs.columns if c.lower() not in (*added, "predicted", "_text")]
    schema = T.StructType(
        [
            *docs.select(*kept).schema.fields,
            T.StructField("score", T.DoubleType()),
            T.StructField("n_lines", T.IntegerType()),
            T.StructField("line_scores", T.ArrayType(T.FloatType())),
        ]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            scores, lines, line_scores = [], [], []
            for part in _slices(texts):
                bins, length, counts = line_features(part)
                _, first, last = _ends(counts)
                chance, _ = marginals(chain.unary(bins, first, last), counts, chain.pairs)
                x = _logit(_by_document(chance, length, counts))
                scores.append(1 / (1 + np.exp(-np.clip(chain.slope * x + chain.shift, -40, 40))))
                lines.append(counts)
                line_scores.append(chance)
            empty = [np.zeros(0)]
            counts = np.concatenate(lines or empty).astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            per_line = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(line_scores or empty), pa.float32()))
            columns = [*batch.columns[:-1], pa.array(np.concatenate(scores or empty)), pa.array(counts), per_line]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    texts = docs.select(*kept, F.coalesce("text", F.lit("")).alias("_text"))
    return texts.mapInArrow(score, schema).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def quality(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, n_lines, bad_lines of every row."""
    chain = fit_quality(docs, labels, bound)
    scored = score_quality(docs.select("doc_id", "text"), chain)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"),
        "score",
        "predicted",
        "n_lines",
        F.size(F.filter("line_scores", lambda p: p < 0.5)).alias("bad_lines"),
    )
