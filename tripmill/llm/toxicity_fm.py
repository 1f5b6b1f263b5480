"""Operator 5: toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import held_out, lower_ascii, split_words
from tripmill.llm.labelled import label_sample, sampled_texts

#: Hash buckets of terms.
BUCKETS = 1 << 18
#: Labelled documents that a fit may read.
SAMPLE = 12_000
#: Buckets met in fewer sampled documents have no weight, however many documents are sampled.
MIN_COUNT = 3
#: Penalties on squared linear weights and on squared factors.
PENALTY = (3e-3, 3e-4)
FACTORS = 8
#: Rows of one step, and the fewest steps of a fit: a small sample is read more often.
BATCH, STEPS = 256, 500
#: Spread of the factors before the first step.
INITIAL = 0.1
#: Lengths of the word prefixes that are terms too.
PREFIXES = (4, 5)
MODULUS, REMAINDER = 4, 2
THRESHOLD = 0.3


def term_ids(text: Column) -> Column:
    """Distinct hash buckets of a text's terms: its words and their prefixes.

    Prefixes let inflected and compounded forms share weights. A-Z count as a-z; null is an empty text.
    """
    words = F.array_distinct(split_words(lower_ascii(text)))

    def prefixes(n: int) -> Column:
        longer = F.filter(words, lambda w: F.length(w) > n)
        return F.transform(longer, lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))

    terms = [words, *[prefixes(n) for n in PREFIXES]]
    return F.array_distinct(F.transform(F.concat(*terms), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int")))


@dataclass
class Machine:
    """Bias, linear weights and factors; index 0 of both stands for buckets without weight."""

    bias: float
    slots: np.ndarray  # bucket -> row of weights and factors
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bias, sum of weights and pairwise inner products of factors, for each row of ids.

        In the pairs a term counts 1 / sqrt(number of terms), so that long texts stay in range.
        """
        rows = self.slots[ids]
        rows_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[rows > 0]
        rows = rows[rows > 0]
        n = len(offsets) - 1
        linear = np.bincount(rows_of, self.weights[rows], n)
        pairs = np.zeros(n)
        for f in range(self.factors.shape[1]):
            v = self.factors[rows, f]
            pairs += np.bincount(rows_of, v, n) ** 2 - np.bincount(rows_of, v * v, n)
        return self.bias + linear + pairs / 2 / np.maximum(1, np.bincount(rows_of, minlength=n))

    def scores(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(ids, offsets), -40, 40)))


def fit_machine(
    rows: list[np.ndarray],
    y: np.ndarray,
    epochs: int = 12,
    rate: float = 0.01,
    seed: int = 5,
    factors: int = FACTORS,
    min_count: int = MIN_COUNT,
) -> Machine:
    """Minimise log loss with Adam over mini-batches; without both labels only the bias is fit.

    ``factors=0`` leaves the pairs out and fits linear weights alone. The rows are read ``epochs``
    times, or more often until STEPS steps are made.
    """
    prior = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(prior / (1 - prior)))
    slots = np.zeros(BUCKETS, np.int32)
    if len(y) == 0 or y.min() == y.max():
        return Machine(bias, slots, np.zeros(1), np.zeros((1, factors)))
    counts = np.bincount(np.concatenate(rows), minlength=BUCKETS)
    kept = np.flatnonzero(counts >= min_count)
    slots[kept] = np.arange(1, len(kept) + 1)
    rng = np.random.default_rng(seed)
    size = len(kept) + 1
    # one matrix: linear weight in column 0, factors in the rest, so Adam steps once
    theta = np.zeros((size, factors + 1))
    penalty = np.array([PENALTY[0], *[PENALTY[1]] * factors])
    theta[1:, 1:] = rng.normal(0, INITIAL, (size - 1, factors))
    first, second, step = np.zeros_like(theta), np.zeros_like(theta), 0
    own = [slots[r][slots[r] > 0] for r in rows]
    for _ in range(max(epochs, -(-STEPS * BATCH // len(own)))):
        order = rng.permutation(len(own))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            ids = np.concatenate([own[i] for i in batch])
            row = np.repeat(np.arange(len(batch)), [len(own[i]) for i in batch])
            v = theta[ids]
            scale = 1 / np.maximum(1, np.bincount(row, minlength=len(batch)))
            sums = np.stack([np.bincount(row, v[:, f], len(batch)) for f in range(factors + 1)], axis=1)
            squares = np.bincount(row, (v[:, 1:] ** 2).sum(1), len(batch))
            margin = bias + sums[:, 0] + ((sums[:, 1:] ** 2).sum(1) - squares) * scale / 2
            error = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y[batch]
            slope = np.ones_like(v)
            slope[:, 1:] = (sums[row, 1:] - v[:, 1:]) * scale[row, None]
            slope *= error[row, None]
            grad = np.stack([np.bincount(ids, slope[:, f], size) for f in range(factors + 1)], axis=1) / len(batch)
            grad += penalty * theta
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad**2
            theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            theta[0] = 0
            bias -= rate * float(error.mean())
    return Machine(bias, slots, theta[:, 0].copy(), theta[:, 1:].copy())


def fit_toxicity(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Machine:
    """Fit on at most ``bound`` labelled documents that are not held out."""
    ids = label_sample(labels, "toxic", MODULUS, REMAINDER, bound)
    sample = sampled_texts(docs, ids).select("doc_id", term_ids(F.col("text")).alias("terms")).toArrow()
    sample = sample.sort_by("doc_id").combine_chunks()
    if not len(sample):
        return fit_machine([], np.zeros(0))
    terms = sample.column("terms").chunk(0)
    offsets, flat = terms.offsets.to_numpy(), terms.values.to_numpy()
    rows = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return fit_machine(rows, np.array([ids[i] for i in sample.column("doc_id").to_pylist()], float))


def score_toxicity(docs: DataFrame, machine: Machine) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (score >= 0.3) to the documents.

    The whole text is scored: every distinct word counts once. Null and empty texts take the bias
    alone. Input columns named score or predicted are replaced. The model has at most 2^18 buckets.
    """
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted", "_terms")]
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = batch.column(batch.num_columns - 1)
            offsets = terms.offsets.to_numpy()
            ids = terms.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            scores = machine.scores(ids, offsets - offsets[0])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=[*kept, "score"])

    scored = docs.select(*kept, term_ids(F.col("text")).alias("_terms")).mapInArrow(score, schema)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; see score_toxicity for odd texts."""
    machine = fit_toxicity(docs, labels, bound)
    scored = score_toxicity(docs.select("doc_id", "text"), machine)
    return scored.select("doc_id", held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"), "score", "predicted")
