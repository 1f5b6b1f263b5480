"""Operator 11: language by string kernels, Nyström landmarks and kernel ridge regression.

The kernel of two texts is the blended spectrum of their letters: the number of n-grams of one to
three characters that both texts hold, divided by the root of the product of each text's own number.
N-grams lie within words, whose ends count as a character. The landmarks are texts of the sample;
the kernel with them, whitened by the root of their own kernel matrix, gives every text's features,
and ridge regression, one language against the rest, gives weights on these. Since the kernel with a
landmark is linear in a text's n-grams, landmarks and weights multiply into one matrix, and a batch
of texts is scored by one product of its presence matrix.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import held_out

#: Hash buckets of n-grams.
BUCKETS = 1 << 15
#: Texts that a fit reads for each language, and of all languages (the most frequent ones, if there
#: are too many for one text of each).
PER_LANGUAGE, SAMPLE = 1_000, 16_384
LANDMARKS = 256
#: Ridge penalty for each sampled text; eigenvalues below this share of the largest are left out.
PENALTY, LEAST_EIGENVALUE = 1e-3, 1e-6
#: Factor of the regression values in the score's exponent.
SHARPNESS = 6.0
MODULUS, REMAINDER = 4, 2
UNDETERMINED = "und"
#: Texts of one presence matrix, characters that are coded at a time.
BATCH_TEXTS, PART_CHARS = 128, 1 << 20
_SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case code point of every letter and mark, 32 for all else; bit 24 tells letters from marks."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        kind = unicodedata.category(char)[0]
        if kind in "LM":
            low = char.lower()
            table[point] = (ord(low) if len(low) == 1 else point) | ((kind == "L") << 24)
    return table


def _hashed(x: np.ndarray) -> np.ndarray:
    return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64)


def _mark(presence: np.ndarray, rows: list[int], parts: list[str]) -> list[bool]:
    """Set the buckets of each part's n-grams in its row; whether each part has a letter."""
    table, lengths = _letters(), [len(p) for p in parts]
    points = np.frombuffer((" " + " ".join(parts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    points = table[points]
    starts = np.cumsum([1, *[n + 1 for n in lengths]])[:-1]
    lettered = np.add.reduceat(points >> 24, starts) > 0 if parts else []
    points = (points & 0xFFFFFF).astype(np.uint64)
    at = np.flatnonzero(points != _SPACE)
    base = np.array(rows, np.int64)[np.searchsorted(starts, at, side="right") - 1] * BUCKETS
    before, here, after = points[at - 1], points[at], points[at + 1]
    two = before * np.uint64(1 << 21) + here + np.uint64(1 << 42)
    cells = presence.reshape(-1)
    cells[base + _hashed(here)] = 1
    cells[base + _hashed(two)] = 1
    last = after == _SPACE
    cells[base[last] + _hashed(here[last] * np.uint64(1 << 21) + np.uint64(_SPACE) + np.uint64(1 << 42))] = 1
    cells[base + _hashed((two * np.uint64(0xD1B54A32D192ED03)) ^ after)] = 1
    return list(lettered)


def presences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(0/1 matrix of texts and n-gram buckets, whether each text has a letter).

    Long texts are coded part by part, cut at spaces, or anywhere within a word beyond any length.
    """
    presence, lettered = np.zeros((len(texts), BUCKETS), np.float32), np.zeros(len(texts), bool)
    rows, parts, size = [], [], 0

    def flush() -> None:
        for row, has in zip(rows, _mark(presence, rows, parts), strict=True):
            lettered[row] |= has

    for row, text in enumerate(texts):
        at = 0
        while text and at < len(text):
            end = min(at + PART_CHARS, len(text))
            if end < len(text):
                end = text.rfind(" ", at, end) + 1 or end
            rows.append(row), parts.append(text[at:end])
            size += end - at
            at = end
            if size >= PART_CHARS:
                flush()
                rows, parts, size = [], [], 0
    if rows:
        flush()
    return presence, lettered


@dataclass
class Model:
    languages: list[str]
    matrix: np.ndarray  # landmarks times weights: buckets x languages

    def values(self, presence: np.ndarray) -> np.ndarray:
        """Regression values, text x language."""
        own = np.sqrt(np.maximum(1, presence.sum(axis=1, keepdims=True)))
        return (presence @ self.matrix) / own


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Normalised blended-spectrum kernel of presence rows."""
    own = [np.sqrt(np.maximum(1, x.sum(axis=1))) for x in (a, b)]
    return (a @ b.T) / own[0][:, None] / own[1][None, :]


def _unpacked(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits, axis=1).astype(np.float32)


def fit_kernel(bits: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, penalty: float = PENALTY) -> Model:
    """Fit on packed presence rows. Landmarks are dealt to the languages in turn, in the order of the rows."""
    languages = sorted(set(langs))
    which = np.array([languages.index(x) for x in langs], np.int64)
    turn = np.empty(len(langs), np.int64)  # how many texts of its language come before each
    for i in range(len(languages)):
        turn[which == i] = np.arange((which == i).sum())
    marks = _unpacked(bits[np.lexsort((which, turn))[:landmarks]])
    values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    kept = values > LEAST_EIGENVALUE * values.max(initial=0)
    root = vectors[:, kept] / np.sqrt(values[kept])
    features = np.concatenate([kernel(_unpacked(bits[i : i + 256]), marks) for i in range(0, len(bits), 256)]) @ root
    target = (which[:, None] == np.arange(len(languages))) - 1 / len(languages)
    # texts of a rare language weigh as much together as those of a frequent one
    weight = (1 / np.bincount(which))[which] * len(which) / len(languages)
    gram = (features * weight[:, None]).T @ features + penalty * len(features) * np.eye(features.shape[1])
    dual = root @ np.linalg.solve(gram, (features * weight[:, None]).T @ target)
    scaled = marks / np.sqrt(np.maximum(1, marks.sum(axis=1, keepdims=True)))
    return Model(languages, (scaled.T @ dual).astype(np.float32))


def _batches(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for at in range(0, len(texts), BATCH_TEXTS):
        part = texts.slice(at, BATCH_TEXTS)
        yield at, len(part), *presences(part.to_pylist())


def fit_languages(docs: DataFrame) -> Model | None:
    """Fit on at most PER_LANGUAGE texts of each language, and SAMPLE in all, that are not held out.

    Texts are taken in the order of a hash of id and text. What reaches the driver is 4 kB for each,
    whatever its length. Without a labelled text there is no model.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~_held(F.col("doc_id")))
    known = known.select("lang", "text", F.xxhash64("doc_id", "text").alias("draw"))
    common = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(SAMPLE)
    languages = [r.lang for r in common.collect()]
    if not languages:
        return None
    each = max(1, min(PER_LANGUAGE, SAMPLE // len(languages)))
    # the longest run of equal draws is of equal rows, which are alike to the fit
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    drawn = known.select("lang", "draw").withColumn("place", place).filter(F.col("place") <= each)
    # at most SAMPLE pairs of numbers, so that only the sampled texts are shuffled
    drawn = F.broadcast(drawn.select(F.xxhash64("lang").alias("of"), "draw").distinct())
    picked = known.withColumn("of", F.xxhash64("lang")).join(drawn, ["of", "draw"], "left_semi")
    picked = picked.groupBy("lang", "draw").agg(F.max("text").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, presence, lettered in _batches(batch.column(2)):
                bits = [row.tobytes() for row in np.packbits(presence.astype(bool), axis=1)]
                columns = [batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(bits, pa.binary()), pa.array(lettered)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "draw", "bits", "lettered"])

    rows = picked.mapInArrow(read, "lang string, draw long, bits binary, lettered boolean").filter("lettered").toArrow()
    rows = rows.sort_by([("draw", "ascending"), ("lang", "ascending")])
    if not rows.num_rows:
        return None
    bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint8).reshape(-1, BUCKETS // 8)
    return fit_kernel(bits, rows.column("lang").to_pylist())


def _held(doc_id: Column) -> Column:
    return held_out(doc_id, MODULUS, REMAINDER)


def score_languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; see ``languages``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, presence, lettered in _batches(batch.column(2)):
                best, sure = [UNDETERMINED] * n, np.zeros(n)
                if model is not None:
                    values = model.values(presence).astype(np.float64)
                    likely = np.exp(SHARPNESS * (values - values.max(axis=1, keepdims=True)))
                    sure = np.where(lettered, likely.max(axis=1) / likely.sum(axis=1), 0.0)
                    best = [model.languages[i] if has else UNDETERMINED for i, has in zip(values.argmax(axis=1), lettered, strict=True)]
                columns = [batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(best, pa.string()), pa.array(sure)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", _held(F.col("doc_id")).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from rows that are not held out.

    ``score`` is the predicted language's share of the regression values, taken as exponents. Texts
    that are null or without a letter, and all texts where nothing can be learned, are ``und`` with
    score 0. Whole texts are read, however long. Equal texts score alike; between languages of
    equal value the first in order is taken. Repeated rows are scored each; a null id is not held
    out. No rows give no rows. Extra columns are not read.
    """
    return score_languages(docs, fit_languages(docs))
