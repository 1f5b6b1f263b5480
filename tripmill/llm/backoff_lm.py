"""Operator 9: corpus language model as a weighted backoff automaton.

The model has two orders. States are the empty history, the start of a text and every training
word. Word w leaves state h by an arc of weight log10 p(w | h) if the pair (h, w) occurs in
training; else the failure arc of weight log10(mu / (c(h) + mu)) leads to the empty state, whose
arcs hold log10 p(w). Pair probabilities are Dirichlet-smoothed:
p(w | h) = (c(hw) + mu p(w)) / (c(h) + mu), with p(w) = (c(w) + 1) / (N + V + 1).

The model grows with the corpus, so no task and not the driver holds it. Texts are coded in
blocks; a block asks the parts of the model, dealt by key range, for the counts of the distinct
n-grams it holds, and the same lists carry its own training counts there. Parts answer with
totals, and each block then runs the automaton over its texts from left to right.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tripmill.llm.common import SPACE, held_out, lower_ascii, split_words, stored

MODULUS, REMAINDER = 7, 2
#: Strength of the smoothing, in pseudo counts.
MU = 100.0
#: Tokens that one block holds; a longer text is a block of its own.
BLOCK_TOKENS = 1_000_000
#: Bytes of text for each part of the model.
PART_BYTES = 8 << 20
#: Scores are sums of whole billionths, so they do not depend on the order of addition.
UNIT = 1e9
END, START = np.uint64(0), np.uint64(1)

_TEXTS = "block long, doc_ids array<long>, held array<boolean>, lengths array<long>, vocabulary binary, tokens binary"
_ASKED = "block long, part int, words binary, word_counts binary, pairs binary, pair_counts binary"
_ANSWERS = "block long, part int, word_counts binary, pair_counts binary, train_tokens long, known_words long"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _pack(values: np.ndarray) -> bytes:
    """Byte planes, compressed: sorted keys are packed as differences."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1) if len(values) else b""


def _unpack(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit keys of word pairs."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _histories(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The state each token is read in: the word before it, or the start of the text."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.cumsum(lengths) - lengths] = START
    return before


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    bounds = [np.uint64((p << 64) // parts) for p in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(bounds, np.uint64)), [len(keys)]]).astype(int)


def _texts(block: int, rows: list[tuple]) -> Iterator[list]:
    """The block's texts as numbers in its own vocabulary."""
    ids, held, tokens = zip(*rows, strict=True)
    vocabulary, coded = np.unique(np.concatenate(tokens), return_inverse=True)
    lengths = [len(t) for t in tokens]
    yield [block, list(ids), list(held), lengths, _pack_keys(vocabulary), _pack(coded.astype(np.uint32))]


def _asked(block: dict, parts: int) -> Iterator[list]:
    """For each part of the model the block's distinct n-grams, with their training counts."""
    lengths = np.array(block["lengths"], np.int64)
    words = _unpack_keys(block["vocabulary"])[_unpack(block["tokens"], np.uint32)]
    train = np.repeat(~np.array(block["held"], bool), lengths)
    pairs = pair_keys(_histories(words, lengths), words)
    packed = []
    for keys in (words, pairs):
        distinct, which = np.unique(keys, return_inverse=True)
        counts = np.bincount(which[train], minlength=len(distinct))
        cuts = _cuts(distinct, parts)
        packed.append([(_pack_keys(distinct[a:b]), _pack(counts[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    for part, (own_words, own_pairs) in enumerate(zip(*packed, strict=True)):
        if own_words[0] or own_pairs[0]:
            yield [block["block"], part, *own_words, *own_pairs]


def _row(values: list, fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, fields, strict=True)], schema=fields)


def _blocks(docs: DataFrame) -> DataFrame:
    """Code the documents block by block; a block is a run of rows of one scan task."""
    tokens = F.transform(split_words(lower_ascii(F.col("text")), SPACE), lambda w: F.xxhash64(w))
    rows = docs.select("doc_id", held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held"), tokens.alias("tokens"))
    fields = to_arrow_schema(StructType.fromDDL(_TEXTS))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, waiting, size = 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for row in _texts((TaskContext.get().partitionId() << 32) + made, waiting):
                yield _row(row, fields)

        for batch in batches:
            ids, held = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            for i, (doc_id, out) in enumerate(zip(ids, held, strict=True)):
                text = np.append(flat[offsets[i] : offsets[i + 1]], END)
                waiting.append((doc_id, out, text))
                size += len(text)
                if size >= BLOCK_TOKENS:
                    yield from flush()
                    made, waiting, size = made + 1, [], 0
        if waiting:
            yield from flush()

    return rows.mapInArrow(encode, _TEXTS)


def _ask(texts: DataFrame, parts: int) -> DataFrame:
    fields = to_arrow_schema(StructType.fromDDL(_ASKED))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for row in _asked(batch.slice(i, 1).to_pylist()[0], parts):
                    yield _row(row, fields)

    return texts.drop("doc_ids").mapInArrow(ask, _ASKED)


def _answer(key: tuple, asked: pd.DataFrame) -> pd.DataFrame:
    """One part of the model: add up the counts of all blocks and answer each."""
    answers = {"block": list(asked["block"]), "part": [int(key[0])] * len(asked)}
    totals = {}
    for kind in ("word", "pair"):
        lists = [_unpack_keys(x) for x in asked[f"{kind}s"]]
        counts = [_unpack(x, np.int64) for x in asked[f"{kind}_counts"]]
        keys, which = np.unique(np.concatenate(lists), return_inverse=True)
        total = np.bincount(which, np.concatenate(counts), len(keys)).astype(np.int64)
        ends = np.cumsum([len(x) for x in lists])[:-1]
        answers[f"{kind}_counts"] = [_pack(x) for x in np.split(total[which], ends)]
        totals[kind] = total
    out = pd.DataFrame(answers)
    out["train_tokens"], out["known_words"] = 0, 0
    # what the part adds to N and V, once
    out.loc[out.index[0], "train_tokens"] = int(totals["word"].sum())
    out.loc[out.index[0], "known_words"] = int((totals["word"] > 0).sum())
    return out[["block", "part", "word_counts", "pair_counts", "train_tokens", "known_words"]]


def _score_block(texts: pd.Series, answers: pd.DataFrame, model: tuple[int, int, int], mu: float) -> pd.DataFrame:
    """Run the automaton over the block's texts."""
    all_tokens, all_words, all_texts = model
    vocabulary, lengths = _unpack_keys(texts["vocabulary"]), np.array(texts["lengths"], np.int64)
    coded = _unpack(texts["tokens"], np.uint32)
    words = vocabulary[coded]
    pairs, which = np.unique(pair_keys(_histories(words, lengths), words), return_inverse=True)
    answers = answers.sort_values("part")
    word_counts = np.concatenate([_unpack(x, np.int64) for x in answers["word_counts"]])
    pair_counts = np.concatenate([_unpack(x, np.int64) for x in answers["pair_counts"]])
    assert len(word_counts) == len(vocabulary) and len(pair_counts) == len(pairs)

    starts = np.cumsum(lengths) - lengths
    seen = word_counts[coded]
    state = np.empty_like(seen)  # how often training was in the state the token is read in
    state[1:] = seen[:-1]
    state[starts] = all_texts
    arcs = pair_counts[which]

    plain = np.log10((seen + 1) / (all_tokens + all_words + 1))
    arc = np.log10((arcs + mu * ((seen + 1) / (all_tokens + all_words + 1))) / (state + mu))
    failure = np.log10(mu / (state + mu))
    weight = np.where(arcs > 0, arc, failure + plain)

    def total(x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.rint(x * UNIT).astype(np.int64), starts) / UNIT

    return pd.DataFrame(
        {
            "doc_id": pd.array(list(texts["doc_ids"]), dtype="Int64"),
            "held_out": list(texts["held"]),
            "n_tokens": lengths,
            "n_known": np.add.reduceat((seen > 0).astype(np.int64), starts),
            "base_score": total(plain),
            "score": total(weight),
        }
    )


def lm_scores(docs: DataFrame, mu: float = MU, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Tokens are runs without ASCII white space, A-Z in lower case, and one end. Null and empty texts
    are the end alone. Rows that repeat are trained on and scored each; a null id is not held out.
    Without training rows all counts are zero. Log-probabilities are rounded to billionths before
    they are added. Words and pairs are known by 64-bit hashes. No rows give no rows. Extra columns
    are not read.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    # coded once and stored: a second scan could be cut into other tasks, and so into other blocks
    texts = stored(_blocks(docs), "lm-texts")
    answers = stored(_ask(texts, parts).groupBy("part").applyInPandas(_answer, _ANSWERS), "lm-answers")
    tokens, words = answers.agg(F.sum("train_tokens"), F.sum("known_words")).first()
    train_docs = docs.filter(~held_out(F.col("doc_id"), MODULUS, REMAINDER)).count()
    model = (tokens or 0, words or 0, train_docs)

    def score(own: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        return _score_block(own.iloc[0], replies, model, mu)

    replies = answers.select("block", "part", "word_counts", "pair_counts")
    scored = texts.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(score, _SCORES)
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model[0]).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
