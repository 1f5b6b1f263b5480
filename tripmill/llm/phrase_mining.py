"""Operator 13: collocations by Toivonen's sampling method.

A sample of the documents proposes frequent phrases, level by level, at a lowered threshold. One pass
over all documents then counts the proposed phrases and their negative border: a phrase of k words
is counted wherever its first and its last k - 1 words are proposed, so what was not proposed, but
could be frequent, is counted too. A frequent phrase that was not proposed is a failure of the
border; failures are added to the proposals and an expansion pass counts what they let through, and
at once all longer phrases made of such, which closes the border: every part of a frequent phrase is
frequent, so the phrase is counted in the pass in which the last of its parts is.

These passes count by 64-bit keys of language and words, which can only count too much. A last pass
counts the words themselves, of whatever has a frequent key. Proposals and frequent keys are bit sets
of fixed size; phrases that share a bit only mean that more is counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import stored

LONGEST = 5
SUPPORT = 100
TOP = 2_000
#: One document in so many is sampled, by a hash of its id and text.
SAMPLE_ONE_IN = 8
#: Share of the support, scaled to the sample, that a phrase needs to be proposed.
LOWERED = 0.6
#: Bits of the proposals, a power of two; a fuller set lets more phrases be counted, never fewer.
FILTER_BITS = 1 << 26
#: Bytes of whole texts that are counted at a time, rows that one task ranks.
SLICE_BYTES, RANKED_ROWS = 2 << 20, 50_000
_UNKNOWN = "und"

#: Rows of counts that a task adds up at a time at least, and those it holds at most; tasks of the last pass for each core.
MERGED_ROWS, HELD_ROWS, TASKS = 1 << 18, 1 << 19, 2
#: Keys with their counts that a task of the other passes holds before it adds them up and gives them out.
HELD_KEYS = 1 << 22

_COUNTED = "lang string, phrase string, size int, n long"
_NAMES = [x.split(" ")[0] for x in _COUNTED.split(", ")]
#: Bits of one row of Spark's bitmap functions.
_ROW_BITS = 32_768

# bytes as the contract reads them: A-Z in lower case, piece ends as line feeds, tabs as spaces
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[65:91] += 32
_BYTES[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 10
_BYTES[9] = 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _holds(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    spot = (keys & np.uint64(len(bits) * 8 - 1)).view(np.int64)
    return (bits[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)


@dataclass
class _Words:
    """The words of a slice of texts, in order."""

    codes: np.ndarray  # place in ``vocabulary``
    vocabulary: pa.Array
    piece: np.ndarray  # number of the piece a word stands in; pieces do not cross texts
    text: np.ndarray  # number of the text
    langs: pa.Array | None = None
    lang: np.ndarray | None = None  # place in ``langs``
    ids: np.ndarray | None = None  # number of the (language, word)
    keys: np.ndarray | None = None  # hash of the (language, word)


def _words(texts: pa.Array) -> _Words:
    """Words and pieces of whole texts; everything is done on the bytes at once."""
    texts = texts.cast(pa.utf8())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    raw, offsets = _BYTES[raw], offsets - offsets[0]
    inside = (raw != 32) & (raw != 10)
    fresh = np.zeros(len(raw) + 1, bool)  # a text begins here
    fresh[offsets[:-1]] = True
    before = np.empty(len(raw), bool)
    before[:1], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | fresh[:-1]))
    pieces = np.cumsum((raw == 10) | fresh[:-1])
    kept = np.cumsum(inside)
    ends = np.append(kept[starts] - 1, kept[-1] if len(kept) else 0).astype(np.int32)
    flat = pa.Array.from_buffers(pa.utf8(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(raw[inside])])
    coded = flat.dictionary_encode()
    text = np.searchsorted(offsets, starts, side="right") - 1
    return _Words(coded.indices.to_numpy().astype(np.int64), coded.dictionary, pieces[starts], text)


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each value's first appearance, places of the first appearances)."""
    codes, _ = pd.factorize(ids)
    return codes, np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))


def _keys(texts: pa.Array, langs: pa.Array) -> _Words:
    """The words with their language: an exact number of each (language, word), and its key."""
    words, langs = _words(texts), langs.dictionary_encode()
    words.langs, words.lang = langs.dictionary, langs.indices.to_numpy().astype(np.int64)[words.text]
    words.ids, at = _distinct(words.lang * len(words.vocabulary) + words.codes)
    seeds = np.array([xxhash.xxh64_intdigest(x, seed=1) for x in words.langs.to_pylist()], np.uint64)
    own = np.array([xxhash.xxh64_intdigest(x) for x in words.vocabulary.to_pylist()], np.uint64)
    words.keys = _mixed((own[words.codes[at]] ^ seeds[words.lang[at]]) if len(at) else np.zeros(0, np.uint64))[words.ids]
    return words


def _count(words: _Words, new: np.ndarray, old: np.ndarray | None, sizes: range) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per size: the places and keys of the phrases to be counted.

    A phrase is counted where ``new`` holds its two longest parts and theirs, unless ``old`` did so.
    With ``old``, a part that is counted for the first time passes as held, so that all that follows
    from what is new to ``new`` is counted at once.
    """
    n, keys = len(words.codes), words.keys
    passed = [(bits, np.ones(n, bool)) for bits in (new, old) if bits is not None]
    for size in range(1, sizes.stop):
        if size > 1:
            # places whose phrase of one word less, and the one after it, are both counted and held
            grown, fresh = [], passed[0][1] & ~passed[-1][1]
            for bits, counted in passed:
                held = counted.copy()
                held[counted] = _holds(bits, keys[counted])
                if bits is new:
                    held |= fresh
                both = np.zeros(n, bool)
                if n >= size:
                    whole = words.piece[: n - size + 1] == words.piece[size - 1 :]
                    both[: n - size + 1] = held[: n - size + 1] & held[1 : n - size + 2] & whole
                grown.append((bits, both))
            passed = grown
            places, longer = np.flatnonzero(passed[0][1]), np.zeros(n, np.uint64)
            longer[places] = _mixed(keys[places] * np.uint64(0x9E3779B97F4A7C15) + words.keys[places + size - 1])
            keys = longer
        if size in sizes:
            places = np.flatnonzero(passed[0][1] if len(passed) == 1 else passed[0][1] & ~passed[1][1])
            yield size, places, keys[places]


def _slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of whole texts of about this many bytes."""
    lengths = pc.binary_length(batch.column(1)).to_numpy()
    run = (np.cumsum(lengths) - lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b)


def _summed_keys(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts): each key once."""
    keys, counts = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first, dtype=np.int64)


def _key_counts(texts: DataFrame, new: np.ndarray, old: np.ndarray | None, sizes: range, slice_bytes: int) -> DataFrame:
    """key, open, n of what ``new`` lets through and ``old`` did not; open: not held, and not of the greatest length.

    Two phrases with one key are counted together, so n is never too small. A task adds up its slices
    itself, so that the JVM does not keep a map of each task's keys before the shuffle as well as after it.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = {size: [] for size in sizes}, 0

        def given() -> Iterator[pa.RecordBatch]:
            for size, counted in held.items():
                if counted:
                    keys, n = _summed_keys(counted)
                    counted.clear()
                    for at in range(0, len(keys), 1 << 16):
                        part = keys[at : at + (1 << 16)]
                        fresh = ~_holds(new, part) if size < LONGEST else np.zeros(len(part), bool)
                        columns = [pa.array(part.view(np.int64)), pa.array(fresh), pa.array(n[at : at + (1 << 16)])]
                        yield pa.RecordBatch.from_arrays(columns, names=["key", "open", "n"])

        for batch in batches:
            for part in _slices(batch, slice_bytes):
                for size, _, keys in _count(_keys(part.column(1), part.column(0)), new, old, sizes):
                    if len(keys):
                        codes, at = _distinct(keys.view(np.int64))
                        held[size].append((keys[at], np.bincount(codes).astype(np.int32)))
                        rows += len(at)
                if rows > HELD_KEYS:
                    yield from given()
                    rows = 0
        yield from given()

    rows = texts.mapInArrow(read, "key long, open boolean, n long").repartition("key")
    return rows.groupBy("key").agg(F.bool_or("open").alias("open"), F.sum("n").alias("n"))


def _slice_counts(part: pa.RecordBatch, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """lang, phrase, size, n of a slice of texts."""
    words = _keys(part.column(1), part.column(0))
    whole = np.bincount(words.lang, minlength=len(words.langs))
    none = [pa.array([""] * len(whole)), pa.array(np.zeros(len(whole), np.int32)), pa.array(whole)]
    # all words of each language, as the count of the phrase without words
    yield pa.RecordBatch.from_arrays([words.langs, *none], names=_NAMES)
    for size, places, keys in _count(words, frequent, None, range(1, LONGEST + 1)):
        places = places[_holds(frequent, keys)]
        ids, at = _distinct(words.ids[places])
        for i in range(1, size):
            ids, at = _distinct(ids * (len(words.codes) + 1) + words.ids[places + i])
        at = places[at]
        parts = [words.vocabulary.take(pa.array(words.codes[at + i])) for i in range(size)]
        columns = [words.langs.take(pa.array(words.lang[at])), pc.binary_join_element_wise(*parts, " ")]
        columns += [pa.array(np.full(len(at), size, np.int32)), pa.array(np.bincount(ids, minlength=len(at)))]
        yield pa.RecordBatch.from_arrays(columns, names=_NAMES)


def _summed(counted: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """One row for each phrase."""
    sums = pa.Table.from_batches(counted).group_by(_NAMES[:3], use_threads=False).aggregate([("n", "sum")])
    return sums.select([*_NAMES[:3], "n_sum"]).rename_columns(_NAMES).to_batches(max_chunksize=1 << 16)


def _task_counts(
    slices: Iterator[pa.RecordBatch], frequent: np.ndarray, merged_rows: int, held_rows: int
) -> Iterator[pa.RecordBatch]:
    """The counts of all slices of a task, added up; what is held is given out when it passes ``held_rows``."""
    held, rows, most = [], 0, merged_rows
    for part in slices:
        for counted in _slice_counts(part, frequent):
            held.append(counted)
            rows += counted.num_rows
        if rows > most:
            held = _summed(held)
            rows = sum(x.num_rows for x in held)
            if rows > held_rows:
                yield from held
                held, rows = [], 0
            # a row is added up again only with as many new ones
            most = max(merged_rows, 2 * rows)
    if held:
        yield from _summed(held)


def _phrase_counts(texts: DataFrame, frequent: np.ndarray, slice_bytes: int) -> DataFrame:
    """lang, phrase, size, n of what ``frequent`` holds with all its parts, by the words themselves.

    A task gives a phrase once, and there are as many tasks as cores to run them, times TASKS: so rows
    grow with the phrases that are frequent, not with these times the slices.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (part for batch in batches for part in _slices(batch, slice_bytes))
        yield from _task_counts(slices, frequent, MERGED_ROWS, HELD_ROWS)

    tasks = TASKS * texts.sparkSession.sparkContext.defaultParallelism
    return texts.coalesce(tasks).mapInArrow(read, _COUNTED).groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))


def _bits(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit set of the keys, made by Spark's bitmap functions: at most bits / 32,768 rows of 4 kB."""
    spots = keys.select((F.pmod("key", F.lit(bits)) + 1).alias("s"))
    rows = spots.groupBy(F.bitmap_bucket_number("s").alias("row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in rows.collect():
        out[(r.row - 1) * _ROW_BITS // 8 : r.row * _ROW_BITS // 8] = np.frombuffer(r.bits, np.uint8)[: bits // 8]
    return out


def propose(texts: DataFrame, support: int, one_in: int, lowered: float, bits: int, slice_bytes: int) -> np.ndarray:
    """Bit set of the phrases of up to LONGEST - 1 words that are frequent in the sample."""
    sample = stored(texts.filter(F.pmod("draw", F.lit(one_in)) == 0).select("lang", "text"), "phrase-sample", "zstd")
    least = max(1, int(lowered * support / one_in))
    held = np.zeros(bits // 8, np.uint8)
    for size in range(1, LONGEST):
        counted = _key_counts(sample, held, None, range(size, size + 1), slice_bytes)
        level = _bits(counted.filter(F.col("n") >= least), bits)
        if not level.any():
            break
        held = held | level
    return held


def phrase_counts(
    docs: DataFrame,
    support: int = SUPPORT,
    one_in: int = SAMPLE_ONE_IN,
    lowered: float = LOWERED,
    bits: int = FILTER_BITS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """lang, phrase, size, n of every phrase of 1 to 5 words that occurs ``support`` times or more.

    The phrase '' of size 0 stands for all words of its language. The result does not depend on the sample, nor
    on the size of the bit set: both decide only what else is counted, and how many passes it takes.
    """
    texts = docs.select(
        F.coalesce("lang", F.lit(_UNKNOWN)).alias("lang"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("doc_id", "text").alias("draw"),
    )
    held = propose(texts, support, one_in, lowered, bits, slice_bytes)
    texts = texts.select("lang", "text")
    counted = _key_counts(texts, held, None, range(1, LONGEST + 1), slice_bytes)
    found = stored(counted.filter(F.col("n") >= support), "phrase-keys")
    frequent, failures = _bits(found, bits), _bits(found.filter("open"), bits)
    if failures.any():
        counted = _key_counts(texts, held | failures, held, range(2, LONGEST + 1), slice_bytes)
        frequent = frequent | _bits(counted.filter(F.col("n") >= support), bits)
    counted = _phrase_counts(texts, frequent, slice_bytes)
    return counted.filter((F.col("n") >= support) | (F.col("size") == 0))


def _joined(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _cuts(candidates: DataFrame, frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Each candidate with its lowest-scoring cut."""
    words = F.split("phrase", " ")
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang",
        "phrase",
        "size",
        F.col("n").alias("a"),
        "k",
        _joined(words, F.lit(1), F.col("k")).alias("head"),
        _joined(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"),
    )
    heads = frequent.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = frequent.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    met = cut.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")

    def wide(c: str) -> Column:
        return F.col(c).cast("decimal(19,0)")

    # Spark's integral division of decimals is exact; a product beyond 38 digits raises
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n"), wide("l") * wide("r"))
    best = F.min(F.struct(score.alias("score"), "k", "l", "r", "n")).alias("b")
    cheapest = met.groupBy("lang", "phrase", "size", "a").agg(best)
    return cheapest.select("lang", "phrase", "size", "a", "b.l", "b.r", "b.n", "b.score")


def _parts(candidates: DataFrame) -> DataFrame:
    """lang, phrase, inside: the phrases within candidates, with the largest count of a candidate around."""
    words = F.split("phrase", " ")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: _joined(words, i, m)),
        )
    )
    longer = candidates.filter("size > 2").select("lang", "n", F.explode(spans).alias("phrase"))
    return longer.groupBy("lang", "phrase").agg(F.max("n").alias("inside"))


def _ranked(scored: DataFrame, top: int, rows: int) -> DataFrame:
    """Each language's first ``top`` rows with their rank: groups of RANKED_ROWS first, then their winners."""
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    groups = rows // RANKED_ROWS
    while groups > 1:
        dealt = scored.withColumn("_group", F.pmod(F.xxhash64("phrase"), F.lit(groups)))
        place = F.row_number().over(Window.partitionBy("lang", "_group").orderBy(*order))
        scored = dealt.withColumn("_place", place).filter(F.col("_place") <= top).drop("_group", "_place")
        groups = groups * top // RANKED_ROWS
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return scored.withColumn("rank", place.cast("long")).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, **sampling) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` collocations.

    Text is lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and those into words
    at spaces and tabs; counts are of all occurrences in all texts, per language (null: ``und``). A
    candidate is a phrase of 2 to 5 words with ``a`` >= ``support`` occurrences. Cut after k words
    into parts with l and r occurrences it scores floor(1000 a n / (l r)), n being the language's
    words; the lowest cut counts, the first on a tie. Candidates that stand within a longer one of
    equal count are dropped. Ties in rank: larger a, then the phrase in byte order.

    Null and empty texts have no words; repeated rows count each; no rows give no rows. Extra
    columns are not read. Arithmetic is in whole numbers of up to 38 digits. A very long text is
    counted whole, by the task that reads it.
    """
    counts = stored(phrase_counts(docs, support, **sampling), "phrase-counts")
    totals, frequent = counts.filter("size = 0").select("lang", "n"), counts.filter("size > 0")
    candidates = frequent.filter("size > 1")
    scored = _cuts(candidates, frequent, totals).join(_parts(candidates), ["lang", "phrase"], "left")
    kept = stored(scored.filter(F.coalesce("inside", F.lit(0)) < F.col("a")), "phrase-scored")
    ranked = _ranked(kept.select("lang", "phrase", "a", "l", "r", "n", "score"), top, kept.count())
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
