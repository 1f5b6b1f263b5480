"""Operator 8: benchmark items in documents, by CGK embedding, bit-sampling LSH and exact edit distance.

Words are the symbols. A CGK walk reads the word it stands on and then stays or steps on, as a random
function of step and word says. Two texts a few edits apart fall into step again after an edit, so
their walks agree at many steps: edit distance becomes Hamming distance. A repetition has its own
random function and a few sampled steps; the words read there are hashed to a key. An item is keyed
from each of its words whose walk stays inside it, documents from every word; places that share a key
are candidates, and exact edit distance decides. The walks of a size class read item-sized windows,
and their number follows from the share of edited items that they find, measured for each kind of edit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import free_name, split_words, stored
from tripmill.llm.shingles import grams, mix, word_lists

#: Edits allowed, in hundredths of an item's words.
EDITS = 15
#: Size classes that allow edits: fewest words, and steps sampled for a key.
CLASSES = ((7, 3), (10, 4), (14, 5), (24, 6))
#: Share of items, edited to the limit, that the repetitions of their class find in the measurement.
TARGET_RECALL = 0.998
#: Edited items measured for each size and kind of edit, and the most repetitions of a class.
MEASURED, MOST_REPETITIONS = 500, 40
#: Bits of the filter that documents are read through; a fuller filter lets more pass, never less.
FILTER_BITS = 1 << 26
#: Words that are walked at a time, and cells of a table of edit distances.
WALKED, CELLS = 1 << 15, 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WINDOW = "start long, spots array<long>, seeds array<long>, window array<long>"
_FOUND = "at long, item_id long, start long, edits int"


def allowed_edits(words: int) -> int:
    return EDITS * words // 100


def size_class(words: int) -> int:
    """Number of the size class, -1 for items that allow no edit."""
    return sum(words >= low for low, _ in CLASSES) - 1


def walk_of(number: int, repetition: int) -> tuple[np.uint64, list[int]]:
    """Salt of the random function and the sampled steps, the first of them 0."""
    low, sampled = CLASSES[number]
    rng = np.random.default_rng([number, repetition])
    later = 1 + rng.choice(low, sampled - 1, replace=False)
    return np.uint64(rng.integers(1, 2**62)), [0, *sorted(later.tolist())]


def walk_keys(words: np.ndarray, salt: np.uint64, steps: list[int]) -> np.ndarray:
    """Key of the walk from each word; a 0 parts texts, and a walk stays there.

    Walks are followed from the last step back, for all words at once: where a walk stands decides
    only whether it goes on like its own or like the next word's.
    """
    turns = np.where(words == 0, np.uint64(0), mix(words + salt)).view(np.int64)
    keys, goes, other = np.full(len(words) + 1, salt), np.empty_like(turns), np.empty_like(words)
    own, following = keys[:-1], keys[1:]
    for step in range(steps[-1], -1, -1):
        if step < steps[-1]:
            # all bits of goes are the step's bit of turns; these take the following key
            np.right_shift(np.left_shift(turns, 63 - step, out=goes), 63, out=goes)
            np.bitwise_and(np.bitwise_xor(own, following, out=other), goes.view(np.uint64), out=other)
            np.bitwise_xor(own, other, out=own)
        if step in steps:
            read = (own ^ words) * _STEP
            np.bitwise_xor(read, read >> np.uint64(32), out=own)
    return own


def walk_ends(words: np.ndarray, salt: np.uint64, steps: list[int]) -> np.ndarray:
    """Where the walk from each word stands at the last sampled step."""
    turns = np.where(words == 0, np.uint64(0), mix(words + salt))
    ends = np.arange(len(words) + 1)
    for step in range(steps[-1] - 1, -1, -1):
        ends[:-1] = np.where((turns & np.uint64(1 << step)) != 0, ends[1:], ends[:-1])
    return ends[:-1]


def item_keys(words: np.ndarray, number: int, repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places) of all walks that stay within one of the texts, which zeros end."""
    keys, places = [], []
    for r in range(repeats):
        salt, steps = walk_of(number, r)
        inside = np.flatnonzero(words[walk_ends(words, salt, steps)] != 0)
        keys.append(walk_keys(words, salt, steps)[inside])
        places.append(inside)
    return np.concatenate(keys), np.concatenate(places)


def _edited(words: int, kind: str, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """An item of random words and a copy with all allowed edits of one kind, strange words around it."""
    item = rng.integers(1, 2**63, words, dtype=np.uint64)
    edits, fresh = allowed_edits(words), iter(rng.integers(1, 2**63, words, dtype=np.uint64))
    if kind == "insert":
        copy = np.insert(item, rng.integers(1, words, edits), [next(fresh) for _ in range(edits)])
    else:
        at, copy = rng.choice(words, edits, replace=False), item.copy()
        copy[at] = [next(fresh) for _ in range(edits)]
        copy = np.delete(copy, at) if kind == "delete" else copy
    strange = rng.integers(1, 2**63, 8, dtype=np.uint64)
    return item, np.concatenate([strange[:4], copy, strange[4:]])


def _in_row(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts, a zero after each, and the number of the text that each word is of."""
    words = np.concatenate([np.append(t, np.uint64(0)) for t in texts])
    return words, np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])


def _measured_sizes(number: int) -> list[int]:
    low = CLASSES[number][0]
    last = CLASSES[number + 1][0] - 1 if number + 1 < len(CLASSES) else 200
    return sorted({low, last, *(n for n in (20, 27, 34, 60, 100) if low <= n <= last)})


@lru_cache
def repetitions(number: int, recall: float = TARGET_RECALL) -> int:
    """Fewest repetitions that find the share of edited items, for every kind of edit and measured size."""
    rng, sets = np.random.default_rng(8), []
    for size in _measured_sizes(number):
        for kind in ("replace", "insert", "delete"):
            pairs = [_edited(size, kind, rng) for _ in range(MEASURED)]
            sets.append((*_in_row([i for i, _ in pairs]), *_in_row([c for _, c in pairs]), np.zeros(MEASURED, bool)))
    for r in range(MOST_REPETITIONS):
        salt, steps = walk_of(number, r)
        for items, of_item, copies, of_copy, found in sets:
            if found.all():
                continue
            inside = np.flatnonzero(items[walk_ends(items, salt, steps)] != 0)
            own = walk_keys(items, salt, steps)[inside] ^ mix(of_item[inside].astype(np.uint64))
            met = np.isin(own, walk_keys(copies, salt, steps) ^ mix(of_copy.astype(np.uint64)))
            found[of_item[inside][met]] = True
        if min(found.mean() for *_, found in sets) >= recall:
            return r + 1
    raise ValueError(f"no {MOST_REPETITIONS} repetitions of class {number} reach a recall of {recall}")


def best_places(items: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edits, start) of the run of words in each window nearest to its item, the first on a tie.

    Items (rows) have one length; windows are filled up with zeros, which are no word.
    """
    # a cost is edits times the width plus the start, so that the least cost has the first start
    width = windows.shape[1] + 1
    steps = np.arange(width) * width
    row = np.tile(np.arange(width), (len(items), 1))
    for word in items.T:
        change = row + width
        change[:, 1:] = np.minimum(change[:, 1:], row[:, :-1] + width * (windows != word[:, None]))
        # insertions: the smallest change to the left plus the distance
        row = np.minimum.accumulate(change - steps, axis=1) + steps
    return np.divmod(row.min(axis=1), width)


def _words(df: DataFrame, *keys: str) -> DataFrame:
    hashed = F.transform(split_words(F.lower(F.coalesce("text", F.lit("")))), lambda w: F.xxhash64(w))
    return df.select(*keys, hashed.alias("words"))


def _no_zeros(words: np.ndarray) -> np.ndarray:
    return np.where(words == 0, np.uint64(1), words)


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, words, number (size class), wide (words if no edit is allowed), seeds (keys) and places of items with words."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, offsets = word_lists(batch.column(1))
            rows = {k: [] for k in ("item_id", "words", "number", "wide", "seeds", "places")}
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                if a == b:
                    continue
                own, number = _no_zeros(words[a:b]), size_class(int(b - a))
                if number < 0:
                    seeds, places = grams(own, len(own)), np.zeros(1, np.int64)
                else:
                    seeds, places = item_keys(np.append(own, np.uint64(0)), number, repeats[number])
                rows["item_id"].append(batch.column(0)[i].as_py())
                rows["words"].append(own.view(np.int64))
                rows["number"].append(number)
                rows["wide"].append(int(b - a) if number < 0 else None)
                rows["seeds"].append(seeds.view(np.int64))
                rows["places"].append(places)
            longs = pa.list_(pa.int64())
            kinds = [pa.int64(), longs, pa.int32(), pa.int32(), longs, longs]
            columns = [pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=list(rows))

    repeats = [repetitions(n) for n in range(len(CLASSES))]
    items = _words(benchmark.filter("item_id is not null"), "item_id")
    schema = "item_id long, words array<long>, number int, wide int, seeds array<long>, places array<long>"
    return items.mapInArrow(code, schema).withColumn("item", F.monotonically_increasing_id())


def _filter(items: DataFrame) -> np.ndarray:
    """Bit set of two places for each key, as 64-bit numbers; never more than FILTER_BITS bits reach the driver."""
    spot = F.explode(F.array(F.col("v").bitwiseAND(FILTER_BITS - 1), F.shiftright("v", 32).bitwiseAND(FILTER_BITS - 1)))
    spots = items.select(F.explode("seeds").alias("v")).select(spot.alias("spot"))
    bit = F.expr("shiftleft(1L, cast(spot & 63 as int))")
    filled = spots.groupBy(F.shiftright("spot", 6).alias("n")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS >> 6, np.int64)
    bits[filled.column(0).to_numpy()] = filled.column(1).to_numpy()
    return bits.view(np.uint64)


def _holds(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values may be keys, as positions."""
    at = np.arange(len(values))
    for shift in (0, 32):
        spot = (values[at] >> np.uint64(shift)) & np.uint64(FILTER_BITS - 1)
        at = at[(bits[spot >> np.uint64(6)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)]
    return at


def _hits(words: np.ndarray, ends: np.ndarray, seeds: np.ndarray, wides: list[int], walks: list) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) in texts set apart by zeros at ``ends`` whose keys may be an item's."""
    places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]

    def keep(at: np.ndarray, keys: np.ndarray, first: int) -> None:
        places.append(at + first), found.append(keys[at])

    for wide in wides:
        every = grams(words, wide)
        at = _holds(seeds, every)
        keep(at[at + wide <= ends[np.searchsorted(ends, at)]], every, 0)
    longest = max((steps[-1] for _, steps in walks), default=0)
    for first in range(0, len(words) if walks else 0, WALKED):
        part = words[first : first + WALKED + longest]
        for salt, steps in walks:
            every = walk_keys(part, salt, steps)[:WALKED]
            at = _holds(seeds, every)
            keep(at[part[at] != 0], every, first)
    places, found = np.concatenate(places), np.concatenate(found)
    order = np.argsort(places, kind="stable")
    return places[order], found[order]


def _read(docs: DataFrame, keys: list[str], seeds: np.ndarray, wides: list[int], numbers: list[int], longest: int) -> DataFrame:
    """The keys and surroundings of every place that shares a key with some item, up to the filter's errors.

    Surroundings that overlap are one window, so whatever stands around a place lies in its window.
    """
    reach = longest + 2 * allowed_edits(longest)
    walks = [walk_of(n, r) for n in numbers for r in range(repetitions(n))]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = word_lists(batch.column(len(keys)))
            texts = len(offsets) - 1
            words = np.zeros(len(flat) + texts, np.uint64)
            words[np.arange(len(flat)) + np.repeat(np.arange(texts), np.diff(offsets))] = _no_zeros(flat)
            begins = offsets[:-1] + np.arange(texts)
            ends = offsets[1:] + np.arange(texts)
            hits, found = _hits(words, ends, seeds, wides, walks)
            of = np.searchsorted(ends, hits)
            new = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(hits, prepend=0) > 2 * reach))
            rows, docs_at = {k: [] for k in ("start", "spots", "seeds", "window")}, []
            for a, b in zip(new, np.append(new, len(hits))[1:], strict=True):
                low, high = begins[of[a]], ends[of[a]]
                first, last = max(low, hits[a] - reach), min(high, hits[b - 1] + reach)
                docs_at.append(of[a])
                rows["start"].append(int(first - low))
                rows["spots"].append(hits[a:b] - first)
                rows["seeds"].append(found[a:b].view(np.int64))
                rows["window"].append(words[first:last].view(np.int64))
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 3]
            columns = [batch.column(i).take(pa.array(docs_at, pa.int64())) for i in range(len(keys))]
            columns += [pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, *rows])

    worded = _words(docs, *keys)
    kept = ", ".join(f"{k} {worded.schema[k].dataType.simpleString()}" for k in keys)
    return worded.mapInArrow(read, f"{kept}, {_WINDOW}").withColumn("at", F.monotonically_increasing_id())


def _runs(item: np.ndarray, window: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first word, words) of the parts of the window that the item may stand in, near its supposed starts."""
    edits, starts = allowed_edits(len(item)), np.sort(starts)
    span = len(item) + 2 * edits
    new = np.flatnonzero(np.diff(starts, prepend=starts[0] - span - edits - 1) > span + edits)
    for a, b in zip(new, np.append(new, len(starts))[1:], strict=True):
        low = max(0, int(starts[a]) - edits)
        yield low, window[low : max(low, int(starts[b - 1]) + span)]


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Exact distance of every pair, many pairs of one item size in one table."""
    for pairs in batches:
        runs = [(len(i), len(w), n, low, w) for n, (i, w, s) in enumerate(zip(pairs["words"], pairs["window"], pairs["starts"], strict=True)) for low, w in _runs(i, w, s)]
        runs.sort(key=lambda r: r[:4])
        out, a = {k: [] for k in ("n", "start", "edits")}, 0
        while a < len(runs):
            b = a + 1
            while b < len(runs) and runs[b][0] == runs[a][0] and (b + 1 - a) * (runs[b][1] + 1) <= CELLS:
                b += 1
            items = np.stack([pairs["words"].iloc[r[2]] for r in runs[a:b]])
            windows = np.zeros((b - a, runs[b - 1][1]), np.int64)
            for row, r in zip(windows, runs[a:b], strict=True):
                row[: r[1]] = r[4]
            edits, start = best_places(items, windows)
            for r in np.flatnonzero(edits <= allowed_edits(runs[a][0])):
                out["n"].append(runs[a + r][2])
                out["start"].append(runs[a + r][3] + int(start[r]))
                out["edits"].append(int(edits[r]))
            a = b
        best = pd.DataFrame(out, dtype=np.int64).sort_values(["n", "edits", "start"]).drop_duplicates("n")
        close = pairs[["at", "item_id"]].iloc[best["n"].to_numpy()].reset_index(drop=True)
        yield close.assign(start=best["start"].to_numpy(), edits=best["edits"].to_numpy())


def _places(docs: DataFrame, benchmark: DataFrame, keys: list[str]) -> DataFrame:
    """The keys, item_id, start and edits of the best place of every item in every window."""
    items = stored(_items(benchmark), "bench-items")
    sizes = items.agg(F.max(F.size("words")).alias("longest"), F.collect_set("wide").alias("wides"), F.collect_set("number").alias("numbers")).first()
    numbers = sorted(n for n in sizes.numbers if n >= 0)
    windows = stored(_read(docs, keys, _filter(items), sorted(sizes.wides), numbers, sizes.longest or 0), "bench-windows")
    seeds = items.select("item", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select("item", "s.places", F.col("s.seeds").alias("seed"))
    spots = windows.select("at", F.explode(F.arrays_zip("spots", "seeds")).alias("s")).select("at", "s.spots", F.col("s.seeds").alias("seed"))
    pairs = spots.join(seeds, "seed").groupBy("at", "item").agg(F.collect_set(F.col("spots") - F.col("places")).alias("starts"))
    full = pairs.join(items.select("item", "item_id", "words"), "item").join(windows.select("at", "window"), "at")
    found = full.select("at", "item_id", "words", "window", "starts").mapInPandas(_verify, _FOUND)
    placed = found.join(windows.select("at", *keys, F.col("start").alias("first")), "at")
    return placed.select(*keys, "item_id", (F.col("first") + F.col("start")).alias("start"), "edits")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start (word number, from 0) and edits of every benchmark item in a document.

    Words as in ``split_words``, in lower case. An item of m words stands in a document where
    some run of words is within ``allowed_edits(m)`` word insertions, deletions and replacements of
    it; the best of the places found is given, the first on a tie. Items that allow no edit (under
    seven words) are found by an exact join on all their words, others with the recall that
    ``repetitions`` measures. Items without words or with null ids are not searched. Documents with
    one id are reported as one, as are items. Null and empty texts hold nothing; an empty benchmark
    finds nothing. Extra columns are not read.

    Only surroundings of what the filter takes for a key of an item leave the scan: it has a fixed
    size, no false negatives, and the join on keys follows. A hot key is split as a skewed join.
    """
    best = F.min(F.struct("edits", "start")).alias("b")
    found = _places(docs, benchmark, ["doc_id"]).groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", "b.start", "b.edits")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item stands; see contaminated. Rows are told apart by doc_id and text."""
    row = docs.select("doc_id", F.md5("text").alias("text_md5"), "text")
    of, md5 = free_name(docs, "of_id"), free_name(docs, "of_md5")
    places = _places(row, benchmark, ["doc_id", "text_md5"])
    found = stored(places.select(F.col("doc_id").alias(of), F.col("text_md5").alias(md5)).distinct(), "bench-found")
    same_row = F.col("doc_id").eqNullSafe(F.col(of)) & F.md5("text").eqNullSafe(F.col(md5))
    return docs.join(found, same_row, "left_anti")
