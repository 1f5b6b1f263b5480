"""Operator 12: tokens of two tokenizers aligned by a galloping intersection of their ends.

Both tokenizers cut the same bytes, so each gives an ascending list of end offsets. The shorter list
drives: every end looks for its place in the longer list by doubling steps from the place of the one
before, and then by bisection between the last two. Ends found in both cut the tokens into groups;
the places themselves say which tokens of the longer list a token of the shorter one overlaps.

Documents are encoded once, in stored blocks, whose links are packed as one binary value and whose files
have small row groups. How many documents hold an id pair is counted over all blocks, each of which adds
up its own documents first; every block then asks for the pairs it holds.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored

#: Ends of the driving list that gallop one after the other; so many runs go side by side.
RUN = 64
#: Bytes of whole texts that are encoded at a time, links and documents of a block.
SLICE_BYTES, BLOCK_LINKS = 1 << 20, 300_000
#: Characters of distinct stretches that a worker keeps; all are dropped when there are more.
MEMO_CHARS = 3_000_000
#: Ids of the second tokenizer are below this, so a pair of ids is one number.
SECOND_IDS = 1 << 17

_BLOCKS = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "hashes array<string>, pairs array<long>, pair_docs array<int>, links binary"
)
# a block is a row of some hundred kB, and readers hold a row group of them at once
_ROW_GROUPS = {"parquet.block.size": 4 << 20, "parquet.page.size.row.check.min": 1}
_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Place of the first value of ``long`` that is not below, for each value of ``short``; both ascend.

    Runs of RUN values of the short list are taken side by side: in each, a search begins where the
    one before it ended, doubles its step until it is past the value, and bisects the last step.
    """
    n, m = len(short), len(long)
    out = np.empty(n, np.int64)
    heads = np.arange(0, n, RUN)
    low = np.zeros(len(heads), np.int64)
    ahead = np.append(long, np.iinfo(np.int64).max)
    for step in range(min(RUN, n)):
        at = heads + step
        at = at[at < n]
        low = low[: len(at)]
        value = short[at]
        high, width = low.copy(), 1
        active = np.flatnonzero(ahead[high] < value)
        while len(active):
            low[active] = high[active] + 1
            high[active] = np.minimum(high[active] + width, m)
            width *= 2
            active = active[ahead[high[active]] < value[active]]
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) >> 1
            below = ahead[middle] < value[active]
            low[active[below]] = middle[below] + 1
            high[active[~below]] = middle[~below]
            active = active[low[active] < high[active]]
        out[at] = low
    return out


def overlaps(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first and last token of the long list that each token of the short one overlaps, common ends in both).

    Both lists hold the ends of the same bytes, so their last values are equal.
    """
    last = gallop(short, long)
    common = long[last] == short
    first = np.zeros(len(short), np.int64)
    first[1:] = last[:-1] + common[:-1]
    return first, last, np.flatnonzero(common), last[common]


class _Coder:
    """Ids and byte lengths by both tokenizers."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        size = self.first.get_vocab_size(with_added_tokens=True)
        shown = {c: b for b, c in enumerate(_shown_bytes())}
        entries = [self.first.id_to_token(i) or "" for i in range(size)]
        first_bytes = [bytes(shown[c] for c in x) if all(c in shown for c in x) else x.encode() for x in entries]
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        second_bytes = [
            bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        assert len(pieces) <= SECOND_IDS
        # else a token could reach across the space between two words
        assert not any("▁" in p.lstrip("▁") for p in pieces)
        self.tables = [pa.array(x, pa.binary()) for x in (first_bytes, second_bytes)]
        self.sizes = [np.array([len(b) for b in x], np.int64) for x in (first_bytes, second_bytes)]
        # an id's text with what follows it: the next id of its side, or the other side or group
        self.words = np.array(
            [f"{i}{mark}" for n, mark in ((size, ","), (size, "|"), (len(pieces), ","), (len(pieces), ";")) for i in range(n)], object
        )
        self.starts = np.cumsum([0, size, size, len(pieces)])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each side the ids of all texts and where each text's end; the second puts the space before a text itself."""
        first = [e.ids for e in self.first.encode_batch_fast(texts, add_special_tokens=False)]
        second = self.second.encode([t[1:] for t in texts], num_threads=1)
        return [(np.fromiter(chain.from_iterable(x), np.int64), np.cumsum(list(map(len, x)))) for x in (first, second)]

    def agree(self, side: int, ids: np.ndarray, stops: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Whether each text's ids join to its bytes."""
        joined = self.tables[side].take(pa.array(ids)).buffers()[2]
        joined = joined.to_pybytes() if joined else b""
        ends = np.append(0, np.cumsum(self.sizes[side][ids]))[np.append(0, stops)].tolist()
        return np.array([joined[i:j] == text for i, j, text in zip(ends[:-1], ends[1:], texts, strict=True)], bool)


def _shown_bytes() -> list[str]:
    """The character by which a byte-level tokenizer shows each byte: itself if printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


_memos: dict[tuple[str, str], _Aligned] = {}


def _memo(first: str, second: str) -> _Aligned:
    """One for each pair of tokenizers and worker."""
    if (first, second) not in _memos:
        _memos[first, second] = _Aligned(_Coder(first, second))
    return _memos[first, second]


def _runs(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, member) of all members of the ranges first..last."""
    sizes = last - first + 1
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[which]


class _Aligned:
    """Alignments of distinct stretches of text, each aligned once and kept.

    Both tokenizers end a token before a space between two characters that are visible, so a text's
    alignment is that of its stretches between such spaces, one after the other. Stretches repeat.
    """

    def __init__(self, coder: _Coder):
        self.coder = coder
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.counts = np.zeros((0, 5), np.int64)  # n_a, n_b, n_groups, n_links, whether bytes agree
        self.strings: list[str] = []
        self.links = np.zeros(0, np.int64)
        self.size = 0

    def look_up(self, stretches: list[str]) -> np.ndarray:
        """Row of each stretch."""
        if self.size > MEMO_CHARS:
            self.clear()
        new = [x for x in stretches if x not in self.place]
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            counts, strings, links = _align(self.coder, new)
            self.counts = np.concatenate([self.counts, counts])
            self.strings += strings
            self.links = np.concatenate([self.links, links])
            self.stops = np.cumsum(self.counts[:, 3])
            self.size += sum(map(len, new))
        return np.fromiter(map(self.place.__getitem__, stretches), np.int64, len(stretches))


def _align(coder: _Coder, stretches: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Counts and groups of each stretch (which begins with a space), and the id pairs of all links in order."""
    ids = coder.encode(stretches)
    raw = [x.encode() for x in stretches]
    same = coder.agree(0, *ids[0], raw) & coder.agree(1, *ids[1], raw)
    sizes = [np.diff(stops, prepend=0) for _, stops in ids]
    counts, strings = np.zeros((len(stretches), 5), np.int64), [""] * len(stretches)
    made = []
    # stretches whose shorter list is the first tokenizer's, and the others
    for side, chosen in enumerate((np.flatnonzero(same & (sizes[0] <= sizes[1])), np.flatnonzero(same & (sizes[0] > sizes[1])))):
        if not len(chosen):
            continue
        # stretches one after the other are one pair of lists: the last end of each is common to both
        n_own, n_other = sizes[side][chosen], sizes[1 - side][chosen]
        own, other = (ids[s][0][_runs((ids[s][1] - sizes[s])[chosen], ids[s][1][chosen] - 1)[1]] for s in (side, 1 - side))
        first, last, cut_own, cut_other = overlaps(np.cumsum(coder.sizes[side][own]), np.cumsum(coder.sizes[1 - side][other]))
        which, member = _runs(first, last)
        left, right = (own[which], other[member]) if side == 0 else (other[member], own[which])
        stops = np.cumsum(n_own)
        n_links = np.add.reduceat(last - first + 1, stops - n_own)
        n_groups = np.diff(np.searchsorted(cut_own, stops - 1, side="right"), prepend=0)
        n_a, n_b = (n_own, n_other) if side == 0 else (n_other, n_own)
        counts[chosen] = np.stack([n_a, n_b, n_groups, n_links, np.ones(len(chosen), np.int64)], axis=1)
        groups = _group_texts(coder, side, own, other, cut_own, cut_other, stops, np.cumsum(n_other))
        for i, text in zip(chosen.tolist(), groups, strict=True):
            strings[i] = text
        made.append((chosen, left * SECOND_IDS + right))
    links, stops = np.empty(counts[:, 3].sum(), np.int64), np.cumsum(counts[:, 3])
    for chosen, pairs in made:
        links[_runs((stops - counts[:, 3])[chosen], stops[chosen] - 1)[1]] = pairs
    return counts, strings, links


def _group_texts(
    coder: _Coder, side: int, own: np.ndarray, other: np.ndarray, cut_own: np.ndarray, cut_other: np.ndarray, *stops: np.ndarray
) -> list[str]:
    """The groups of each stretch as ``a1,a2|b1;a3|b2,b3``."""
    a, b, cut_a, cut_b, stop_a, stop_b = own, other, cut_own, cut_other, *stops
    if side:
        a, b, cut_a, cut_b, stop_a, stop_b = other, own, cut_other, cut_own, *stops[::-1]
    # a token's place in the line of both sides: its own number and the other side's tokens before its group's turn
    group_a = np.repeat(np.arange(len(cut_a)), np.diff(cut_a, prepend=-1))
    group_b = np.repeat(np.arange(len(cut_b)), np.diff(cut_b, prepend=-1))
    spot_a = np.arange(len(a)) + np.append(0, cut_b + 1)[group_a]
    spot_b = np.arange(len(b)) + (cut_a + 1)[group_b]
    ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    ends_a[cut_a], ends_b[cut_b] = 1, 1
    line = np.empty(len(a) + len(b), np.int64)
    line[spot_a] = coder.starts[ends_a] + a
    line[spot_b] = coder.starts[2 + ends_b] + b
    words = coder.words[line].tolist()
    bounds = np.append(0, stop_a + stop_b)
    return ["".join(words[i:j])[:-1] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]


def _stretches(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the stretches of a space and each text, number of stretches before each text and at the end).

    A space is a cut if ASCII signs, letters or digits, or letters of two bytes up to U+024F, stand on
    both sides; no rule of either tokenizer looks across such a place.
    """
    spaced = pc.binary_join_element_wise(pa.scalar(""), texts.cast(pa.utf8()), " ")
    offsets = np.frombuffer(spaced.buffers()[1], np.int32)[spaced.offset : spaced.offset + len(spaced) + 1].astype(np.int64)
    data = spaced.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[: offsets[-1]]
    signs = (raw > 0x20) & (raw < 0x7F)
    lead = (raw >= 0xC3) & (raw <= 0xC8)
    spaces = np.flatnonzero(raw[2:-1] == 0x20) + 2 if len(raw) > 3 else np.zeros(0, np.int64)
    visible = (signs[spaces - 1] | lead[spaces - 2]) & (signs[spaces + 1] | lead[spaces + 1])
    # the space put before a text is no cut within one, but its beginning
    bounds = np.sort(np.concatenate([spaces[visible], offsets]))
    bounds = bounds[np.diff(bounds, prepend=-1) > 0]
    flat = pa.Array.from_buffers(pa.utf8(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), data])
    return flat, np.searchsorted(bounds, offsets)


@dataclass
class _Made:
    """Alignments of a run of texts."""

    counts: np.ndarray
    hashes: list[str]
    links: np.ndarray


def align(memo: _Aligned, texts: pa.Array) -> _Made:
    """Counts and group hash of each text, and the id pairs of all links in the order of the texts."""
    flat, cuts = _stretches(pc.fill_null(texts, ""))
    coded = flat.dictionary_encode()
    rows = memo.look_up(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
    found = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(memo.counts[rows], axis=0)])
    counts = found[cuts[1:]] - found[cuts[:-1]]
    filled = pc.greater(pc.fill_null(pc.binary_length(texts), 0), 0).to_numpy(zero_copy_only=False)
    good = filled & (counts[:, 4] == np.diff(cuts))
    counts[~good] = 0
    hashes = [""] * len(good)
    for i in np.flatnonzero(good):
        groups = ";".join(map(memo.strings.__getitem__, rows[cuts[i] : cuts[i + 1]].tolist()))
        hashes[i] = hashlib.sha256(groups.encode()).hexdigest()
    rows = rows[np.repeat(good, np.diff(cuts))]
    stops = memo.stops[rows]
    _, member = _runs(stops - memo.counts[rows, 3], stops - 1)
    return _Made(counts[:, :4], hashes, memo.links[member])


def _packed(values: np.ndarray) -> bytes:
    """Ascending numbers as steps of the fewest bytes, compressed: all lowest bytes first, then the next ones, which are mostly 0.

    The first byte is the number of bytes of a step.
    """
    steps = np.diff(values, prepend=0)
    steps = steps.astype(np.min_scalar_type(steps.max(initial=0)).newbyteorder("<"))
    planes = steps.view(np.uint8).reshape(len(steps), steps.itemsize).T.tobytes()
    return bytes([steps.itemsize]) + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    """The n numbers that were packed."""
    width = data[0]
    planes = pa.decompress(data[1:], n * width, "zstd", asbytes=True) if n else b""
    steps = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T)
    return np.cumsum(steps.view(f"<u{width}").ravel(), dtype=np.int64)


def _block(number: int, doc_ids: list, made: list[_Made]) -> pa.RecordBatch:
    """One row: the documents of a block, its distinct id pairs, and every link as its document and a place among them."""
    counts = np.concatenate([m.counts for m in made])
    codes, pairs = pd.factorize(np.concatenate([m.links for m in made]))
    order = np.argsort(pairs)
    places = np.empty_like(order)
    places[order] = np.arange(len(order))
    places, pairs = places[codes], pairs[order]
    # a document counts once for a pair, however often it holds it linked
    of = np.repeat(np.arange(len(counts)), counts[:, 3])
    held = np.sort(of * max(1, len(pairs)) + places)
    once = held[np.diff(held, prepend=-1) > 0] % max(1, len(pairs))
    docs_of = np.bincount(once, minlength=len(pairs))
    row = [number, doc_ids, *counts.T, [h for m in made for h in m.hashes], pairs, docs_of, _packed(held)]
    kinds = [pa.int64(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
    names = [x.split(" ")[0] for x in _BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)


def _slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about this many bytes."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    run = (np.cumsum(lengths) - lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
    return ((a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b)


def _blocks(docs: DataFrame, first: str, second: str, block_links: int, slice_bytes: int) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, number, ids, made, size = _memo(first, second), TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in _slices(texts, slice_bytes):
                made.append(align(memo, texts.slice(a, b - a)))
                ids += keys[a:b]
                size += len(made[-1].links) + b - a
                if size >= block_links:
                    yield _block(number, ids, made)
                    number, ids, made, size = number + 1, [], [], 0
        if ids:
            yield _block(number, ids, made)
        # Arrow keeps what it freed, a hundred MB, while the worker waits for the joins
        pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text").mapInArrow(encode, _BLOCKS)


def _score(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    # the worker may be one that aligned
    if _memos:
        _memos.clear()
        pa.default_memory_pool().release_unused()
    block = own.iloc[0]
    answers = answers.sort_values("pair")
    assert np.array_equal(answers["pair"].to_numpy(), block["pairs"])
    n, best = answers["n"].to_numpy(np.int64), answers["best"].to_numpy(bool)
    stops = np.cumsum(np.asarray(block["n_links"], np.int64))
    # links are in the order of their documents
    links = _unpacked(block["links"], stops[-1]) % max(1, len(n))
    total, most = (np.diff(np.append(0, np.cumsum(x[links]))[stops], prepend=0) for x in (n, best.astype(np.int64)))
    out = pd.DataFrame({"doc_id": pd.array([None if x is None or x != x else int(x) for x in block["doc_ids"]], dtype="Int64")})
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        out[name] = block[name]
    out["n_best"], out["count_sum"], out["groups_sha256"] = most, total, list(block["hashes"])
    return out


def alignment(
    docs: DataFrame, first: str, second: str, block_links: int = BLOCK_LINKS, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    ``first`` is a byte-level tokenizer's file, which encodes a space and the text; ``second`` is a
    piece model, which puts the space there itself. Special tokens' strings are plain text. Texts
    that are null or empty, or whose tokens do not join to the space and the text (a piece model may
    change white space), have no tokens: zeros and ''. Links are the pairs of token occurrences whose
    bytes overlap; an id pair's count is the number of rows with at least one such link.

    Whole texts are encoded. Repeated rows count each. A null id stays null. No rows give no rows.
    Extra columns are not read. A pair's count is added up in each block before the shuffle, so a
    pair in all documents is one row per block.
    """
    blocks = stored(_blocks(docs, first, second, block_links, slice_bytes), "align-blocks", "zstd", _ROW_GROUPS)
    held = blocks.select(F.col("block").alias("asker"), F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p"))
    held = held.select("asker", F.col("p.pairs").alias("pair"), F.col("p.pair_docs").alias("n"))
    counts = stored(held.groupBy("pair").agg(F.sum("n").alias("n")), "align-counts")
    # at most one row for each id of the first tokenizer
    left = F.floor(F.col("pair") / SECOND_IDS)
    highest = counts.groupBy(left.alias("a")).agg(F.max("n").alias("highest"))
    ranked = counts.withColumn("a", left).join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    answers = held.select("asker", "pair").join(ranked, "pair").select("asker", "pair", "n", "best")
    rows = blocks.drop("pair_docs").groupBy("block").cogroup(answers.groupBy("asker"))
    return rows.applyInPandas(_score, _OUT)
