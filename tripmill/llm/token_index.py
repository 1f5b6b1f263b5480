"""Operator 6: token ids in binary shards, found by a minimal perfect hash index.

File format, in one folder. ``payload``: rows (shard, chunk, width, ids, ...) whose ``ids`` are the
raw token ids of consecutive documents, little-endian unsigned integers of ``width`` bytes (2 if
the vocabulary fits, else 4); shards follow each other in ascending doc_id order, chunks within
them. ``index``: one row per bucket of keys with a minimal perfect hash (levels of bit sets) and,
by slot, fingerprint, shard, chunk, offset and length. ``shards``: first id and id count of every
shard.
"""

from __future__ import annotations

import os
import re
import string
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.session import scratch_dir

END_ID = 2
#: A chunk is closed when its ids take this many bytes; a document is never split.
CHUNK_BYTES = 1 << 20
#: Keys that one bucket of the index holds on average.
BUCKET_KEYS = 50_000
#: Bits of a level for each key still to be placed.
LEVEL_BITS = 2.0
#: Words whose ids a worker keeps; all are dropped when there are more.
MEMO = 800_000
#: Words that are encoded at a time: the tokenizer's own results take some hundred bytes a word.
ENCODED = 1 << 14
# Latin letters; the lower case of the one left out (U+0130) brings a mark, which is no letter to the tokenizer
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"
_WORD = re.compile(_LETTERS).fullmatch

_PAYLOAD = (
    "shard int, chunk int, width int, n_ids long, doc_ids array<long>, occurrences array<long>, "
    "offsets array<long>, lengths array<long>, ids binary"
)
_INDEX = (
    "bucket long, n_keys long, level_bits array<long>, bits binary, fingerprints binary, shards binary, "
    "chunks binary, offsets binary, lengths binary"
)
_FOUND = "doc_id long, occurrence long, shard int, chunk int, offset long, length long"


class _Encoder:
    """Ids of texts, as bytes.

    The tokenizer drops white space and no token reaches across it, so a text's ids are those of
    its pieces between spaces and line ends, one after the other. A piece of letters and a tail of
    ASCII symbols is two token groups to the tokenizer in any case, and ASCII letters lose their case,
    so such pieces are put together from their word and their tail. Words repeat, so their ids are kept.
    Of the tokenizer's steps before its model only lower case and bytes change a word of Latin letters:
    such letters are composed already, and together they are one token group. So only these steps are run on it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.of_words = Tokenizer(self.tokenizer.model)
        self.of_words.normalizer = normalizers.Lowercase()
        self.of_words.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.end = np.array([END_ID], self.dtype).tobytes()
        self.memo: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        kind, words, others = "H" if self.dtype.itemsize == 2 else "I", [], []
        for piece in pieces:
            (words if _WORD(piece) else others).append(piece)
        for tokenizer, own in ((self.of_words, words), (self.tokenizer, others)):
            for at in range(0, len(own), ENCODED):
                run = own[at : at + ENCODED]
                for piece, coded in zip(run, tokenizer.encode_batch_fast(run, add_special_tokens=False), strict=True):
                    ids = array(kind, coded.ids)
                    if sys.byteorder == "big":
                        ids.byteswap()
                    self.memo[piece] = ids.tobytes()

    def _coded(self, parts: list[str]) -> pa.Array:
        if len(self.memo) > MEMO:
            self.memo.clear()
        coded = list(map(self.memo.get, parts))
        missing = [i for i, c in enumerate(coded) if c is None]
        self._learn([parts[i] for i in missing])
        for i in missing:
            coded[i] = self.memo[parts[i]]
        return pa.array(coded, pa.large_binary())

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text: the distinct words of its pieces are encoded, then laid out in the order of the text."""
        pieces = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        ends = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        flat = pieces.flatten().dictionary_encode()
        parts = pa.concat_arrays(_parts(flat.dictionary)).dictionary_encode()
        both = self._coded(parts.dictionary.to_pylist()).take(parts.indices)
        heads, tails = both.slice(0, len(flat.dictionary)), both.slice(len(flat.dictionary))
        laid = pc.binary_join_element_wise(heads, tails, pa.scalar(b"", pa.large_binary())).take(flat.indices)
        cuts = np.concatenate([[0], np.cumsum(pc.binary_length(laid).to_numpy())])[ends].tolist()
        data = laid.buffers()[2].slice(0, cuts[-1]).to_pybytes() if cuts[-1] else b""
        return [data[a:b] + self.end for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _parts(pieces: pa.Array) -> list[pa.Array]:
    """Word and tail of each piece of letters and ASCII symbols after them; else the piece and ''."""
    bare = pc.utf8_rtrim(pieces, characters=string.punctuation)
    split = pc.match_substring_regex(bare, f"^{_LETTERS}$")
    word = pc.if_else(pc.string_is_ascii(bare), pc.ascii_lower(bare), bare)
    tail = pc.replace_substring_regex(pieces, f"^{_LETTERS}", "")
    return [pc.if_else(split, word, pieces), pc.if_else(split, tail, "")]


_encoders: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    """One for each tokenizer and worker."""
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    return _encoders[path]


def _slices(texts: pa.Array, size: int = 16 << 20) -> Iterator[pa.Array]:
    """Runs of whole texts of about this many bytes."""
    lengths = pc.binary_length(texts).to_numpy()
    run = (np.cumsum(lengths) - lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1), len(texts)]
    return (texts.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b)


def _payload(docs: DataFrame, tokenizer: str, chunk_bytes: int) -> DataFrame:
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    fields = [x.split(" ")[0] for x in _PAYLOAD.split(", ")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(tokenizer), TaskContext.get().partitionId()
        width, chunk, last, occurrence = encoder.dtype.itemsize, 0, object(), 0
        ids, seen, coded, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            lengths = np.array([len(c) for c in coded], np.int64) // width
            row = [shard, chunk, width, int(lengths.sum()), ids, seen, np.cumsum(lengths) - lengths, lengths, b"".join(coded)]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 4, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=fields)

        for batch in batches:
            keys, at = batch.column(0).to_pylist(), 0
            for part in _slices(batch.column(1)):
                for key, data in zip(keys[at : at + len(part)], encoder.encode(part), strict=True):
                    occurrence = occurrence + 1 if key == last else 0
                    last = key
                    ids.append(key)
                    seen.append(occurrence)
                    coded.append(data)
                    size += len(data)
                    if size >= chunk_bytes:
                        yield close()
                        chunk, ids, seen, coded, size = chunk + 1, [], [], [], 0
                at += len(part)
        if ids:
            yield close()

    return ordered.mapInArrow(encode, _PAYLOAD)


def _with_hashes(keys: DataFrame, buckets: int) -> DataFrame:
    """128 bits of hash for each key, and its bucket."""
    hashed = keys.withColumn("h1", F.xxhash64("doc_id", "occurrence"))
    hashed = hashed.withColumn("h2", F.xxhash64(F.lit(1), "occurrence", "doc_id", F.col("doc_id").isNull()))
    return hashed.withColumn("bucket", F.pmod("h1", F.lit(buckets)))


def _mixed(h1: np.ndarray, h2: np.ndarray, salt: int) -> np.ndarray:
    x = h1 * np.uint64(0x9E3779B97F4A7C15) + h2 + np.uint64((salt * 0xD1B54A32D192ED03) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _fingerprints(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return (_mixed(h1, h2, 0) >> np.uint64(32)).astype("<u4")


def build_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """Minimal perfect hash of distinct keys: (bits of each level, their bit sets, slot of each key).

    At a level each key left takes the bit its hash names; keys alone on their bit are placed, the
    others go on to the next level. A key's slot is the rank of its bit.
    """
    left, sizes, sets, spots, before = np.arange(len(h1)), [], [], np.zeros(len(h1), np.int64), 0
    while len(left):
        assert len(sizes) < 200, "keys with equal 128-bit hashes"
        size = max(64, -(-int(LEVEL_BITS * len(left)) // 8) * 8)
        spot = (_mixed(h1[left], h2[left], len(sizes) + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(spot, minlength=size) == 1
        placed = alone[spot]
        spots[left[placed]] = before + spot[placed]
        sizes.append(size)
        sets.append(alone)
        left, before = left[~placed], before + size
    bits = np.concatenate(sets) if sets else np.zeros(0, bool)
    return sizes, np.packbits(bits).tobytes(), (np.cumsum(bits) - 1)[spots] if len(bits) else spots


def find_slots(sizes: list[int], bits: bytes, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Slot of each key, -1 where no level has its bit; keys not in the index may get any slot."""
    flags = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
    rank = np.cumsum(flags) - 1
    slots, left, before = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
    for level, size in enumerate(sizes):
        spot = before + (_mixed(h1[left], h2[left], level + 1) % np.uint64(size)).astype(np.int64)
        hit = flags[spot]
        slots[left[hit]] = rank[spot[hit]]
        left, before = left[~hit], before + size
    return slots


def _build_bucket(key: tuple, entries: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = entries["h1"].to_numpy().view(np.uint64), entries["h2"].to_numpy().view(np.uint64)
    sizes, bits, slots = build_hash(h1, h2)
    order = np.argsort(slots)
    row = {"bucket": key[0], "n_keys": len(h1), "level_bits": sizes, "bits": bits}
    row["fingerprints"] = _fingerprints(h1, h2)[order].tobytes()
    for name, kind in (("shard", "<u4"), ("chunk", "<u4"), ("offset", "<u8"), ("length", "<u8")):
        row[f"{name}s"] = entries[name].to_numpy()[order].astype(kind).tobytes()
    return pd.DataFrame([row])


def _look_up(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    columns = [x.split(" ")[0] for x in _FOUND.split(", ")]
    if not len(index) or not len(keys):
        return pd.DataFrame(columns=columns)
    row = index.iloc[0]
    h1, h2 = keys["h1"].to_numpy().view(np.uint64), keys["h2"].to_numpy().view(np.uint64)
    slots = find_slots(list(row["level_bits"]), row["bits"], h1, h2)
    known = slots >= 0
    known[known] = np.frombuffer(row["fingerprints"], "<u4")[slots[known]] == _fingerprints(h1[known], h2[known])
    found, slots = keys[known][["doc_id", "occurrence"]].copy(), slots[known]
    for name, kind in (("shard", "<u4"), ("chunk", "<u4"), ("offset", "<u8"), ("length", "<u8")):
        found[name] = np.frombuffer(row[f"{name}s"], kind)[slots].astype(np.int64)
    return found[columns]


def write_token_index(docs: DataFrame, folder: str, tokenizer: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Encode every whole text, append the end id, and write payload, shards and index to ``folder``.

    Null and empty texts are the end id alone. Rows are ordered by doc_id (null first), then text; a
    repeated doc_id gets one key for each row: (doc_id, occurrence from 0). Extra columns are not
    read. No rows write empty tables.
    """
    spark = docs.sparkSession
    _payload(docs, tokenizer, chunk_bytes).write.option("compression", "zstd").parquet(f"{folder}/payload")
    payload = spark.read.schema(_PAYLOAD).parquet(f"{folder}/payload")
    totals = payload.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    # one small row for each shard
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    totals.withColumn("first_id", F.coalesce(before, F.lit(0))).coalesce(1).write.parquet(f"{folder}/shards")

    rows = payload.select("shard", "chunk", F.explode(F.arrays_zip("doc_ids", "occurrences", "offsets", "lengths")).alias("e"))
    entries = rows.select(
        "shard",
        "chunk",
        F.col("e.doc_ids").alias("doc_id"),
        F.col("e.occurrences").alias("occurrence"),
        F.col("e.offsets").alias("offset"),
        F.col("e.lengths").alias("length"),
    )
    buckets = max(1, -(-payload.agg(F.sum(F.size("doc_ids"))).first()[0] // BUCKET_KEYS)) if not payload.isEmpty() else 1
    index = _with_hashes(entries, buckets).groupBy("bucket").applyInPandas(_build_bucket, _INDEX)
    index.write.parquet(f"{folder}/index")


def find_documents(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Place of each (doc_id, occurrence) that the index holds; constant time for each key.

    A key that is not in the index is left out, but for one in 2^32 whose fingerprint agrees.
    """
    index = spark.read.schema(_INDEX).parquet(f"{folder}/index")
    buckets = max(1, -(-(index.agg(F.sum("n_keys")).first()[0] or 0) // BUCKET_KEYS))
    hashed = _with_hashes(keys.select("doc_id", "occurrence"), buckets)
    return hashed.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(_look_up, _FOUND)


def read_ids(spark: SparkSession, folder: str, found: DataFrame) -> DataFrame:
    """doc_id, occurrence, start, n_tokens and ids_crc32 of the documents found, from their ids."""
    payload = spark.read.schema(_PAYLOAD).parquet(f"{folder}/payload").select("shard", "chunk", "width", "ids")
    out = "doc_id long, occurrence long, shard int, chunk int, offset long, n_tokens long, ids_crc32 long"

    def read(entries: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        entries = entries.rename(columns={"length": "n_tokens"})
        if not len(entries):
            return pd.DataFrame(columns=[x.split(" ")[0] for x in out.split(", ")])
        ids = np.frombuffer(chunk["ids"].iloc[0], f"<u{chunk['width'].iloc[0]}")
        spans = zip(entries["offset"], entries["n_tokens"], strict=True)
        entries["ids_crc32"] = [zlib.crc32(ids[a : a + n].astype("<u4").tobytes()) for a, n in spans]
        return entries

    places = found.groupBy("shard", "chunk").cogroup(payload.groupBy("shard", "chunk")).applyInPandas(read, out)
    starts = _chunk_starts(spark, folder)
    return places.join(starts, ["shard", "chunk"]).select(
        "doc_id", "occurrence", (F.col("chunk_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def _chunk_starts(spark: SparkSession, folder: str) -> DataFrame:
    """Ids before each chunk."""
    chunks = spark.read.schema(_PAYLOAD).parquet(f"{folder}/payload").select("shard", "chunk", "n_ids")
    own = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("in_shard", F.coalesce(F.sum("n_ids").over(own), F.lit(0)))
    shards = spark.read.parquet(f"{folder}/shards").select("shard", "first_id")
    return chunks.join(shards, "shard").select("shard", "chunk", (F.col("first_id") + F.col("in_shard")).alias("chunk_start"))


def numbered(doc_id: str | Column, docs: DataFrame) -> DataFrame:
    """(doc_id, occurrence) of every row."""
    counted = docs.groupBy(doc_id).agg(F.count("*").alias("n"))
    return counted.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("occurrence"))


def token_ids(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files, then look every document up and read it back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "token-index")
    write_token_index(docs, folder, tokenizer)
    found = find_documents(spark, folder, numbered("doc_id", docs))
    return read_ids(spark, folder, found).drop("occurrence")
