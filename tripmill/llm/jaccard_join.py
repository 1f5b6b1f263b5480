"""Operator 2: texts whose word shingles agree, by MinHash banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import lower_ascii, set_aside, split_words, stored
from tripmill.llm.components import components
from tripmill.llm.shingles import mix, pack, shingle_sets, unpack, word_lists

WORDS, THRESHOLD = 5, 0.8
#: Chance that a pair at the threshold shares a band, and hashes that may be spent on it.
TARGET_RECALL, MOST_HASHES = 0.995, 128
#: Bytes of packed sets, and sets, that are compared with as many at a time.
BLOCK_BYTES, BLOCK_SETS = 1 << 18, 1024
_SET = "fp binary, shingles binary"
_LINKS = "fp binary, root binary, n long"


def choose_bands(threshold: float, recall: float, most: int) -> tuple[int, int]:
    """(bands, rows): most rows to a band, hence fewest false candidates, that reach the recall."""
    for rows in range(most, 0, -1):
        chance = threshold**rows
        bands = 1 if chance >= 1 else int(np.ceil(np.log(1 - recall) / np.log1p(-chance)))
        if bands * rows <= most:
            return bands, rows
    return most, 1


def band_hashes(sets: list[np.ndarray], bands: int, rows: int, seed: int = 23) -> np.ndarray:
    """One hash for each set and band; sets must not be empty."""
    salts = np.random.default_rng(seed).integers(1, 2**63, (bands * rows, 2), dtype=np.uint64)
    sizes = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), bands), np.uint64)
    at = 0
    while at < len(sets):  # so many sets at a time that they stay in the processor's cache
        stop = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), 1 << 15)) + at)
        flat = np.concatenate(sets[at:stop])
        starts = np.cumsum(sizes[at:stop]) - sizes[at:stop]
        for band in range(bands):
            folded = np.full(stop - at, band + 1, np.uint64)
            for salt, odd in salts[band * rows : (band + 1) * rows]:
                least = np.minimum.reduceat((flat ^ salt) * (odd | np.uint64(1)), starts)
                folded = mix(folded * np.uint64(0x9E3779B97F4A7C15) + least)
            out[at:stop, band] = folded
        at = stop
    return out


def _fingerprint(keys: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(keys.tobytes())


def _hashed_words(docs: DataFrame, *columns: str) -> DataFrame:
    words = F.transform(split_words(lower_ascii(F.col("text"))), lambda w: F.xxhash64(w))
    return docs.select(*columns, words.alias("words"))


def _parts(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Runs of about so many words, to bound what is held at a time."""
    ends = column.offsets.to_numpy()
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
        yield at, column.slice(at, stop - at)
        at = stop


def _signatures(docs: DataFrame, keys: list[str], words: int, bands: int, rows: int) -> DataFrame:
    """The keys, fingerprint of the shingle set (null without words) and band hashes of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in _parts(batch.column(len(keys))):
                sets = shingle_sets(*word_lists(part), words)
                some = [i for i, s in enumerate(sets) if len(s)]
                hashes = iter(band_hashes([sets[i] for i in some], bands, rows).view(np.int64)) if some else iter(())
                signed = [next(hashes) if len(s) else None for s in sets]
                prints = [_fingerprint(s) if len(s) else None for s in sets]
                columns = [batch.column(i).slice(at, len(part)) for i in range(len(keys))]
                columns += [pa.array(prints, pa.binary()), pa.array(signed, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keys, "fp", "bands"])

    hashed = _hashed_words(docs, *keys)
    kept = ", ".join(f"{k} {hashed.schema[k].dataType.simpleString()}" for k in keys)
    return hashed.mapInArrow(sign, f"{kept}, fp binary, bands array<long>")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """Packed shingle sets with their fingerprints."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in _parts(batch.column(0)):
                sets = [s for s in shingle_sets(*word_lists(part), words) if len(s)]
                columns = [pa.array([f(s) for s in sets], pa.binary()) for f in (_fingerprint, pack)]
                yield pa.RecordBatch.from_arrays(columns, names=["fp", "shingles"])

    return _hashed_words(docs).mapInArrow(code, _SET)


def _stars(signed: DataFrame) -> DataFrame:
    """(fp, leader) candidates: each bucket's members against its most central member.

    Central is who shares the most bucket places; in a family of copies that is the text the others
    were made from, so most links are found with one comparison for each member.
    """
    classes = signed.filter("fp is not null").groupBy("fp").agg(F.first("bands").alias("bands"))
    places = classes.select("fp", F.explode("bands").alias("bucket"))
    places = stored(places, "near-places")
    shared = places.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(places.join(shared, "bucket"), "near-members")
    central = members.groupBy("fp").agg(F.sum("n").alias("places"))
    ranked = members.join(central, "fp")
    leaders = ranked.groupBy("bucket").agg(F.max_by("fp", F.struct("places", "fp")).alias("leader"))
    return members.join(leaders, "bucket").filter("fp <> leader").select("fp", "leader").distinct()


def _overlaps(one: list[np.ndarray], other: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many elements each set of the one list shares with each of the other."""
    flats = [np.concatenate(x) for x in (one, other)]
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (one, other)]
    both = np.intersect1d(*flats)
    common = np.zeros((len(one), len(other)))
    if not len(both):
        return common
    spots = [np.minimum(np.searchsorted(both, flat), len(both) - 1) for flat in flats]
    known = [both[spot] == flat for spot, flat in zip(spots, flats, strict=True)]
    for at in range(0, len(both), width):
        held = []
        for sets, row, spot, good in zip((one, other), rows, spots, known, strict=True):
            use = good & (spot >= at) & (spot < at + width)
            held.append(np.zeros((len(sets), min(width, len(both) - at)), np.float32))
            held[-1][row[use], spot[use] - at] = 1
        common += held[0] @ held[1].T
    return common


def _groups(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the connected part of each row and column; -1 without a link."""
    ups, downs = np.full(linked.shape[0], -1), np.full(linked.shape[1], -1)
    for number, first in enumerate(np.flatnonzero(linked.any(axis=1))):
        new = np.array([first]) if ups[first] < 0 else np.zeros(0, int)
        while len(new):
            ups[new] = number
            reached = np.flatnonzero(linked[new].any(axis=0) & (downs < 0))
            downs[reached] = number
            new = np.flatnonzero(linked[:, reached].any(axis=1) & (ups < 0))
    return ups, downs


def _between_blocks(threshold: float):
    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Links of each set between two blocks of a family, or within one; ``root`` names its part.

        A pair that meets in several families counts in that of its smallest leader alone.
        """
        same = key[1] == key[2]
        sides = [rows[rows["block"] == k] for k in key[1:]]
        if not all(len(x) for x in sides):
            return pd.DataFrame({"fp": [], "root": [], "n": []})
        sets = [[unpack(x) for x in side["shingles"]] for side in sides]
        sizes = [np.array([len(s) for s in x]) for x in sets]
        common = _overlaps(*sets)
        linked = common / (sizes[0][:, None] + sizes[1][None, :] - common) >= threshold
        names = {name: i for i, name in enumerate({bytes(x) for below in rows["below"] for x in below})}
        if names:
            below = [[np.array([names[bytes(x)] for x in b], np.int64) for b in side["below"]] for side in sides]
            linked &= _overlaps(*below) == 0
        if same:
            np.fill_diagonal(linked, False)
        counts = [linked.sum(axis=1), linked.sum(axis=0)]
        if same:  # a set is one place, not two
            np.fill_diagonal(linked, counts[0] > 0)
        prints, n, part = [], [], []
        for side, count, group in list(zip(sides, counts, _groups(linked), strict=True))[: 1 if same else 2]:
            some = count > 0
            prints += [bytes(x) for x in side["fp"][some]]
            n += count[some].tolist()
            part += group[some].tolist()
        roots: dict[int, bytes] = {}
        for fp, group in zip(prints, part, strict=True):
            roots[group] = min(fp, roots.get(group, fp))
        return pd.DataFrame({"fp": prints, "root": [roots[g] for g in part], "n": n})

    return compare


def _links(docs: DataFrame, signed: DataFrame, words: int, threshold: float) -> DataFrame:
    """(fp, root, n) of sets with links: their number within a part of a family, and a set linked with this one there.

    Each pair of different sets that share a leader is verified and counted once.
    """
    stars = stored(_stars(signed), "near-stars")
    nodes = stars.select("fp").union(stars.select("leader")).distinct()
    first = signed.groupBy("fp").agg(F.min("doc_id").alias("doc_id")).join(nodes, "fp")
    wanted = stored(first.select(F.col("doc_id").alias("wanted")).distinct(), "near-wanted")
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    sets = stored(_sets(texts, words).groupBy("fp").agg(F.first("shingles").alias("shingles")), "near-sets")

    families = stored(stars.union(stars.select("leader", "leader")).distinct(), "near-families")
    sized = families.join(sets.select("fp", F.length("shingles").alias("size")), "fp")
    by_bytes, by_sets = F.ceil(F.sum("size") / BLOCK_BYTES), F.ceil(F.count("*") / BLOCK_SETS)
    blocks = sized.groupBy("leader").agg(F.greatest(by_bytes, by_sets).cast("int").alias("blocks"))
    blocks = stored(blocks, "near-blocks")
    leaders = families.groupBy("fp").agg(F.collect_set("leader").alias("leaders"))
    placed = families.join(blocks, "leader").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = placed.join(leaders, "fp").select(
        "leader",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "fp",
        F.filter("leaders", lambda x: x < F.col("leader")).alias("below"),
    )
    together = met.join(sets, "fp").groupBy("leader", "low", "high")
    return together.applyInPandas(_between_blocks(threshold), _LINKS)


def jaccard_join(
    docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = TARGET_RECALL
) -> DataFrame:
    """doc_id, copy_id, class_id, n_links of every row.

    Texts are sets of ``words``-word shingles (words as in ``split_words``, A-Z in lower case); one
    with fewer words is a single shingle. ``copy_id`` is the smallest doc_id with the same set,
    ``class_id`` the smallest in the connected component of links, a link being a Jaccard similarity
    of at least ``threshold``. ``n_links`` counts the other sets that the set is linked with. All
    equal sets are one node, and neither they nor families are expanded into rows for pairs.

    Bands and rows are chosen for the recall at the threshold. A family is the members of the
    buckets of one leader; all its pairs are compared, block by block, so every pair that shares a
    bucket and meets the threshold is counted, and once. Candidates are verified on whole
    sets. Texts without words (null, empty) are alone: class_id is their doc_id. Rows with null ids
    take part; a class of such rows alone has a null class_id. Extra columns are not read.
    """
    return _classified(docs, ["doc_id"], words, threshold, recall).drop("fp", "label")


def _classified(docs: DataFrame, keys: list[str], words: int, threshold: float, recall: float) -> DataFrame:
    """The rows of jaccard_join with further keys, set fingerprint and component (null without words)."""
    bands, rows = choose_bands(threshold, recall, MOST_HASHES)
    signed = stored(_signatures(docs, keys, words, bands, rows), "near-signed")
    links = stored(_links(docs, signed, words, threshold), "near-links")
    degree = links.groupBy(F.col("fp").alias("node")).agg(F.sum("n").alias("n_links"))
    edges = links.filter("fp <> root").select(F.col("fp").alias("a"), F.col("root").alias("b"))
    labels = components(edges).join(degree, "node")
    copies = signed.filter("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("copy_id"))
    known = copies.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    known = stored(known.withColumn("label", F.coalesce("label", "fp")), "near-known")
    classes = known.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    found = known.join(classes, "label").select("fp", "label", "copy_id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    rows_out = signed.select(*keys, "fp").join(found, "fp", "left")
    alone = F.col("fp").isNull()
    return rows_out.select(
        *keys,
        "fp",
        "label",
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class of near duplicates, with all its columns.

    Rows are told apart by doc_id and text. Of a class the row with the smallest doc_id stays, of
    several the one with the smallest MD5 of its text; rows without ids come last. Rows that repeat
    an id and a text stay once, those without id and words all. Texts without words are no duplicates.
    """
    own, named_back = set_aside(docs, "_md5", "_id", "_text")
    keyed = own.withColumn("_md5", F.md5("text"))
    rows = _classified(keyed.select("doc_id", "_md5", "text"), ["doc_id", "_md5"], words, threshold, TARGET_RECALL)
    counted = stored(rows.groupBy("doc_id", "_md5", "label").agg(F.count("*").alias("_n")), "near-rows")
    best = F.min(F.struct(F.isnull("doc_id").alias("last"), "doc_id", "_md5")).alias("best")
    named = counted.join(counted.filter("label is not null").groupBy("label").agg(best), "label")
    gone = named.filter("not (doc_id <=> best.doc_id and _md5 <=> best._md5)")
    gone = stored(gone.select(F.col("doc_id").alias("_id"), F.col("_md5").alias("_text")), "near-gone")
    same_row = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_md5").eqNullSafe(F.col("_text"))
    kept = keyed.join(gone, same_row, "left_anti")
    # rows that repeat: one of each id and text
    again = counted.filter("_n > 1 and (doc_id is not null or label is not null)")
    again = again.select(F.col("doc_id").alias("_id"), F.col("_md5").alias("_text"))
    again = stored(again.join(gone, ["_id", "_text"], "left_anti"), "near-again")
    if again.isEmpty():
        return named_back(kept.drop("_md5"))
    once = kept.join(again, same_row, "left_anti")
    rest = kept.join(again, same_row, "left_semi")
    return named_back(once.unionByName(rest.dropDuplicates(["doc_id", "_md5"])).drop("_md5"))
