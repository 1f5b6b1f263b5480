"""Operator 3: nearest neighbours by inner product, abandoning candidates dimension by dimension.

Vectors are dealt to lists by the nearest of a few centroids and turned by one random rotation. A
query looks into its best lists. Of a candidate it first sees a block of rotated columns; the
partial product, scaled up, estimates the whole product with a known spread, so a test against the
query's 20th best so far abandons most candidates after one or two column blocks. Candidates that
last are scored on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import stored

NEIGHBOURS = 20
#: Distinct vectors that the rotation, the centroids and the number of lists to probe are fit on.
SAMPLE = 8_192
#: Recall on the sample that the number of probed lists must reach.
TARGET_RECALL = 0.97
MAX_LISTS = 1_024
#: Candidates, and queries, that one task holds at a time.
CANDIDATE_BLOCK, QUERY_BLOCK = 8_192, 4_096
#: Queries of a block that are compared at a time.
QUERY_SLAB = 128
#: Columns of a block, candidates tested at a time, and spreads that the test allows.
COLUMNS, STRIDE, SPREADS = 16, 256, 3.0
#: Share of the pairs below which they are looked at one by one; error of a whole rotated product for vectors of length 1.
SPARSE, ROUNDING = 0.02, 1e-9


@dataclass
class Lists:
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Column numbers of each row's k largest."""
    k = min(k, scores.shape[1])
    return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def fit_lists(sample: np.ndarray, total: int, k: int = NEIGHBOURS, seed: int = 11) -> Lists:
    """Random rotation, spherical k-means, and the probes that reach the target recall on the sample."""
    rng = np.random.default_rng(seed)
    n, width = sample.shape
    rotation = np.linalg.qr(rng.normal(size=(width, width)))[0]
    count = int(min(MAX_LISTS, max(1, np.sqrt(total) / 4), max(1, n // 32)))
    unit = _unit(sample)
    centroids = unit[rng.choice(n, count, replace=False)]
    for _ in range(12):
        own = np.argmax(unit @ centroids.T, axis=1)
        sums = np.stack([np.bincount(own, unit[:, j], count) for j in range(width)], axis=1)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centroids)
    own = np.argmax(unit @ centroids.T, axis=1)
    asked = rng.choice(n, min(n, 512), replace=False)
    scores = sample[asked] @ sample.T
    scores[np.arange(len(asked)), asked] = -np.inf
    true = _top(scores, k)
    order = np.argsort(-(sample[asked] @ centroids.T), axis=1)
    place = np.argsort(order, axis=1)  # of each list, among those the query would probe
    needed = np.take_along_axis(place, own[true], axis=1)
    found = np.array([(needed < p).mean() for p in range(1, count + 1)])
    return Lists(rotation, centroids, int(np.searchsorted(found, TARGET_RECALL)) + 1 if found[-1] >= TARGET_RECALL else count)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part; equal rows once.

    Left out: null ids, null or empty vectors, null or non-finite components, zero vectors, and
    vectors whose length is not the commonest (the smaller one on a tie).
    """
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    filled = (F.size("embedding") > 0) & sound & F.exists("embedding", lambda v: v != 0)
    kept = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & filled).distinct()
    kept = stored(kept, "ann-vectors")
    sizes = kept.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return kept.filter(F.size("embedding") == (sizes.d if sizes else 0))


def _scan(lists: Lists, queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of a block of candidates for each query, among the lists it probes."""
    x = np.stack(candidates["vector"]).astype(float)
    held = (x, x @ lists.rotation, np.linalg.norm(x, axis=1), candidates["list"].to_numpy(), candidates["candidate"].to_numpy())
    slabs = [queries.iloc[at : at + QUERY_SLAB] for at in range(0, len(queries), QUERY_SLAB)]
    return pd.concat([_scan_slab(lists, slab, held, k) for slab in slabs])


def _slack(seen: int, width: int) -> float:
    """What is added to the product over the columns seen before the test, for vectors of length 1."""
    return max(SPREADS * np.sqrt((1 - seen / width) / seen) * seen / width, ROUNDING)


def _scan_slab(lists: Lists, queries: pd.DataFrame, held: tuple[np.ndarray, ...], k: int) -> pd.DataFrame:
    x, turned_x, norm_x, own_list, ids = held
    q = np.stack(queries["embedding"]).astype(float)
    turned_q, norm_q = q @ lists.rotation, np.linalg.norm(q, axis=1)
    probed = np.zeros((len(q), len(lists.centroids)), bool)
    for i, own in enumerate(queries["probes"]):
        probed[i, own] = True
    width = q.shape[1]
    bar = np.full(len(q), -np.inf)
    best_q, best_id, best_score = np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0)
    for at in range(0, len(x), STRIDE):
        here = slice(at, min(at + STRIDE, len(x)))
        alive = np.take(probed, own_list[here], axis=1)
        norms, partial, seen = np.outer(norm_q, norm_x[here]), np.zeros(alive.shape), 0
        left = np.count_nonzero(alive)
        # while many pairs are left, one product of matrices costs less than the pairs one by one
        while seen < width and left > SPARSE * alive.size:
            block = slice(seen, min(seen + COLUMNS, width))
            partial += turned_q[:, block] @ turned_x[here, block].T
            seen = block.stop
            alive &= partial + _slack(seen, width) * norms >= (seen / width * bar)[:, None]
            left = np.count_nonzero(alive)
        qi, ci = np.nonzero(alive)
        part = partial[qi, ci]
        ci = ci + at
        while seen < width and len(qi):
            block = slice(seen, min(seen + COLUMNS, width))
            part = part + np.einsum("ij,ij->i", turned_q[qi, block], turned_x[ci, block])
            seen = block.stop
            on = part + _slack(seen, width) * norm_q[qi] * norm_x[ci] >= seen / width * bar[qi]
            qi, ci, part = qi[on], ci[on], part[on]
        score = np.einsum("ij,ij->i", q[qi], x[ci])
        best_q, best_id, best_score = np.append(best_q, qi), np.append(best_id, ids[ci]), np.append(best_score, score)
        order = np.lexsort((best_id, -best_score, best_q))
        best_q, best_id, best_score = best_q[order], best_id[order], best_score[order]
        rank = np.arange(len(best_q)) - np.searchsorted(best_q, best_q)
        kept = rank < k
        best_q, best_id, best_score, rank = best_q[kept], best_id[kept], best_score[kept], rank[kept]
        bar[best_q[rank == k - 1]] = best_score[rank == k - 1]
    asked = queries["class_id"].to_numpy()[best_q]
    return pd.DataFrame({"query_class": asked, "class_id": best_id, "score": best_score})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest of all other vectors.

    ``queries`` holds the vec_ids that ask. Equal vectors are one candidate with its k + 1 smallest
    ids, which is all that a query can get of them, so a hot vector costs no more than another.
    Largest inner product of the original vectors, in double precision, comes first; ties go to the
    smaller vec_id; the query's own vec_id is left out. A query whose vector takes no part has no
    rows (see usable). Fewer candidates than k give all of them. Extra columns are not read.
    """
    rows = usable(vectors)
    number = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(number)).filter(F.col("n") <= k + 1)
    classes = few.groupBy("embedding").agg(F.min("vec_id").alias("class_id"), F.sort_array(F.collect_list("vec_id")).alias("members"))
    classes = stored(classes, "ann-classes")
    asking = rows.join(queries.select(F.col("vec_id")).distinct(), "vec_id")
    asking = stored(
        asking.join(classes.select("embedding", "class_id"), "embedding").select(F.col("vec_id").alias("query_id"), "class_id"),
        "ann-queries",
    )
    total = classes.count()
    spark, none = vectors.sparkSession, "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], none)

    sample = classes.select("embedding").orderBy(F.xxhash64("class_id")).limit(SAMPLE).toArrow()
    lists = fit_lists(_matrix(sample.column(0).combine_chunks()), total, k)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _matrix(batch.column(1)) @ lists.centroids.T
            probes = np.argsort(-near, axis=1)[:, : lists.probes].astype(np.int32)
            # the list of a vector is the first it would probe: norms do not change the order
            columns = [batch.column(0), batch.column(1), pa.array(probes[:, 0]), pa.array(list(probes), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["class_id", "embedding", "list", "probes"])

    kind = classes.schema["embedding"].dataType.simpleString()
    dealt = classes.select("class_id", "embedding").mapInArrow(
        deal, f"class_id long, embedding {kind}, list int, probes array<int>"
    )
    dealt = stored(dealt, "ann-lists")

    # lists are packed into blocks of candidates in order; a long list takes blocks of its own
    places, block, room = [], 0, CANDIDATE_BLOCK
    for r in sorted(dealt.groupBy("list").count().collect()):
        if r["count"] > room and room < CANDIDATE_BLOCK:
            block, room = block + 1, CANDIDATE_BLOCK
        blocks = -(-r["count"] // CANDIDATE_BLOCK)
        places.append((r.list, block, blocks))
        block, room = (block + blocks, CANDIDATE_BLOCK) if blocks > 1 else (block, room - r["count"])
    spans = F.create_map(*[F.lit(x) for i, first, n in places for x in (i, (first << 32) + n)])
    first, n = F.shiftright(spans[F.col("list")], 32), spans[F.col("list")].bitwiseAND(F.lit((1 << 32) - 1))
    candidates = dealt.withColumn("block", first + F.pmod(F.xxhash64("class_id"), n)).drop("probes")

    asked = dealt.join(asking.select("class_id").distinct(), "class_id")
    query_blocks = max(1, -(-asking.count() // QUERY_BLOCK))
    asked = asked.withColumn("query_block", F.pmod(F.xxhash64(F.lit(7), "class_id"), F.lit(query_blocks)).cast("int"))
    own = F.filter(F.transform("probes", lambda i: spans[i]), lambda s: s.isNotNull())
    wanted = F.flatten(
        F.transform(
            own,
            lambda s: F.sequence(F.shiftright(s, 32), F.shiftright(s, 32) + s.bitwiseAND(F.lit((1 << 32) - 1)) - 1),
        )
    )
    asked = asked.withColumn("block", F.explode(F.array_distinct(wanted))).drop("list")
    candidates = candidates.select(
        F.col("block").alias("of_block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("for_queries"),
        F.col("class_id").alias("candidate"),
        F.col("embedding").alias("vector"),
        F.col("list").alias("list"),
    )

    def scan(key: tuple, ask: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(ask) or not len(held):
            return pd.DataFrame({"query_class": [], "class_id": [], "score": []})
        return _scan(lists, ask, held, k + 1)

    found = (
        asked.groupBy("block", "query_block")
        .cogroup(candidates.groupBy("of_block", "for_queries"))
        .applyInPandas(scan, "query_class long, class_id long, score double")
    )
    best = Window.partitionBy("query_class").orderBy(F.desc("score"), "class_id")
    found = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    members = found.join(classes.select("class_id", "members"), "class_id")
    pairs = asking.select("query_id", F.col("class_id").alias("query_class")).join(members, "query_class")
    pairs = pairs.select("query_id", "score", F.explode("members").alias("vec_id")).filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
