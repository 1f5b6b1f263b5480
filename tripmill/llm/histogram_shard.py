"""Operator 7: byte-balanced shards by histogram sort."""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored

#: A key has 63 bits: 40 of the text's hash, then 23 of the document's.
KEY_BITS, DOCUMENT_BITS = 63, 23
#: Bits by which one round of probes narrows a cell.
PROBE_BITS = 8
#: Rows that one task sorts at the end.
BIN_ROWS = 250_000
#: Largest cell that may hold a splitter, as a share of a shard's bytes.
TOLERANCE = 0.0001
_CHUNK = 100_000


def sort_keys(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, copy and the sort key ``k``.

    Equal texts are neighbours, and a hot text still spreads over 2^23 keys. Rows that repeat one
    document are counted first and numbered by ``copy``, so they too get keys of their own.
    """
    text = F.coalesce("text", F.lit(""))
    slim = docs.select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
    )
    runs = slim.groupBy("doc_id", "size", "text_crc32", "h").agg(F.count("*").alias("n"))
    parts = runs.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / _CHUNK))).alias("part"))
    last = F.least(F.col("n"), (F.col("part") + 1) * _CHUNK) - 1
    rows = parts.select("doc_id", "size", "text_crc32", "h", F.explode(F.sequence(F.col("part") * _CHUNK, last)).alias("copy"))
    upper = F.shiftleft(F.shiftrightunsigned("h", 64 - KEY_BITS + DOCUMENT_BITS), DOCUMENT_BITS)
    lower = F.shiftrightunsigned(F.xxhash64("doc_id", "copy"), 64 - DOCUMENT_BITS)
    return rows.withColumn("k", upper.bitwiseOR(lower))


def histogram(keys: DataFrame, shards: int, bin_rows: int = BIN_ROWS, tolerance: float = TOLERANCE):
    """Count bytes and rows below probe keys, round by round, until the splitters are met.

    A cell is a key prefix. A round counts the cells of the prefixes still open, each cut into 256
    by probes; a cell stays open while it holds more rows than a task should sort, or holds a
    splitter and more bytes than the tolerance. Only these counts reach the driver: at most 256
    for each open cell, of which there are at most rows / bin_rows + shards in a round.
    Returns (the open prefixes of each round, the closed cells in key order as (first key, shift,
    rows, bytes)).
    """
    opened: list[list[int]] = []
    cells: list[tuple[int, int, int, int]] = []
    total, shift, wanted = None, KEY_BITS, keys
    while True:
        shift = max(0, shift - PROBE_BITS)
        counted = wanted.groupBy(F.shiftright("k", shift).alias("p")).agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
        cells = sorted(cells + [(r.p << shift, shift, r.rows, r.bytes) for r in counted.collect()])
        if total is None:
            total = sum(c[3] for c in cells)
        below = [0, *accumulate(c[3] for c in cells)]
        targets = {bisect_left(below, total * j / shards) - 1 for j in range(1, shards)}
        heavy = {
            c
            for i, c in enumerate(cells)
            if c[1] == shift and shift > 0 and (c[2] > bin_rows or (i in targets and c[3] > tolerance * total / shards))
        }
        if not heavy:
            return opened, cells
        cells = [c for c in cells if c not in heavy]
        heavy = sorted(c[0] >> shift for c in heavy)
        opened.append(heavy)
        wanted = wanted.filter(F.shiftright("k", shift).isin(heavy))


def place(cells: list[tuple[int, int, int, int]], shards: int, bin_rows: int = BIN_ROWS) -> list[tuple[int, int, int, int, int]]:
    """For each cell: (shift, prefix, shard, bin, slot of the bin's first row)."""
    below = [0, *accumulate(c[3] for c in cells)]
    cuts = []
    for j in range(1, shards):
        goal = below[-1] * j / shards
        i = bisect_left(below, goal)
        if i > 0 and goal - below[i - 1] < below[i] - goal:
            i -= 1
        cuts.append(i)
    placed, shard, bin_no, in_bin, slot, first = [], 0, 0, 0, 0, 0
    for i, (start, shift, rows, _) in enumerate(cells):
        now = sum(c <= i for c in cuts)
        if now != shard:
            shard, bin_no, in_bin, slot, first = now, bin_no + 1, 0, 0, 0
        elif in_bin and in_bin + rows > bin_rows:
            bin_no, in_bin, first = bin_no + 1, 0, slot
        placed.append((shift, start >> shift, shard, bin_no, first))
        in_bin, slot = in_bin + rows, slot + rows
    return placed


def shard_documents(docs: DataFrame, shards: int = 8, bin_rows: int = BIN_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    Shards follow each other in key order, hold near equal bytes, and slots number a shard's rows
    in that order without gaps. The rows are exchanged once, by bin, each bin being what one task
    sorts. Null texts have size 1. Equal rows stay neighbours. Null ids are ids. Fewer rows than
    shards leave shards empty; no rows give no rows. Extra columns are not read.
    """
    spark = docs.sparkSession
    keys = stored(sort_keys(docs), "shard-keys")
    opened, cells = histogram(keys, shards, bin_rows)
    schema = "shift int, p bigint, shard int, bin bigint, first bigint"
    cell_table = stored(spark.createDataFrame(place(cells, shards, bin_rows), schema).coalesce(1), "shard-cells")
    shift = F.lit(max(0, KEY_BITS - PROBE_BITS * (len(opened) + 1)))
    for level in reversed(range(len(opened))):
        own = KEY_BITS - PROBE_BITS * (level + 1)
        shift = F.when(~F.shiftright("k", own).isin(opened[level]), F.lit(own)).otherwise(shift)
    keys = keys.withColumn("shift", shift).withColumn("p", F.expr("shiftright(k, shift)"))
    placed = keys.join(cell_table, ["shift", "p"])
    rank = F.expr("row_number() over (partition by bin order by k, h, doc_id, copy)")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + rank - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
