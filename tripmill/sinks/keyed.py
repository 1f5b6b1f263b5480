"""Keyed result tables for streams in update mode: a log of changes over a compacted base.

Under one folder lie ``changes/run=R/batch_id=B``, the rows each batch of a run changed, with a mark
in ``commits`` once they are whole;
``base/gen=G/bucket=K``, the newest rows of the keys of a bucket, sorted by key; and ``manifest/gen=G``,
which says from which generation each bucket is to be read and up to which batch each run is in the
base. A reader opens the newest manifest, its base and the batches after it. Compaction merges the
changed buckets into a new generation and switches to it by writing the manifest, a single file that
the writer's commit puts in place at once; streams write on meanwhile. Files that a manifest has
replaced are removed by the compaction after the next one, so readers that began before may finish.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.sinks.store import create_once, remove

#: Buckets of the base; a compaction rewrites those in which a key has changed.
BUCKETS = 16
_MANIFEST = "kind string, number long, upto long, gen long"


def _read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A folder that may not be there yet."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return spark.createDataFrame([], schema)


def _claims(spark: SparkSession, path: str, kind: str) -> dict[int, str]:
    """Claimed numbers with their owners."""
    try:
        rows = spark.read.text(f"{path}/claims/{kind}").select("_metadata.file_name", "value").collect()
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return {}
    return {int(r.file_name): r.value for r in rows}


def _claim(spark: SparkSession, path: str, kind: str, owner: str) -> int:
    """The number after the last one; claims are files that can be created once, so no two get the same."""
    number = max(_claims(spark, path, kind), default=0) + 1
    while not create_once(spark, f"{path}/claims/{kind}/{number}", owner):
        number += 1
    return number


def open_run(spark: SparkSession, path: str, owner: str = "") -> int:
    """Number of a run. One with the same (named) owner goes on as the run it was."""
    mine = [n for n, o in _claims(spark, path, "run").items() if owner and o == owner]
    return mine[0] if mine else _claim(spark, path, "run", owner or "-")


def upsert_writer(path: str, owner: str = "") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores each batch's changed rows in its own folder.

    Runs are numbered in the order in which they claim their number, whatever the clocks. A run named
    by its checkpoint goes on after a restart, and a batch that is replayed replaces itself.
    """
    run: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not run:
            run.append(open_run(batch.sparkSession, path, owner))
        spark, mark = batch.sparkSession, f"{path}/commits/{run[0]}-{batch_id}"
        remove(spark, mark)
        batch.write.mode("overwrite").parquet(f"{path}/changes/run={run[0]}/batch_id={batch_id}")
        create_once(spark, mark, f"{run[0]} {batch_id}")

    return write


def _manifest(spark: SparkSession, path: str, gen: int | None = None) -> tuple[int, dict[int, int], dict[int, int]]:
    """(generation, generation of each bucket, last batch of each run in the base); generation 0 is no base."""
    rows = _read(spark, f"{path}/manifest", _MANIFEST)
    newest = gen if gen is not None else rows.agg(F.max("gen")).first()[0]
    if not newest:
        return 0, {}, {}
    own = rows.where(F.col("gen") == newest).collect()
    buckets = {r.number: r.upto for r in own if r.kind == "bucket"}
    return newest, buckets, {r.number: r.upto for r in own if r.kind == "run"}


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _commits(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(run, batch) of every whole batch in the log; as many as were written since the last compactions."""
    try:
        rows = spark.read.text(f"{path}/commits").collect()
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return []
    return sorted(tuple(map(int, r.value.split())) for r in rows)


def _pending(spark: SparkSession, path: str, folded: dict[int, int]) -> list[tuple[int, int]]:
    return [(run, batch) for run, batch in _commits(spark, path) if batch > folded.get(run, -1)]


def _changes(spark: SparkSession, path: str, schema: T.StructType, batches: list[tuple[int, int]]) -> DataFrame:
    """Rows of the named batches, with run and batch."""
    places = [f"{path}/changes/run={run}/batch_id={batch}" for run, batch in batches]
    wide = _with_origin(schema)
    return spark.read.schema(wide).option("basePath", f"{path}/changes").parquet(*places) if places else spark.createDataFrame([], wide)


def _with_origin(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("run", T.LongType()), T.StructField("batch_id", T.LongType())])


def _base(spark: SparkSession, path: str, schema: T.StructType, buckets: dict[int, int]) -> DataFrame:
    wide = _with_origin(schema)
    places = [f"{path}/base/gen={gen}/bucket={k}" for k, gen in sorted(buckets.items())]
    return spark.read.schema(wide).parquet(*places) if places else spark.createDataFrame([], wide)


def _newest(rows: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The newest row of every key, reduced per task before the shuffle.

    A batch holds a key at most once, so all columns of a key come from the same row.
    """
    values = [c for c in [*schema.names, "run", "batch_id"] if c not in keys]
    when = F.struct("run", "batch_id")
    newest = rows.groupBy(*keys).agg(*[F.max_by(c, when).alias(c) for c in values])
    return newest.select(*schema.names, "run", "batch_id")


def current_rows(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The newest row of every key: that of the last run which has it, and of its last batch.

    A log that nothing was written to has no rows.
    """
    _, buckets, folded = _manifest(spark, path)
    changes = _changes(spark, path, schema, _pending(spark, path, folded))
    rows = _base(spark, path, schema, buckets).unionByName(changes)
    return _newest(rows, schema, keys).select(*schema.names)


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = BUCKETS) -> int | None:
    """Fold the log's changes into a new generation of the base and switch to it; its number, if there was a change.

    Only buckets with changed keys are read and written again. Streams may go on writing: what is not
    whole when the log is listed stays in the log. Of two compactions at a time the
    one that claims its generation first works; the other gives None.
    """
    before, placed, folded = _manifest(spark, path)
    pending = _pending(spark, path, folded)
    if not pending:
        return None
    gen = max([before, *_claims(spark, path, "gen")]) + 1
    if not create_once(spark, f"{path}/claims/gen/{gen}", "compaction"):
        return None
    # exactly what was listed; a run writes its batches in turn, so none before its last one is missing
    upto = dict(pending)
    changes = _changes(spark, path, schema, pending)
    touched = [r.b for r in changes.select(_bucket(keys, buckets).alias("b")).distinct().collect()]
    old = _base(spark, path, schema, {k: g for k, g in placed.items() if k in touched})
    merged = _newest(old.unionByName(changes), schema, keys).withColumn("bucket", _bucket(keys, buckets))
    sorted_runs = merged.hint("rebalance", "bucket").sortWithinPartitions("bucket", *keys)
    sorted_runs.write.partitionBy("bucket").parquet(f"{path}/base/gen={gen}")

    rows = [("bucket", k, g) for k, g in {**placed, **dict.fromkeys(touched, gen)}.items()]
    rows += [("run", run, last) for run, last in {**folded, **upto}.items()]
    manifest = spark.createDataFrame(rows, "kind string, number long, upto long").coalesce(1)
    manifest.write.parquet(f"{path}/manifest/gen={gen}")
    _drop_replaced(spark, path, before, set(placed.items()))
    return gen


def _drop_replaced(spark: SparkSession, path: str, gen: int, kept: set[tuple[int, int]]) -> None:
    """Remove what generation ``gen``, which readers may still hold, had itself replaced."""
    if not gen:
        return
    older = [r.gen for r in _read(spark, f"{path}/manifest", _MANIFEST).where(F.col("gen") < gen).select("gen").distinct().collect()]
    _, _, folded = _manifest(spark, path, gen)
    for one in older:
        _, buckets, _ = _manifest(spark, path, one)
        for k, g in set(buckets.items()) - kept:
            remove(spark, f"{path}/base/gen={g}/bucket={k}")
    for run, batch in _commits(spark, path):
        if batch <= folded.get(run, -1):
            remove(spark, f"{path}/changes/run={run}/batch_id={batch}")
            remove(spark, f"{path}/commits/{run}-{batch}")
    # its manifest goes last, so that a removal which was cut short is done again
    for one in older:
        remove(spark, f"{path}/manifest/gen={one}")
