"""Running streams: closed windows appended, or open windows kept current by key."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tripmill.sinks.keyed import compact, upsert_writer

# Fixed value: the state store that timers and typed state need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def append_closed(
    counts: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append each window once, when the watermark has passed its end."""
    return _trigger(
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint),
        available_now,
    ).start()


def upsert_open(
    counts: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    keys: Sequence[str] = (),
    compact_every: int | None = None,
) -> StreamingQuery:
    """Store every changed window after each batch; ``sinks.keyed.current_rows`` reads them.

    With ``compact_every`` the stream folds its log into the base after that many batches.
    """
    write, schema = upsert_writer(path, owner=checkpoint), counts.schema

    def store(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, path, schema, keys)

    return _trigger(
        counts.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint),
        available_now,
    ).start()


def append_arrivals(counts: DataFrame, path: str, checkpoint: str, every: str = "1 second") -> StreamingQuery:
    """Append the windows of ``arrival.arrival_counts`` as they close; runs until it is stopped.

    Its state needs the RocksDB store, which is set for this query alone.
    """
    conf, key = counts.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    conf.set(key, ROCKSDB)
    try:
        writer = counts.writeStream.outputMode("append").format("parquet").option("path", path)
        return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
    finally:
        conf.set(key, before)


def stop_when(query: StreamingQuery, done: Callable[[], bool], patience: float = 300.0) -> None:
    """Stop a running query once ``done`` says so; its failure, or the end of patience, is an error."""
    end = time.monotonic() + patience
    try:
        while not done():
            if query.exception() is not None:
                raise query.exception()
            if time.monotonic() > end:
                raise TimeoutError(f"query {query.id} is not done after {patience} s")
            time.sleep(0.5)
    finally:
        query.stop()


def _trigger(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer
