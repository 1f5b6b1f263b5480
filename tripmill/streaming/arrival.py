"""Tumbling counts by arrival time whose windows close by themselves.

Spark's own windows by processing time stay open until a later row moves the watermark. Here each
vendor's open window is kept state with a timer at its end, so it is given out when its time has
passed, whether or not anything arrives.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tripmill.schemas import TRIP_STATS

_EPOCH = datetime(1970, 1, 1)


class ArrivalWindows(StatefulProcessor):
    """Counts of one vendor in its open window, and the window when it closes."""

    def __init__(self, millis: int):
        self.millis = millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        state = T.StructType([T.StructField("start", T.LongType()), T.StructField("trips", T.LongType())])
        self.window = handle.getValueState("window", state)

    def _closed(self, key: tuple) -> Iterator[pd.DataFrame]:
        start, trips = self.window.get()
        self.window.clear()
        first = _EPOCH + timedelta(milliseconds=start)
        row = (key[0], trips, first, first + timedelta(milliseconds=self.millis))
        yield pd.DataFrame([row], columns=TRIP_STATS.names)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        start, trips = now - now % self.millis, 0
        if self.window.exists():
            opened, trips = self.window.get()
            if opened != start:
                # its timer runs in the same batch, after the rows; the window must not take them
                self.handle.deleteTimer(opened + self.millis)
                yield from self._closed(key)
                trips = 0
        for part in rows:
            trips += int(part["trip_count"].sum())
        self.window.update((start, trips))
        self.handle.registerTimer(start + self.millis)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.window.exists() and self.window.get()[0] + self.millis <= expiredTimerInfo.getExpiryTimeInMs():
            yield from self._closed(key)

    def close(self) -> None:
        pass


def _per_task(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of each vendor counted before they are sent to its state, so a hot vendor is a few rows."""
    for part in parts:
        counts = part.groupby("vendor_id", dropna=False).size()
        yield pd.DataFrame({"vendor_id": counts.index, "trip_count": counts.to_numpy()})


def arrival_counts(stream: DataFrame, size: str = "5 minutes", vendor_col: str = "vendor_id") -> DataFrame:
    """vendor_id, trip_count, window_start, window_end of every window that has closed, once.

    Windows are half-open and aligned to the epoch. A row counts in the window in which its batch is
    worked on; a null vendor is a vendor. Run it with a trigger by processing time and a RocksDB state
    store: a trigger that stops when all input is read leaves the last windows open in the checkpoint,
    and a restart closes them.
    """
    millis = int(pd.Timedelta(size).total_seconds() * 1000)
    vendors = stream.select(F.col(vendor_col).cast("string").alias("vendor_id"))
    counted = vendors.mapInPandas(_per_task, "vendor_id string, trip_count long")
    return counted.groupBy("vendor_id").transformWithStateInPandas(
        ArrivalWindows(millis), outputStructType=TRIP_STATS, outputMode="Append", timeMode="ProcessingTime"
    )
