"""Message topic to trip counts per vendor and window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.schemas import TRIP_MESSAGE
from tripmill.streaming.messages import CORRUPT, parse_messages
from tripmill.streaming.windows import WINDOW, tumbling_counts, with_arrival_time, with_event_time


def _reason(event_time: str | None) -> Column:
    """Why a parsed message cannot be counted; null if it can."""
    why = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
    if event_time is None:
        return why
    return why.when(F.col(event_time).try_cast("timestamp").isNull(), F.lit("no time"))


def trip_stats(
    topic: DataFrame,
    event_time: str | None = None,
    lateness: str | None = "0 seconds",
    size: str = WINDOW,
    quarantine: bool = False,
) -> DataFrame:
    """Counts by arrival time, or by the named time field of the messages.

    Without a watermark (``lateness=None``) no row is late, but the state of old windows stays:
    use that for bounded replays. Malformed text stops the query; with ``quarantine`` it is left
    out, as are messages without a readable time, and ``rejected`` gives both.
    """
    messages = parse_messages(topic, quarantine=quarantine)
    if quarantine:
        messages = messages.where(_reason(event_time).isNull()).drop(CORRUPT)
    if event_time is None:
        return tumbling_counts(with_arrival_time(messages), "proc_time", size=size)
    return tumbling_counts(with_event_time(messages, event_time, lateness), event_time, size=size)


def rejected(topic: DataFrame, event_time: str | None = None) -> DataFrame:
    """Text and reason of the messages that ``trip_stats`` leaves out under quarantine."""
    wide = T.StructType([*TRIP_MESSAGE.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = topic.select("value", F.from_json("value", wide, options).alias("m")).select("value", "m.*")
    return parsed.select("value", _reason(event_time).alias("reason")).where("reason is not null")
