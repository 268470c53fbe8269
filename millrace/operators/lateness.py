"""Late rows, judged row by row in arrival order."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.spans import floor_time, interval
from millrace.operators.ordered import highest, ordered

TICK = timedelta(milliseconds=1)
ZERO = timedelta(0)


def classify(df: DataFrame, arrival: Sequence[str], ts: str, size: timedelta, bound: timedelta = ZERO,
             allowed: timedelta = ZERO, slide: timedelta | None = None, tick: timedelta = TICK,
             max_rows: int | None = None, since: Column | None = None) -> DataFrame:
    """Add ``watermark``, the row's window bounds and ``status``.

    ``watermark`` is what the earlier arrivals have set: their latest event time less ``bound`` and
    ``tick`` (punctuated and periodic generators use a zero tick). ``status`` is ``on_time``,
    ``refire`` (the window has fired but is still open for ``allowed``) or ``late``. With ``slide``,
    the bounds are those of the row's last window: a row is late when all of its windows are closed. A row without a time has no window and is
    never late. ``since`` is the latest event time before the first row, of batches that came earlier.
    """
    seen = ordered(df, [], arrival, max_rows).running({"__seen": highest(ts)}, exclusive=True).to_df()
    if since is not None:
        seen = seen.withColumn("__seen", F.greatest("__seen", since))
    start = floor_time(ts, slide or size)
    out = seen.withColumn("window_start", start)
    out = out.withColumn("window_end", F.col("window_start") + interval(size))
    out = out.withColumn("watermark", F.col("__seen") - interval(bound + tick)).drop("__seen")
    last_instant = F.col("window_end") - interval(TICK)
    return out.withColumn("status", _status(F.col("watermark"), last_instant, allowed))


def _status(watermark: Column, last_instant: Column, allowed: timedelta) -> Column:
    return (F.when(watermark.isNull() | last_instant.isNull() | (watermark < last_instant), "on_time")
            .when(watermark < last_instant + interval(allowed), "refire").otherwise("late"))


def merge_late(classified: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per window: rows in its first firing, rows added by re-firing, and rows merged back late."""
    part = lambda status: F.count(F.when(F.col("status") == status, 1))
    return classified.groupBy("window_start", "window_end", *keys).agg(
        part("on_time").alias("on_time"), part("refire").alias("refired"),
        part("late").alias("late"), F.count(F.lit(1)).alias("merged"))
