"""Event-time windows, joins and top-n over streams, with Spark's own operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.spans import interval, text
from millrace.operators.topn import top_n

ZERO = timedelta(0)


def watermarked(df: DataFrame, ts: str, bound: timedelta = ZERO, allowed: timedelta = ZERO) -> DataFrame:
    """Watermark at the latest event time less ``bound`` (zero: ascending input).

    With ``allowed`` lateness windows stay open that much longer; in update mode they are emitted
    again for each late row, as re-fired windows are.
    """
    if dict(df.dtypes)[ts] == "timestamp_ntz":  # watermarks need an instant
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, text(bound + allowed))


def arrival_time(df: DataFrame, name="arrived") -> DataFrame:
    """Processing time as a column, for windows by the wall clock."""
    return df.withColumn(name, F.current_timestamp())


def windowed(df: DataFrame, ts: str, size: timedelta, keys: Sequence[str], *aggs: Column,
             slide: timedelta | None = None) -> DataFrame:
    window = F.window(ts, text(size), text(slide)) if slide else F.window(ts, text(size))
    return _bounds(df.groupBy(window, *keys).agg(*aggs), keys)


def sessions(df: DataFrame, ts: str, gap: timedelta, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Session windows (append mode only)."""
    return _bounds(df.groupBy(F.session_window(ts, text(gap)).alias("window"), *keys).agg(*aggs), keys)


def distinct_per_window(df: DataFrame, ts: str, size: timedelta, value: str, name="uv") -> DataFrame:
    """Exact distinct values per window: a deduplicating aggregate, then a count of its rows."""
    seen = df.groupBy(F.window(ts, text(size)), value).agg(F.count(F.lit(1)).alias("__rows"))
    return _bounds(seen.groupBy(F.window(F.window_time("window"), text(size))).agg(
        F.count(F.lit(1)).alias(name)), [])


def approx_per_window(df: DataFrame, ts: str, size: timedelta, value: str, rsd=0.01, name="uv") -> DataFrame:
    return windowed(df, ts, size, [], F.approx_count_distinct(value, rsd).alias(name))


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, size: timedelta) -> DataFrame:
    """Inner join on equal keys and the same window; both sides need a watermark.

    The window carries the watermark on; the two times come back as plain timestamps.
    """
    plain = F.timestamp_micros(F.unix_micros(ts))

    def mark(df, name):
        kept = [c for c in df.columns if c != ts]
        return df.select(F.window(ts, text(size)).alias("window"), *kept, plain.alias(name))

    return mark(left, ts).join(mark(right, f"right_{ts}"), [*keys, "window"])


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                  lower: timedelta, upper: timedelta, how="inner") -> DataFrame:
    """Equal keys and ``left_ts + lower <= right_ts <= left_ts + upper``; state is dropped once the bound has passed."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = F.col(right_ts).between(F.col(left_ts) + interval(lower), F.col(left_ts) + interval(upper))
    for key in keys:
        condition = (F.col(key) == F.col(f"__{key}")) & condition
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def top_n_writer(counts: DataFrame, order: Callable[[], Sequence[Column]], n: int,
                 write: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Rank each closed window. In append mode a window's rows arrive in one batch, so each batch is ranked by itself."""

    def rank(batch: DataFrame, batch_id: int) -> None:
        write(top_n(batch, ["window_end"], order(), n), batch_id)

    return counts.writeStream.outputMode("append").foreachBatch(rank)


def per_batch(df: DataFrame, *outputs: Callable[[DataFrame, int], None], mode="append") -> DataStreamWriter:
    """Several outputs of one stream (main and side outputs), computed from the batch read once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        for write in outputs:
            write(batch, batch_id)
        batch.unpersist()

    return df.writeStream.outputMode(mode).foreachBatch(run)


def _bounds(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    others = [c for c in df.columns if c != "window" and c not in keys]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *others)
