"""Distinct counts: exact running, exact per window, sketches and hashed bitmaps."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import BITMAP_BITS, bit_offset
from millrace.functions.spans import text
from millrace.operators.ordered import ordered, total
from millrace.operators.windows import sliding


def running_distinct(df: DataFrame, value: str, order: str, keys: Sequence[str] = (), name="uv",
                     max_rows: int | None = None) -> DataFrame:
    """After each row, the number of distinct values its key has seen.

    A row counts when it is the first with its value. ``order`` must be unique in the table.
    """
    firsts = df.groupBy(*keys, value).agg(F.min(order).alias("__first"))
    marks = firsts.select(F.col("__first").alias(order), F.lit(1).cast("bigint").alias("__new"))
    marked = df.join(marks, order, "left").withColumn("__new", F.coalesce("__new", F.lit(0).cast("bigint")))
    return ordered(marked, keys, [order], max_rows).running({name: total("__new")}).to_df().drop("__new")


def distinct_per_window(df: DataFrame, ts: str, size: timedelta, value: str, name="uv") -> DataFrame:
    """Exact distinct values per window: deduplicate on (window, value), then count."""
    seen = df.groupBy(F.window(ts, text(size)), value).agg(F.lit(1).alias("__one"))
    counted = seen.groupBy("window").agg(F.count(value).alias(name))
    return counted.select(F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"), name)


def approx_per_window(df: DataFrame, ts: str, size: timedelta, value: str, rsd=0.01, name="uv") -> DataFrame:
    """Approximate distinct values per window (HyperLogLog++; the error has both signs)."""
    counted = df.groupBy(F.window(ts, text(size))).agg(F.approx_count_distinct(value, rsd).alias(name))
    return counted.select(F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"), name)


def bitmap_per_window(df: DataFrame, ts: str, size: timedelta, value: str, bits=BITMAP_BITS, name="uv") -> DataFrame:
    """Distinct hashed values per window, in a bitmap of ``bits`` bits cut into buckets."""
    offset = df.select(F.window(ts, text(size)), bit_offset(F.col(value).cast("string"), bits).alias("__o"))
    parts = offset.groupBy("window", F.bitmap_bucket_number("__o").alias("__bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("__o"))).alias("__n"))
    counted = parts.groupBy("window").agg(F.sum("__n").alias(name))
    return counted.select(F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"), name)


def approx_sliding(df: DataFrame, ts: str, size: timedelta, slide: timedelta, value: str, keys: Sequence[str] = (), name="uv") -> DataFrame:
    """Approximate distinct values per sliding window: a sketch for each pane, and windows as unions of sketches.

    Rows are read into sketches once, whatever the number of windows that hold them. The relative standard error is 1.6 %, with both signs.
    """
    sketched = sliding(df, ts, size, slide, list(keys), {"__sketch": ("sketch", value)})
    return sketched.withColumn(name, F.hll_sketch_estimate("__sketch")).drop("__sketch")


def bloom_size(expected: int, error: float) -> tuple[int, int]:
    """Bits and hash positions of a Bloom filter that takes new values for known ones with probability ``error`` when it is full."""
    bits = math.ceil(-expected * math.log(error) / math.log(2) ** 2)
    return bits, max(1, round(bits / expected * math.log(2)))


def bloom_positions(value: Column, bits: int, hashes: int) -> Column:
    """The positions of a value, by double hashing of its text."""
    digest = F.md5(value.cast("string").cast("binary"))
    first, step = (F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint") % bits for at in (1, 17))
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)), lambda i: (first + i * step) % bits))


def bloom_firsts(df: DataFrame, ts: str, size: timedelta, value: str, order: str, bits: int, hashes: int) -> DataFrame:
    """(window_start, window_end, bit, first): the bits that a window's values set, and the order of the first row that sets each.

    Parts of a table can be computed apart and merged by the minimum.
    """
    seen = df.where(F.col(value).isNotNull()).groupBy(F.window(ts, text(size)), value).agg(F.min(order).alias("first"))
    places = seen.select("window.start", "window.end", "first", F.explode(bloom_positions(F.col(value), bits, hashes)).alias("bit"))
    named = places.withColumnsRenamed({"start": "window_start", "end": "window_end"})
    return named.groupBy("window_start", "window_end", "bit").agg(F.min("first").alias("first"))


def bloom_count(firsts: DataFrame, name="uv") -> DataFrame:
    """Rows that set a bit first, per window. Only new values do, so the count never exceeds the distinct values."""
    rows = firsts.select("window_start", "window_end", "first").distinct()
    return rows.groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias(name))


def bloom_per_window(df: DataFrame, ts: str, size: timedelta, value: str, order: str, bits: int, hashes: int, name="uv") -> DataFrame:
    """Distinct values per window as a Bloom filter counts them row by row in ``order``: a value counts when one of its bits is not set yet.

    A row sets a bit that was clear exactly when it is the first row of that bit, so no row has to wait for the ones before it. ``order``
    must be unique in the table.
    """
    return bloom_count(bloom_firsts(df, ts, size, value, order, bits, hashes), name)
