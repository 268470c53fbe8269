"""Distinct values of a stream by sketches that are merged from batch to batch."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.spans import floor_time, interval, text
from millrace.operators.distinct import bloom_firsts
from millrace.operators.windows import sliding
from millrace.streaming.late import Totals

BUCKET_BITS = 8 * 4096  # of the bitmaps of Spark's bitmap functions


class SketchWindows:
    """Approximate distinct values of sliding windows: each batch adds a sketch to every pane that it touches."""

    def __init__(self, spark: SparkSession, folder: str, ts: str, size: timedelta, slide: timedelta, value: str, fold: int = 32):
        self.ts, self.size, self.slide, self.value = ts, size, slide, value
        self.panes = Totals(spark, folder, ["pane"], {"sketch": ("sketch", value)}, fold)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        pane = floor_time(self.ts, self.slide)
        self.panes.add(batch.where(F.col(self.ts).isNotNull()).withColumn("pane", pane), batch_id)

    def table(self, name="uv") -> DataFrame:
        copies = self.size // self.slide
        starts = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        panes = self.panes.table().select("pane", "sketch", starts.alias("back"))
        step = interval(self.slide)
        panes = panes.select((F.col("pane") - step * F.col("back")).alias("window_start"), "sketch")
        merged = panes.groupBy("window_start").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
        return merged.select("window_start", (F.col("window_start") + interval(self.size)).alias("window_end"), name)


class BloomWindows:
    """Distinct values per window by Bloom filters: bitmaps that take in each batch by bit-wise union, and counts that only undercount.

    Batches must come in the order that the rows are counted in; a batch that runs again counts against the bitmaps before it.
    """

    def __init__(self, spark: SparkSession, folder: str, ts: str, size: timedelta, value: str, order: str, bits: int, hashes: int, fold: int = 32):
        self.ts, self.size, self.value, self.order, self.bits, self.hashes = ts, size, value, order, bits, hashes
        window = ["window_start", "window_end"]
        self.bitmaps = Totals(spark, f"{folder}/bitmaps", [*window, "bucket"], {"bitmap": ("bits", "place")}, fold)
        self.counts = Totals(spark, f"{folder}/counts", window, {"uv": ("sum", "new")}, fold)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        firsts = bloom_firsts(batch, self.ts, self.size, self.value, self.order, self.bits, self.hashes)
        firsts = firsts.withColumn("bucket", F.floor(F.col("bit") / BUCKET_BITS)).withColumn("place", F.col("bit") % BUCKET_BITS).persist()
        known = self.bitmaps.table(before=batch_id)
        fresh = firsts
        if known is not None:
            keys = ["window_start", "window_end", "bucket"]
            byte = F.conv(F.hex(F.substring("bitmap", F.floor(F.col("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            is_set = F.coalesce(F.expr("shiftright(byte, cast(place % 8 as int)) & 1") == 1, F.lit(False))
            fresh = firsts.join(known, keys, "left").withColumn("byte", byte).where(~is_set)
        new = fresh.select("window_start", "window_end", "first").distinct().withColumn("new", F.lit(1).cast("bigint"))
        self.counts.add(new, batch_id)
        self.bitmaps.add(firsts, batch_id)
        firsts.unpersist()

    def table(self, name="uv") -> DataFrame:
        return self.counts.table().withColumnRenamed("uv", name)


def kept(df: DataFrame, state: SketchWindows | BloomWindows) -> DataStreamWriter:
    """A writer that adds each batch to ``state``."""
    return df.writeStream.foreachBatch(lambda batch, batch_id: state.add(batch, batch_id))
