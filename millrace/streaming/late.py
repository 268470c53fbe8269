"""Late rows of a stream, judged one by one in arrival order, and windows that take them in afterwards.

Spark's own watermark moves once a batch, and rows behind it are gone. Here the writer of the stream owns the rule: the latest event time
is carried from batch to batch in a numbered log, and each batch is judged by the batch operator, so every row leaves with its status.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.checkpoints import remove_folder, written
from millrace.operators import lateness
from millrace.operators.windows import FOLDS, MERGES, Folds

ZERO = timedelta(0)

Write = Callable[[DataFrame, int], None]


class Carried:
    """A value by batch, such as the latest event time. A batch reads what the one before left, so running it again gives the same."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def before(self, batch_id: int, kind: str) -> Column | None:
        earlier = [n for n in written(self.spark, self.folder, "batch") if n < batch_id]
        if not earlier:
            return None
        found = self.spark.read.schema("value string").parquet(f"{self.folder}/batch={earlier[-1]}").first()
        return F.lit(found.value).cast(kind)

    def put(self, one: DataFrame, batch_id: int) -> None:
        """``one``: a row with the value."""
        one.toDF("value").select(F.col("value").cast("string")).write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")
        for old in written(self.spark, self.folder, "batch")[:-2]:  # the one before stays, for a batch that runs again
            remove_folder(self.spark, f"{self.folder}/batch={old}")


def judged(df: DataFrame, folder: str, arrival: Sequence[str], ts: str, size: timedelta, *writes: Write, bound: timedelta = ZERO,
           allowed: timedelta = ZERO, slide: timedelta | None = None) -> DataStreamWriter:
    """A writer that hands each batch to ``writes`` with the columns of `lateness.classify`; no row is dropped.

    Batches must come in the order of ``arrival``, which orders the rows inside each. ``folder`` keeps the latest event time, apart from the
    query's own checkpoint. A batch that fails after some writes runs again with the same rows and statuses, so writes should replace what
    they wrote under the same batch number.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        carried = Carried(batch.sparkSession, folder)
        since = carried.before(batch_id, dict(batch.dtypes)[ts])
        batch = batch.persist()
        rows = lateness.classify(batch, arrival, ts, size, bound, allowed, slide, since=since).persist()
        try:
            for write in writes:
                write(rows, batch_id)
            carried.put(batch.agg(F.max(ts) if since is None else F.greatest(F.max(ts), since)), batch_id)
        finally:
            rows.unpersist()
            batch.unpersist()

    return df.writeStream.foreachBatch(run)


def late_only(path: str) -> Write:
    """Writes the late rows of each batch, the side output of the windows."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.where("status = 'late'").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


class Totals:
    """Aggregates of a stream by ``keys``, kept as numbered parts that later rows, late ones too, are merged with.

    Each batch leaves its partial aggregates under its own number; a batch that runs again replaces them. After ``fold`` batches the parts
    and the table before them become one new table, so a read and the disk follow the keys and not the batches.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], aggs: Folds, fold: int = 32):
        self.spark, self.folder, self.keys, self.aggs, self.fold = spark, folder, list(keys), aggs, fold

    def add(self, rows: DataFrame, batch_id: int) -> None:
        tables = written(self.spark, self.folder, "table")
        if tables and batch_id <= tables[-1]:
            return  # it is in the table already
        values = [FOLDS[kind](F.lit(1) if value is None else value).alias(name) for name, (kind, value) in self.aggs.items()]
        rows.groupBy(*self.keys).agg(*values).write.mode("overwrite").parquet(f"{self.folder}/part={batch_id}")
        if len([p for p in written(self.spark, self.folder, "part") if not tables or p > tables[-1]]) >= self.fold:
            self.table().write.mode("overwrite").parquet(f"{self.folder}/table={batch_id}")
            for name in ("table", "part"):
                for old in written(self.spark, self.folder, name):
                    if old < batch_id or name == "part":
                        remove_folder(self.spark, f"{self.folder}/{name}={old}")

    def table(self, before: int | None = None) -> DataFrame | None:
        """The aggregates of all batches so far, or of those before one; None without any."""
        earlier = lambda name: [n for n in written(self.spark, self.folder, name) if before is None or n < before]
        tables = earlier("table")
        paths = [f"{self.folder}/part={p}" for p in earlier("part") if not tables or p > tables[-1]]
        paths += [f"{self.folder}/table={t}" for t in tables[-1:]]
        if not paths:
            return None
        merges = [MERGES[kind](name).alias(name) for name, (kind, _) in self.aggs.items()]
        return self.spark.read.parquet(*paths).groupBy(*self.keys).agg(*merges)


def merging(totals: Totals, changed: Write | None = None) -> Write:
    """Adds each batch to ``totals``; ``changed`` gets the new results of the keys that the batch has touched."""

    def write(rows: DataFrame, batch_id: int) -> None:
        totals.add(rows, batch_id)
        if changed:
            touched = rows.select(*totals.keys).distinct()
            for key in totals.keys:
                touched = touched.withColumnRenamed(key, f"__{key}")
            same = [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in totals.keys]
            changed(totals.table().join(touched, same, "left_semi"), batch_id)

    return write


def by_status(totals: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Counts by (keys, status) as one row per key: the first firing, what re-firing and late rows added, and all together."""
    part = lambda status: F.coalesce(F.sum(F.when(F.col("status") == status, F.col(name))), F.lit(0)).alias
    return totals.groupBy(*keys).agg(part("on_time")("on_time"), part("refire")("refired"), part("late")("late"), F.sum(name).alias("merged"))
