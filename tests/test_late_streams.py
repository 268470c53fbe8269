"""Late rows of streams: side output, merging, restarts and failures in mid-stream."""

import random
from datetime import timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.checkpoints import written
from millrace.operators import alerts, lateness
from millrace.streaming import control, late
from samples import T0

SECOND = timedelta(seconds=1)
SIZE, GRACE = 5 * SECOND, 2 * SECOND
KEYS = ["window_start", "window_end", "status"]
FOLDS = {"n": ("count", None), "total": ("sum", "v"), "low": ("min", "v"), "high": ("max", "v")}


@pytest.fixture
def arrivals(spark):
    rng = random.Random(11)
    data = [(i, rng.choice("ab"), None if i % 17 == 5 else T0 + i // 2 - rng.choice([0, 0, 0, 3, 6, 15]), rng.randrange(100)) for i in range(120)]
    return spark.createDataFrame(data, "seq bigint, k string, s bigint, v int").select("seq", "k", F.timestamp_seconds("s").alias("et"), "v")


def pieces(df, *bounds):
    edges = [-1, *bounds, 10**6]
    return [df.where((F.col("seq") > a) & (F.col("seq") <= b)) for a, b in zip(edges, edges[1:])]


def judge(stream, home, *writes):
    return (late.judged(stream, f"{home}/latest", ["seq"], "et", SIZE, *writes, allowed=GRACE)
            .option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True))


def test_late_rows_equal_batch(spark, replay, arrivals, tmp_path):
    """Row for row, whatever the batches are; rows without a time too."""
    every = []
    writer = judge(replay(*pieces(arrivals, 9, 10, 50, 90)), tmp_path, late.late_only(f"{tmp_path}/late"),
                   lambda df, n: every.extend(rows(df, "seq", "status", "watermark")))
    writer.start().awaitTermination()
    want = lateness.classify(arrivals, ["seq"], "et", SIZE, allowed=GRACE)
    assert rows(spark.read.parquet(f"{tmp_path}/late"), "seq", "window_end") == rows(want.where("status = 'late'"), "seq", "window_end")
    assert sorted(every, key=repr) == rows(want, "seq", "status", "watermark") and want.where("status = 'late'").count() > 5
    assert len(written(spark, f"{tmp_path}/latest", "batch")) == 2


@pytest.mark.parametrize("fold", [2, 32])
def test_merge_survives_failures(spark, replay, arrivals, tmp_path, fold):
    """A batch that fails after its totals were written runs again; the query then goes on from its checkpoint."""
    stream = replay(*pieces(arrivals, 20, 40, 60, 80, 100))
    totals = late.Totals(spark, f"{tmp_path}/totals", KEYS, FOLDS, fold)
    failing = {1, 3}
    seen = {}

    def fail(df, batch_id):
        if batch_id in failing:
            failing.remove(batch_id)
            raise RuntimeError("lost")

    def changed(df, batch_id):
        seen.update({(r.window_start, r.status): (r.n, r.total, r.low, r.high) for r in df.collect()})

    for _ in range(3):
        try:
            judge(stream, tmp_path, late.merging(totals, changed), fail).start().awaitTermination()
        except Exception as e:
            assert "lost" in str(e)
    judged = lateness.classify(arrivals, ["seq"], "et", SIZE, allowed=GRACE)
    want = judged.groupBy(*KEYS).agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.min("v").alias("low"), F.max("v").alias("high"))
    assert not failing and rows(totals.table(), *KEYS, "n", "total", "low", "high") == rows(want)
    assert seen == {(r.window_start, r.status): (r.n, r.total, r.low, r.high) for r in want.collect()}
    merged = late.by_status(totals.table(), KEYS[:2], "n")
    assert rows(merged) == rows(lateness.merge_late(judged))
    assert bool(written(spark, f"{tmp_path}/totals", "table")) == (fold == 2)


def test_a_stream_without_rows(spark, replay, arrivals, tmp_path):
    judge(replay(arrivals.limit(0), arrivals.limit(0)), tmp_path, late.late_only(f"{tmp_path}/late")).start().awaitTermination()
    judge(replay(arrivals.where("et is null"), arrivals.where("seq < 5")), tmp_path / "b", late.late_only(f"{tmp_path}/b/late")).start().awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/b/late").count() == lateness.classify(arrivals.where("seq < 5"), ["seq"], "et", SIZE, allowed=GRACE).where("status = 'late'").count()


def test_switch_goes_on_after_a_failure(spark, replay, tmp_path):
    """The setting is carried over batches, also those without control rows, and a batch that runs again sees what it saw before."""
    data = [(i, {3: "1", 9: "0", 10: "1", 22: "0"}.get(i)) for i in range(30)]
    df = spark.createDataFrame(data, "seq bigint, setting string")
    failing, seen = {1, 2}, {}

    def write(batch, batch_id):
        seen.update({r.seq: r.switch for r in batch.collect()})
        if batch_id in failing:
            failing.remove(batch_id)
            raise RuntimeError("lost")

    stream = replay(*pieces(df, 3, 8, 10, 20))
    for _ in range(3):
        try:
            (control.switched(stream, f"{tmp_path}/setting", "seq", F.col("setting").isNotNull(), F.col("setting"), write)
             .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination())
        except Exception as e:
            assert "lost" in str(e)
    want = alerts.switched(df, ["seq"], F.col("setting").isNotNull(), F.col("setting"))
    assert not failing and sorted(seen.items(), key=repr) == rows(want, "seq", "switch")
