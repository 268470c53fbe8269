"""Windows evaluated by triggers, and functions over whole windows, in streams and batch."""

import random
import time
from datetime import timedelta

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.spans import floor_time
from millrace.operators import distinct, windows
from millrace.plans.timed import _median
from millrace.streaming import triggers
from millrace.streaming import windows as stream
from samples import T0

SECOND = timedelta(seconds=1)
TEN = 10 * SECOND


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "2")


@pytest.fixture
def visits(spark):
    rng = random.Random(8)
    data = [(i, rng.choice("ab"), f"u{rng.randrange(9)}", T0 + i // 4 - rng.choice([0, 0, 1, 14]), rng.randrange(50)) for i in range(160)]
    return spark.createDataFrame(data, "seq bigint, k string, user string, s bigint, vc int").select("seq", "k", "user", F.timestamp_seconds("s").alias("et"), "vc")


def cut(df, *bounds):
    edges = [-1, *bounds, 10**6]
    return [df.where((F.col("seq") > a) & (F.col("seq") <= b)) for a, b in zip(edges, edges[1:])]


def ends(df):
    """Two rows far in the future, which close every window before them."""
    one = df.limit(1)
    return [one.withColumn("seq", F.lit(10_000 + i).cast("bigint")).withColumn("k", F.lit("end")).withColumn("et", F.timestamp_seconds(F.lit(T0 + 10_000 * (i + 1)))) for i in range(2)]


def test_fire_and_purge_at_every_row(spark, replay, drain, visits):
    """Equals the running distinct count of each window in batch, over several micro-batches."""
    def visitors(window, fresh):
        """Counts a row's visitor if the window hasn't seen them; the rows themselves are not kept."""
        for row in fresh:
            n = int(window.note("uv") or 0)
            if window.note(f"user {row['user']}") is None:
                window.write(f"user {row['user']}", "")
                window.write("uv", str(n := n + 1))
            yield row["seq"], n

    fed = replay(*cut(visits, 40, 41, 100))
    out = triggers.triggered(fed, [], "seq", "et", TEN, triggers.EachRow(), visitors, "seq bigint, uv bigint", ["user"])
    batch = distinct.running_distinct(visits.withColumn("w", floor_time("et", TEN)).select("seq", "user", "w"), "user", "seq", ["w"])
    assert rows(drain(out), "seq", "window_start", "uv") == rows(batch, "seq", "w", "uv")


@pytest.mark.parametrize("purge", [True, False])
def test_count_trigger(spark, replay, drain, visits, purge):
    total = lambda window, kept: [(window.count, sum(r["vc"] for r in kept))]
    out = triggers.triggered(replay(*cut(visits, 50, 90)), ["k"], "seq", "et", TEN, triggers.EveryRows(3, purge), total, "n int, total bigint", ["vc"])
    held, want = {}, []
    for r in visits.orderBy("seq").collect():
        window = held.setdefault((r.k, int(r.et.timestamp()) // 10), [0, []])
        window[0] += 1
        window[1].append(r.vc)
        if window[0] % 3 == 0:
            want.append((r.k, len(window[1]), sum(window[1])))
            if purge:
                window[1] = []
    assert rows(drain(out), "k", "n", "total") == sorted(want, key=repr)


def test_function_over_whole_windows_at_their_end(spark, replay, drain, visits):
    """Each row is in one result or comes out as late; on rows in time the results equal those of the batch form."""
    def median(window, kept):
        class Batch:  # the form that the batch function reads
            def column(self, name):
                return self

            def to_pylist(self):
                return [r["vc"] for r in kept]
        return _median(None, [Batch()])

    run = lambda df, parts: drain(triggers.triggered(stream.watermarked(replay(*parts, *ends(df)), "et"), ["k"], "seq", "et", TEN, triggers.AtEnd(), median,
                                                     "cnt bigint, median double", ["vc"])).where("k <> 'end'")
    in_time = visits.orderBy("et").withColumn("seq", F.row_number().over(Window.orderBy("et", "seq")).cast("bigint"))
    got = run(in_time, cut(in_time, 70, 120))
    want = windows.processed(visits, "et", TEN, ["k"], _median, "cnt bigint, median double")
    assert rows(got.where("late_seq is null"), "window_start", "k", "cnt", "median") == rows(want, "window_start", "k", "cnt", "median")
    assert got.where("late_seq is not null").count() == 0
    mixed = run(visits, cut(visits, 60, 61, 110, 140))
    late = {r.late_seq for r in mixed.collect() if r.late_seq is not None}
    assert late and mixed.agg(F.sum("cnt")).first()[0] + len(late) == visits.count()


def test_late_rows_within_grace_fire_again(spark, replay, drain):
    data = [(1, 1, 5), (2, 12, 7), (3, 3, 1), (4, 40, 0), (5, 4, 9)]
    df = spark.createDataFrame(data, "seq bigint, s bigint, vc int").select("seq", F.timestamp_seconds(F.col("s") + T0 // 10 * 10).alias("et"), "vc")
    fed = stream.watermarked(replay(*[df.where(F.col("seq") == i) for i in range(1, 6)]), "et")
    total = lambda window, kept: [(sum(r["vc"] for r in kept),)]
    out = triggers.triggered(fed, [], "seq", "et", TEN, triggers.AtEnd(TEN), total, "total bigint", ["vc"], TEN)
    got = rows(drain(out).where(F.col("window_start") == F.timestamp_seconds(F.lit(T0 // 10 * 10))), "total", "late_seq")
    assert got == [(5, None), (6, None), (None, 5)]


def test_wall_clock_trigger(spark, replay, visits, tmp_path):
    total = lambda window, kept: [(sum(1 for _ in kept),)]
    out = triggers.triggered(replay(visits), ["k"], "seq", "et", 1000 * SECOND, triggers.EveryInterval(timedelta(milliseconds=10)), total, "n bigint", ["vc"])
    query = (out.writeStream.format("memory").queryName("paced").outputMode("append").option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(processingTime="1 second").start())
    try:
        end = time.time() + 60
        while time.time() < end and spark.table("paced").count() < 2:
            time.sleep(1)
    finally:
        query.stop()
    assert sum(r.n for r in spark.table("paced").collect()) == 160


def test_whole_windows_come_in_batches(spark, visits):
    """A hot window is many times as large as a batch; the function sees them one by one."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        def shape(key, batches):
            sizes = [b.num_rows for b in batches]
            yield len(sizes), sum(sizes)

        hot = visits.select("seq", F.lit("hot").alias("k"), F.timestamp_seconds(F.lit(T0)).alias("et"), "vc").union(visits.limit(3).select("seq", "k", "et", "vc"))
        got = {r.k: (r.parts, r.n) for r in windows.processed(hot, "et", 3600 * SECOND, ["k"], shape, "parts int, n int").collect()}
        assert got["hot"][1] == 160 and got["hot"][0] >= 10
        want = windows.processed(visits, "et", TEN, ["k"], _median, "cnt bigint, median double")
        exact = visits.groupBy(F.window("et", "10 seconds"), "k").agg(F.count("*").alias("cnt"), F.expr("percentile(vc, 0.5)").alias("median"))
        assert rows(want, "window_start", "k", "cnt", "median") == rows(exact, "window.start", "k", "cnt", "median")
        assert windows.processed(visits.limit(0), "et", TEN, ["k"], _median, "cnt bigint, median double").count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_small_windows_share_a_batch(spark):
    """A window is a piece of a batch, or of several; what the function leaves unread is not taken for the next window."""
    data = [(k, T0 // 10 * 10 + 10 * w, v) for w in range(7) for k in ("a", None, "z") for v in range({"a": 1, None: 3, "z": 45}[k])]
    df = spark.createDataFrame(data, "k string, s bigint, vc int").select("k", F.timestamp_seconds("s").alias("et"), "vc").repartition(5)

    def whole(key, batches):
        pieces = [(b.column("vc").offset, b.num_rows) for b in batches]
        for _ in range(2 if key[2] == "a" else 1):
            yield pieces[0][0], len(pieces), sum(n for _, n in pieces)

    def some(key, batches):
        if key[2] is None:
            yield next(iter(batches)).num_rows > 0,
        elif key[2] == "a":
            yield True,

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        got = windows.processed(df, "et", TEN, ["k"], whole, "at int, parts int, n int").collect()
        begins = {(r.window_start, r.k): r for r in got}
        assert sorted((repr(r.k), r.n) for r in got) == sorted([("'a'", 1)] * 14 + [("None", 3)] * 7 + [("'z'", 45)] * 7)
        assert len(begins) == 21 and all(r.window_end - r.window_start == TEN for r in got)
        assert sum(r.at > 0 for r in begins.values()) >= 10  # of a batch that another window began
        assert any(r.parts > 1 for r in begins.values() if r.k == "z")
        left = windows.processed(df, "et", TEN, ["k"], some, "ok boolean").collect()
        assert sorted(map(repr, (r.k for r in left))) == ["'a'"] * 7 + ["None"] * 7 and len({(r.window_start, r.k) for r in left}) == 14
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
