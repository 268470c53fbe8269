import time
from datetime import timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import alerts, changelog, distinct, joins, patterns, windows
from millrace.operators.ordered import count, highest, ordered, previous, total
from millrace.streaming import stateful
from millrace.streaming import windows as stream
from samples import T0, sensors

SECOND = timedelta(seconds=1)


def pieces(df, *bounds):
    """Cut by arrival number; the last piece is a row far in the future that moves the watermark."""
    edges = [0, *bounds, 10**9]
    return [df.where((F.col("seq") > a) & (F.col("seq") <= b)) for a, b in zip(edges, edges[1:])]


def with_end(df, **values):
    """The same frame and two sentinel rows, the second later than the first."""
    spark = df.sparkSession
    ends = [[values.get(f.name) for f in df.schema] for _ in range(2)]
    frames = []
    for i, end in enumerate(ends):
        end = spark.createDataFrame([end], df.schema)
        frames.append(end.withColumn("seq", F.lit(1000 + i).cast("bigint")).withColumn(
            "et", F.timestamp_seconds(F.lit(T0 + 100_000 * (i + 1)))))
    return frames


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "2")


@pytest.fixture
def short(spark, replay):
    """The sensor rows in two micro-batches, without an end."""
    return replay(*pieces(sensors(spark), 4))


@pytest.fixture
def feed(spark, replay):
    df = sensors(spark)
    return replay(*pieces(df, 4), *with_end(df, id="end", ts=0, vc=0))


def only(df):
    return df.where("id <> 'end'")


def test_rolling(spark, short, drain):
    columns = {"total": ("sum", "vc"), "top": ("max", "vc"), "n": ("count", None), "before": ("previous", "vc")}
    got = only(drain(stateful.rolling(short, ["id"], "seq", columns)))
    rolled = ordered(sensors(spark), ["id"], ["seq"]).running({"total": total("vc"), "top": highest("vc"), "n": count()})
    want = rolled.running({"before": previous("vc")}, exclusive=True).to_df()
    assert rows(got, "seq", "id", "total", "top", "n", "before") == rows(want, "seq", "id", "total", "top", "n", "before")


def test_rolling_reduce(short, drain):
    out = stateful.rolling_reduce(short, ["id"], "seq", ["ts", "vc"], lambda a, b: (a[0], a[1] + b[1]))
    got = rows(only(drain(out)), "seq", "vc")
    assert [v for _, v in got] == [11, 32, 34, 36, 41, 47, 41, 8, 17]


def test_running_distinct(spark, short, drain):
    df = sensors(spark).withColumn("half", F.col("vc") % 2)
    got = only(drain(stateful.running_distinct(short.withColumn("half", F.col("vc") % 2), ["id"], "seq", "half")))
    want = distinct.running_distinct(df, "half", "seq", ["id"])
    assert rows(got, "seq", "uv") == rows(want, "seq", "uv")


def test_count_windows(spark, short, drain):
    got = drain(stateful.count_windows(short, ["id"], "seq", "vc", 5, 2)).where("id <> 'end'")
    want = windows.count_sliding(sensors(spark), ["id"], ["seq"], 5, 2, F.sum("vc").alias("total"))
    assert rows(got, "id", "fired_at", "total") == rows(want, "id", "fired_at", "total")
    tumbled = drain(stateful.count_windows(short, ["id"], "seq", "vc", 3)).where("id <> 'end'")
    assert rows(tumbled, "id", "total") == [("sensor_1", 41), ("sensor_2", 41)]


def test_count_changes(spark, short, drain):
    got = only(drain(stateful.count_changes(short, ["id"], "seq")))
    want = changelog.count_changes(sensors(spark), ["id"], "seq")
    assert rows(got, "seq", "id", "is_add", "cnt") == rows(want, "seq", "id", "is_add", "cnt")


def test_rising_alerts(spark, feed, drain):
    hold = 2 * SECOND
    got = only(drain(stateful.rising_alerts(stream.watermarked(feed, "et"), ["id"], "seq", "et", "vc", hold)))
    want = alerts.rising_alerts(sensors(spark), ["id"], ["et", "seq"], "et", "vc", hold)
    want = want.select("id", F.unix_millis("start_ts").alias("start_at"), F.unix_millis("fire_ts").alias("fire_at"))
    assert rows(got, "id", "start_at", "fire_at") == rows(want)
    assert want.count() == 3


@pytest.mark.parametrize("how", ["next", "guarded", "not_next"])
def test_matcher_equals_batch(spark, feed, drain, how):
    odd, low = F.col("vc") % 2 == 1, F.col("vc") < 10
    steps = {"next": [patterns.next_("b", low)],
             "guarded": [patterns.not_followed_by("no", F.col("vc") == 4), patterns.followed_by("b", F.col("vc") < 7)],
             "not_next": [patterns.not_next("no", low), patterns.followed_by("b", F.col("vc") > 6)]}[how]
    start = odd | (F.col("vc") == 32)
    fed = stream.watermarked(feed, "et")
    got = only(drain(stateful.match_sequence(fed, ["id"], "seq", "et", start, steps, 4 * SECOND)))
    shown = lambda df, event: df.select(F.get_json_object(event, "$.seq").cast("bigint").alias("a"))
    got = got.select("matched", *[F.get_json_object(F.get("events", F.lit(i)), "$.seq").cast("bigint").alias(f"s{i}")
                                  for i in (0, 1)])
    want = patterns.match_sequence(sensors(spark), ["id"], ["et", "seq"], start, steps, "et", 4 * SECOND)
    want = want.where("matched or timed_out").select(
        "matched", F.col("start.seq").alias("s0"), F.when(F.col("matched"), F.col("b.seq")).alias("s1"))
    assert rows(got) == rows(want)
    assert want.where("matched").count() > 0


def test_switch(spark, replay, drain):
    main = spark.createDataFrame([(i,) for i in (1, 3, 5, 7)], "seq bigint")
    control = spark.createDataFrame([(2, "1"), (6, "0")], "seq bigint, setting string")
    both = main.withColumn("setting", F.lit(None).cast("string")).unionByName(control)
    fed = replay(both.where("seq < 4"), both.where("seq >= 4"))
    out = stateful.switched(fed.where("setting is null"), fed.where("setting is not null"), "seq", "setting", 4)
    assert rows(drain(out)) == [(1, "off"), (3, "on"), (5, "on"), (7, "off")]
    batch = alerts.switched(both, ["seq"], F.col("setting").isNotNull(), F.col("setting"))
    assert rows(batch, "seq", "switch") == [(1, "off"), (3, "on"), (5, "on"), (7, "off")]


def test_reconcile(spark, replay, drain):
    orders = spark.createDataFrame([("a", 1), ("b", 2), ("", 3), ("c", 6)], "tx string, seq bigint")
    receipts = spark.createDataFrame([("b", 1), ("a", 4), ("d", 5), ("c", 7)], "tx string, seq bigint")
    out = stateful.reconcile(replay(orders.where("seq < 3"), orders.where("seq >= 3")),
                             replay(receipts.where("seq < 3"), receipts.where("seq >= 3")), "tx", "seq", "seq")
    batch = joins.matches(joins.reconcile(orders, receipts, "tx", "seq", "seq"))
    assert [r[0] for r in rows(drain(out), "key")] == [r[0] for r in rows(batch, "tx")] == ["a", "b", "c"]


def test_click_limit(spark, feed, drain):
    fed = stream.watermarked(feed, "et")
    got = only(drain(stateful.click_limit(fed, ["id"], "seq", "et", 2)))
    limited = alerts.click_limit(sensors(spark), ["id"], "et", [F.asc("seq")], 2)
    assert rows(got.where("kind = 'pass'"), "seq") == rows(alerts.clicks_passed(limited, 2), "seq")
    assert rows(got.where("kind = 'alarm'"), "seq") == rows(alerts.click_alarms(limited, 2), "seq") == [(5,), (7,)]


def test_payment_timer(spark, replay, drain):
    data = [(1, "a", "create", 0), (2, "b", "create", 1), (3, "a", "pay", 5), (4, "c", "pay", 6), (5, "d", "create", 7),
            (6, "d", "pay", 20)]
    df = spark.createDataFrame(data, "seq bigint, id string, kind string, ts bigint").withColumn(
        "et", F.timestamp_seconds(F.col("ts") + T0))
    fed = stream.watermarked(replay(df, *with_end(df, id="end", kind="pay", ts=0)), "et")
    out = drain(stateful.payment_timer(fed, ["id"], "seq", "et", F.col("kind") == "create", 10 * SECOND))
    batch = alerts.payment_status(df, ["id"], "et", F.col("kind") == "create", F.col("kind") == "pay", 10 * SECOND)
    assert rows(only(out), "id", "status") == rows(batch, "id", "status") == [
        ("a", "normal"), ("b", "timeout"), ("c", "missing_create"), ("d", "late_paid")]


def test_timers(feed, drain):
    fed = stream.watermarked(feed, "et")
    out = stateful.with_context(fed, ["id"], "seq", "et", F.col("vc") == 23, 3 * SECOND)
    fired = rows(only(drain(out)).where("kind = 'timer'"), "id", (F.col("at") / 1000 - T0).cast("int"))
    # sensor_1 starts at 122, cancels at 124 and starts again at 128.
    assert ("sensor_1", 125) not in fired
    assert {("sensor_1", 131), ("sensor_3", 132)} <= set(fired)
    seen = only(drain(out)).where("kind = 'row'")
    assert seen.count() == 9 and seen.agg(F.max("watermark")).first()[0] > 0


def test_processing_timer(spark, short, tmp_path):
    out = stateful.with_context(short, ["id"], "seq", "et", F.lit(False), timedelta(milliseconds=1), by_event_time=False)
    query = (out.writeStream.format("memory").queryName("clock").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start())
    try:
        end = time.time() + 60
        while time.time() < end and spark.table("clock").where("kind = 'timer'").isEmpty():
            time.sleep(1)
    finally:
        query.stop()
    got = spark.table("clock")
    assert got.where("kind = 'row'").count() > 0
    assert got.where("kind = 'timer'").count() > 0


def test_event_time_windows(spark, feed, drain):
    fed = stream.watermarked(feed, "et")
    five = 5 * SECOND
    got = only(drain(stream.windowed(fed, "et", five, ["id"], F.sum("vc").alias("total"))))
    assert rows(got) == rows(windows.tumbling(sensors(spark), "et", five, ["id"], F.sum("vc").alias("total")))
    got = only(drain(stream.windowed(fed, "et", five, ["id"], F.sum("vc").alias("total"), slide=SECOND)))
    assert rows(got) == rows(windows.sliding(sensors(spark), "et", five, SECOND, ["id"], {"total": ("sum", "vc")}))
    got = only(drain(stream.sessions(fed, "et", 3 * SECOND, ["id"], F.sum("vc").alias("total"))))
    assert rows(got) == rows(windows.sessions(sensors(spark), "et", 3 * SECOND, ["id"], {"total": ("sum", "vc")}))


def test_refire_in_update_mode(spark, replay, drain):
    df = spark.createDataFrame([(1, 101), (2, 108), (3, 103)], "seq bigint, s bigint").withColumn("et", F.timestamp_seconds("s"))
    fed = stream.watermarked(replay(*[df.where(F.col("seq") == i) for i in (1, 2, 3)]), "et", SECOND, 10 * SECOND)
    got = drain(stream.windowed(fed, "et", 5 * SECOND, [], F.count(F.lit(1)).alias("n")), "update")
    assert rows(got.where(F.col("window_start") == F.timestamp_seconds(F.lit(100))), "n") == [(1,), (2,)]


def test_distinct_and_top_n(spark, feed, drain, tmp_path):
    fed = stream.watermarked(feed, "et")
    got = drain(stream.distinct_per_window(fed, "et", 5 * SECOND, "id"))
    want = distinct.distinct_per_window(sensors(spark), "et", 5 * SECOND, "id")
    assert set(rows(want)) <= set(rows(got))
    approx = drain(stream.approx_per_window(fed, "et", 5 * SECOND, "id"))
    assert set(rows(want)) <= set(rows(approx))
    counts = stream.windowed(fed, "et", 5 * SECOND, ["id"], F.count(F.lit(1)).alias("cnt"))
    path = str(tmp_path / "top")
    query = stream.top_n_writer(counts, lambda: [F.desc("cnt"), F.asc("id")], 1,
                                lambda df, n: df.write.mode("overwrite").parquet(f"{path}/batch={n}")).trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination()
    best = spark.read.parquet(path).where("id <> 'end'")
    assert rows(best, "id", "cnt") == [("sensor_1", 2), ("sensor_2", 3), ("sensor_3", 1)]


def test_joins(spark, replay, drain):
    left = spark.createDataFrame([(1, "a", 100), (2, "b", 200), (3, "a", 300)], "seq bigint, k string, s bigint").withColumn(
        "et", F.timestamp_seconds("s")).drop("s")
    right = left.select("k", F.col("seq").alias("rseq"), (F.col("et") + F.expr("interval 2 seconds")).alias("rt"))
    fed = lambda df, ts: stream.watermarked(replay(df), ts)
    pairs = stream.interval_join(fed(left, "et"), fed(right, "rt"), ["k"], "et", "rt", -5 * SECOND, 5 * SECOND)
    want = joins.interval_join(left, right, ["k"], "et", "rt", -5 * SECOND, 5 * SECOND)
    assert rows(drain(pairs), "seq", "rseq") == rows(want, "seq", "rseq") == [(1, 1), (2, 2), (3, 3)]
    same = right.withColumnRenamed("rt", "et")
    joined = stream.window_join(fed(left, "et"), fed(same, "et"), ["k"], "et", 10 * SECOND)
    assert rows(drain(joined), "seq", "rseq") == rows(joins.window_join(left, same, ["k"], "et", 10 * SECOND), "seq", "rseq")


def test_restart_keeps_state(spark, tmp_path, drain):
    df = sensors(spark)
    folder, checkpoint = tmp_path / "src", str(tmp_path / "cp")
    reader = lambda: spark.readStream.schema(df.schema).parquet(str(folder))
    out = lambda: stateful.rolling(reader(), ["id"], "seq", {"total": ("sum", "vc")})
    target = str(tmp_path / "out")

    def run():
        (out().writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())

    df.where("seq <= 4").write.mode("append").parquet(str(folder))
    run()
    df.where("seq > 4").write.mode("append").parquet(str(folder))
    run()
    assert [t for _, t in rows(spark.read.parquet(target), "seq", "total")] == [11, 32, 34, 36, 41, 47, 41, 8, 17]


def test_side_outputs_from_one_batch(spark, feed, tmp_path):
    main, alarm = str(tmp_path / "main"), str(tmp_path / "alarm")
    save = lambda path, keep: lambda df, n: df.where(keep).write.mode("append").parquet(path)
    stream.per_batch(feed, save(main, "true"), save(alarm, "vc > 5")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(main).where("id <> 'end'").count() == 9
    assert spark.read.parquet(alarm).where("id <> 'end'").count() == 7


def test_wall_clock_windows(feed, drain):
    timed = stream.arrival_time(feed).withWatermark("arrived", "0 seconds")
    got = drain(stream.windowed(timed, "arrived", 3600 * SECOND, [], F.count(F.lit(1)).alias("n")), "update")
    assert got.agg(F.max("n")).first()[0] >= 9
