"""Hand-checked results on small inputs."""

from datetime import timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.hashing import bit_offset
from millrace.operators import alerts, changelog, distinct, joins, lateness, patterns, transforms, windows
from millrace.operators.ordered import first, highest, lowest, ordered, previous, total
from millrace.operators.topn import top_n
from samples import T0, sensors

SECOND = timedelta(seconds=1)
AT = lambda s: F.timestamp_seconds(F.lit(T0 + s))


def since(column):
    return (F.unix_seconds(column) - T0).alias(str(column))


def test_word_count(spark):
    lines = spark.createDataFrame([("hello java",), ("hello scheme",), ("hello scala",), ("hello spark",), ("   ",), ("a  b ",)], "value string")
    counts = transforms.split_words(lines, "value").groupBy("word").count()
    assert rows(counts) == [("", 1), ("a", 1), ("b", 1), ("hello", 4), ("java", 1), ("scala", 1), ("scheme", 1), ("spark", 1)]


@pytest.mark.parametrize("bound", [1 << 18, 3])
def test_rolling(spark, bound):
    o = ordered(sensors(spark), ["id"], ["seq"], bound)
    o = o.running({"total": total("vc"), "top": highest("vc"), "low": lowest("vc"), "since": first("ts")})
    got = o.running({"before": previous("vc")}, exclusive=True).to_df().orderBy("seq").collect()
    assert [r["total"] for r in got] == [11, 32, 34, 36, 41, 47, 41, 8, 17]
    assert [r["top"] for r in got] == [11, 32, 23, 32, 32, 32, 23, 8, 9]
    assert [r["low"] for r in got] == [11, 32, 11, 4, 4, 4, 7, 8, 8]
    assert [r["since"] - T0 for r in got] == [122, 123, 122, 123, 123, 123, 122, 129, 129]
    assert [r["before"] for r in got] == [None, None, 11, 32, 4, 5, 23, None, 8]


def test_null_keys_and_values_when_split(spark):
    data = [(i, None if i % 3 == 0 else "k", None if i % 2 else i) for i in range(20)]
    df = spark.createDataFrame(data, "seq int, k string, v int")
    run = lambda bound: ordered(df, ["k"], ["seq"], bound).running({"t": total("v"), "f": first("v")}).running(
        {"p": previous("v")}, reverse=True, exclusive=True).to_df()
    assert rows(run(100), "seq", "k", "v", "t", "f", "p") == rows(run(2), "seq", "k", "v", "t", "f", "p")


def test_tags_and_side_output(spark):
    vc = F.col("vc")
    tagged = transforms.with_tags(sensors(spark), {"low": vc < 5, "middle": (vc >= 5) & (vc < 8), "high": vc >= 8, "hahaha": vc < 8})
    assert [r[0] for r in rows(transforms.tagged(tagged, "hahaha"), "seq")] == [4, 5, 6, 7]
    assert tagged.where("array_contains(tags, 'high')").count() == 5
    main, alarms = transforms.side_output(sensors(spark), vc > 5)
    assert (main.count(), alarms.count()) == (9, 7)


def test_accumulator_and_setup(spark):
    df, seen = transforms.counted(sensors(spark))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 9
    doubled = transforms.map_with_setup(sensors(spark).select("vc"), "vc bigint", lambda: 2, lambda k, b: b.assign(vc=b.vc * k))
    assert doubled.agg(F.sum("vc")).first()[0] == 210


def test_windows(spark):
    df = sensors(spark)
    five = windows.tumbling(df, "et", 5 * SECOND, ["id"], F.sum("vc").alias("t"))
    assert rows(five, since("window_start"), "id", "t") == [
        (120, "sensor_1", 34), (120, "sensor_2", 32), (125, "sensor_1", 7), (125, "sensor_2", 15), (125, "sensor_3", 8),
        (130, "sensor_3", 9)]
    gaps = windows.sessions(df, "et", 3 * SECOND, ["id"], {"t": ("sum", "vc")})
    assert rows(gaps, "id", since("window_start"), since("window_end"), "t") == [
        ("sensor_1", 122, 127, 34), ("sensor_1", 128, 131, 7), ("sensor_2", 123, 130, 47), ("sensor_3", 129, 133, 17)]
    assert rows(windows.count_tumbling(df, ["id"], ["seq"], 3, F.sum("vc").alias("t")), "id", "t") == [
        ("sensor_1", 41), ("sensor_2", 41)]
    slid = windows.count_sliding(df, ["id"], ["seq"], 5, 2, F.sum("vc").alias("t"), F.max("seq").alias("row"))
    assert rows(slid, "row", "t") == [(3, 34), (4, 36), (6, 47), (9, 17)]


def test_uneven_slide(spark):
    """A slide that does not divide the size, against a join with all windows."""
    df = sensors(spark)
    got = windows.sliding(df, "et", 5 * SECOND, 2 * SECOND, ["id"], {"t": ("sum", "vc"), "n": ("count", None)})
    starts = df.select(F.explode(F.sequence(AT(110), AT(140), F.expr("interval 2 seconds"))).alias("window_start")).distinct()
    inside = (F.col("et") >= F.col("window_start")) & (F.col("et") < F.col("window_start") + F.expr("interval 5 seconds"))
    want = df.join(starts, inside).groupBy("window_start", "id").agg(F.sum("vc").alias("t"), F.count(F.lit(1)).alias("n"))
    assert rows(got, "window_start", "id", "t", "n") == rows(want)


def test_sessions_that_touch_merge(spark):
    df = spark.createDataFrame([("a", 0), ("a", 3), ("a", 7)], "id string, s int").withColumn("et", AT(0) + F.expr("make_dt_interval(0,0,0,s)"))
    got = windows.sessions(df, "et", 3 * SECOND, ["id"], {"n": ("count", None)})
    assert rows(got, since("window_start"), since("window_end"), "n") == [(0, 6, 2), (7, 10, 1)]


def test_top_n(spark):
    counts = sensors(spark).groupBy("id").count().withColumn("g", F.lit(1))
    assert rows(top_n(counts, ["g"], [F.desc("count"), F.asc("id")], 2), "id", "rn") == [("sensor_1", 2), ("sensor_2", 1)]


def test_window_join(spark):
    make = lambda data, names: spark.createDataFrame(data, names).withColumn("et", F.timestamp_millis("ts")).drop("ts")
    left = make([("a", 111000), ("b", 112000), ("a", 113000), ("c", 114000), ("d", 115000)], "k string, ts bigint")
    right = make([("a", 111000, 1), ("a", 112000, 11), ("a", 113000, 111), ("b", 114000, 1111), ("e", 115000, 11111),
                  ("d", 116000, 111111), ("c", 117000, 1111111)], "k string, ts bigint, v int")
    got = joins.window_join(left, right, ["k"], "et", 3 * SECOND)
    assert rows(got, "k", F.unix_seconds("et").alias("l"), "v") == [
        ("a", 111, 1), ("a", 111, 11), ("a", 111, 111), ("a", 113, 1), ("a", 113, 11), ("a", 113, 111), ("d", 115, 111111)]


def test_interval_join_bounds_are_inclusive(spark, tight):
    left = spark.createDataFrame([("a", 100, i) for i in range(5)], "k string, s int, n int").withColumn("lt", F.timestamp_seconds("s"))
    right = spark.createDataFrame([("a", s) for s in (89, 90, 100, 110, 111)], "k string, r int").withColumn("rt", F.timestamp_seconds("r"))
    got = joins.interval_join(left, right, ["k"], "lt", "rt", -10 * SECOND, 10 * SECOND)
    assert rows(got, "n", "r") == sorted([(n, r) for n in range(5) for r in (90, 100, 110)], key=repr)


@pytest.mark.parametrize("values, expected", [([1, 3], [2]), ([1, None], []), ([], [1, 2, None]), ([None], [])])
def test_not_in(spark, values, expected):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    listed = spark.createDataFrame([(v,) for v in values], "y int")
    assert [r[0] for r in rows(joins.not_in(df, "x", listed))] == expected
    df.createOrReplaceTempView("t")
    listed.createOrReplaceTempView("l")
    assert [r[0] for r in rows(spark.sql("select * from t where x not in (select y from l)"))] == expected


def test_reconcile(spark):
    orders = spark.createDataFrame([("", 1), ("p", 2), ("q", 3), ("q", 4), ("z", 5)], "tx string, n int")
    receipts = spark.createDataFrame([("p", 1), ("q", 2), ("y", 3)], "tx string, n int")
    both = joins.reconcile(orders, receipts, "tx", "n", "n")
    assert rows(joins.matches(both), "tx", "left.n", "right.n") == [("p", 2, 1), ("q", 3, 2)]
    assert rows(joins.gaps(both)) == [("q", "left"), ("y", "right"), ("z", "left")]


def test_switch_defaults_to_off(spark):
    df = spark.createDataFrame([(1, None), (2, "1"), (3, None), (4, "0"), (5, None)], "seq int, s string")
    for bound in (100, 2):
        got = alerts.switched(df, ["seq"], F.col("s").isNotNull(), F.col("s"), bound)
        assert rows(got, "seq", "switch") == [(1, "off"), (3, "on"), (5, "off")]


def test_click_limit(spark):
    clicks = spark.range(121).select("id", F.lit(7).alias("user"), AT(0).alias("et")).unionByName(
        spark.range(500, 503).select("id", F.lit(8).alias("user"), AT(0).alias("et")))
    limited = alerts.click_limit(clicks, ["user"], "et", [F.asc("id")])
    assert alerts.clicks_passed(limited).count() == 103
    assert rows(alerts.click_alarms(limited), "user", "id") == [(7, 100)]


def test_payment_status(spark):
    data = [("a", "create", 0), ("a", "pay", 899), ("b", "create", 0), ("b", "pay", 900), ("c", "create", 0), ("d", "pay", 5)]
    df = spark.createDataFrame(data, "id string, kind string, s int").withColumn("et", F.timestamp_seconds("s"))
    got = alerts.payment_status(df, ["id"], "et", F.col("kind") == "create", F.col("kind") == "pay", timedelta(minutes=15))
    assert rows(got, "id", "status") == [("a", "normal"), ("b", "late_paid"), ("c", "timeout"), ("d", "missing_create")]


@pytest.mark.parametrize("bound", [1 << 18, 2])
def test_rising(spark, bound):
    data = [(0, 1), (1, 1), (2, 2), (3, 2), (4, 3), (5, 3), (6, 1), (7, 2), (20, 5), (21, 4)]
    df = spark.createDataFrame([(i, "a", s, v) for i, (s, v) in enumerate(data)], "seq int, id string, s int, v int")
    got = alerts.rising_alerts(df.withColumn("et", AT(0) + F.expr("make_dt_interval(0,0,0,s)")), ["id"], ["et", "seq"],
                               "et", "v", 2 * SECOND, bound)
    # starts at 0, 3; the fall at 6 comes after 5; 7 starts anew; the fall at 21 cancels 20.
    assert rows(got, since("start_ts"), since("fire_ts")) == [(0, 2), (3, 5), (7, 9)]


def test_rising_in_one_long_run(spark):
    """A level that never falls: the timers are chained through all chunks."""
    steps = [0, 1, 1, 4, 5, 5, 6, 9, 11, 12, 12, 12, 15, 17, 20, 21, 23, 24, 24, 27, 30, 31, 33, 35]
    df = spark.createDataFrame([(i, "a", s, 5) for i, s in enumerate(steps)], "seq int, id string, s int, v int").withColumn(
        "et", AT(0) + F.expr("make_dt_interval(0,0,0,s)"))
    want, timer = [], -1
    for s in steps:
        if s > timer:
            want.append((s, s + 3))
            timer = s + 3
    for bound in (100, 4):
        got = alerts.rising_alerts(df, ["id"], ["et", "seq"], "et", "v", 3 * SECOND, bound)
        assert rows(got, since("start_ts"), since("fire_ts")) == sorted(want, key=repr)


def test_lateness(spark):
    df = spark.createDataFrame([(1, 1), (2, 4), (3, 5), (4, 2), (5, 7), (6, 3), (7, 9), (8, 4)], "seq int, s int").withColumn(
        "et", AT(0) + F.expr("make_dt_interval(0,0,0,s)"))
    for bound in (100, 3):
        got = lateness.classify(df, ["seq"], "et", 5 * SECOND, allowed=2 * SECOND, max_rows=bound)
        # the window of second 0 fires once 5 has arrived and closes once 7 has.
        assert [r[0] for r in rows(got.where("status = 'refire'"), "seq")] == [4]
        assert [r[0] for r in rows(got.where("status = 'late'"), "seq")] == [6, 8]
    merged = lateness.merge_late(got)
    assert rows(merged, "on_time", "refired", "late", "merged") == [(2, 1, 2, 5), (3, 0, 0, 3)]
    sliding = lateness.classify(df, ["seq"], "et", 10 * SECOND, slide=5 * SECOND)
    assert sliding.where("status <> 'on_time'").isEmpty()
    punctuated = lateness.classify(df, ["seq"], "et", 5 * SECOND, tick=timedelta(0))
    assert punctuated.where("seq = 4 and status = 'late'").count() == 1


def test_sequence(spark):
    login = spark.createDataFrame([(1, 1035, "fail", 842), (2, 1035, "success", 844), (3, 1035, "fail", 843), (4, 7, "fail", 850),
                                   (5, 7, "fail", 852)], "seq int, user int, kind string, s int").withColumn("et", F.timestamp_seconds("s"))
    fail = F.col("kind") == "fail"
    got = patterns.match_sequence(login, ["user"], ["et", "seq"], fail, [patterns.next_("again", fail)], "et", 2 * SECOND)
    assert rows(got.where("matched"), "start.user", "start.s", "again.s") == [(1035, 842, 843)]
    assert rows(got.where("timed_out"), "start.user", "start.s") == [(7, 850), (7, 852)]
    pairs = patterns.match_any_later(sensors(spark), ["id"], ["et", "seq"], F.col("id") == "sensor_1",
                                     F.col("id") == "sensor_1", "et", timedelta(days=1))
    assert rows(pairs, "start.seq", "later.seq") == [(1, 3), (1, 7), (3, 7)]
    runs = patterns.match_times(sensors(spark), ["id"], ["et", "seq"], F.col("id") == "sensor_2", 3, 4)
    assert rows(runs, "times", F.transform("events", lambda e: e["seq"]).alias("e")) == [(3, [2, 4, 5]), (3, [4, 5, 6]), (4, [2, 4, 5, 6])]
    found = patterns.match_sequence(sensors(spark), ["id"], ["et", "seq"], F.col("vc") == 32, [patterns.next_("n", F.col("vc") == 4)])
    assert patterns.as_match_map(found, ["start", "n"]).first()["match"]["n"][0]["vc"] == 4
    with pytest.raises(ValueError):
        patterns.match_sequence(sensors(spark), ["id"], ["seq"], fail, [patterns.not_followed_by("x", fail)])


def test_changes_and_distinct(spark):
    log = changelog.count_changes(sensors(spark).where("id = 'sensor_3'"), ["id"], "seq")
    assert rows(log, "seq", "is_add", "cnt") == [(8, True, 1), (9, False, 1), (9, True, 2)]
    for bound in (100, 2):
        uv = distinct.running_distinct(sensors(spark), "id", "seq", max_rows=bound)
        assert [r[1] for r in rows(uv, "seq", "uv")] == [1, 2, 2, 2, 2, 2, 2, 3, 3]


def test_bit_offset(spark):
    def expected(text):
        h = 0
        for c in text:
            h = h * 61 + ord(c)
        return h % (1 << 33)

    words = ["", "7", "543462", "a long text that overflows 64 bits many times"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(bit_offset(F.col("w"))).collect()
    assert [r[0] for r in got] == [expected(w) for w in words]
