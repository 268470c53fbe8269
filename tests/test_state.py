"""State of streams: late rows, order within a key, expiry, counted steps and rules without keys."""

import time
from datetime import timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import alerts, patterns
from millrace.streaming import stateful
from millrace.streaming import windows as stream
from samples import T0, sensors

SECOND = timedelta(seconds=1)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "2")


def frame(spark, data):
    """(seq, id, microseconds, vc); two rows of another key end the stream."""
    df = spark.createDataFrame(data, "seq bigint, id string, us bigint, vc int")
    return df.select("seq", "id", F.timestamp_micros(F.lit(T0 * 1_000_000) + F.col("us")).alias("et"), "vc")


def ends(spark):
    return [frame(spark, [(10**6 + i, "end", 10**12 * (i + 1), 0)]) for i in range(2)]


def events(df):
    return df.select(F.transform("events", lambda e: F.get_json_object(e, "$.seq").cast("bigint")).alias("seqs"))


def test_late_rows_come_out(spark, replay, drain):
    """Rows behind the watermark are in the output, the others in the alerts; nothing is lost and nothing changes by them."""
    data = [(1, "a", 1_000_000, 1), (2, "a", 9_000_000, 2), (3, "a", 2_000_000, 9), (4, "b", 9_500_000, 3), (5, "a", 12_000_000, 4)]
    df = frame(spark, data)
    fed = stream.watermarked(replay(df.where("seq <= 2"), df.where("seq > 2"), *ends(spark)), "et")
    got = drain(stateful.rising_alerts(fed, ["id"], "seq", "et", "vc", 3 * SECOND)).where("id <> 'end'")
    assert rows(got.where("late_seq is not null"), "id", "late_seq") == [("a", 3)]
    want = alerts.rising_alerts(df.where("seq <> 3"), ["id"], ["et", "seq"], "et", "vc", 3 * SECOND)
    assert rows(got.where("late_seq is null"), "id", "start_ts", "fire_ts") == rows(want)


def test_microseconds_decide(spark, replay, drain):
    """Order and bounds below a millisecond are those of the batch rules."""
    data = [(1, "a", 10, 1), (2, "a", 5, 2), (3, "a", 1_000_010, 4), (4, "b", 0, 1), (5, "b", 999_999, 2), (6, "b", 1_000_001, 4)]
    df = frame(spark, data)
    fed = lambda: stream.watermarked(replay(df, *ends(spark)), "et")
    steps = [patterns.followed_by("later", F.col("vc") == 4)]
    start = F.col("vc") < 3
    got = drain(stateful.match_sequence(fed(), ["id"], "seq", "et", start, steps, SECOND)).where("id <> 'end' and matched")
    want = patterns.match_sequence(df, ["id"], ["et", "seq"], start, steps, "et", SECOND).where("matched")
    assert sorted(r.seqs for r in events(got).collect()) == sorted([r.a, r.b] for r in want.select(F.col("start.seq").alias("a"), F.col("later.seq").alias("b")).collect()) == [[5, 6]]
    status = drain(stateful.payment_timer(fed().where("seq in (1, 3, 4, 5) or id = 'end'"), ["id"], "seq", "et", F.col("seq").isin(1, 4), SECOND)).where("id <> 'end'")
    assert rows(status, "id", "status") == [("a", "late_paid"), ("b", "normal")]


@pytest.mark.parametrize("keys", [["id"], []])
def test_counted_steps_equal_batch(spark, replay, drain, keys):
    df = sensors(spark)
    fed = stream.watermarked(replay(df.where("seq <= 4"), df.where("seq > 4"), *[e.select("seq", "id", (F.col("et")).alias("et"), "vc").withColumn("ts", F.lit(0).cast("bigint")).select(*df.columns) for e in ends(spark)]), "et")
    fits = F.col("vc") > 5
    out = drain(stateful.match_times(fed, keys, "seq", "et", fits, 2, 3, 8 * SECOND))
    want = patterns.match_times(df, keys, ["et", "seq"], fits, 2, 3, "et", 8 * SECOND).withColumn("seqs", F.col("events.seq"))
    assert want.count() > 2
    got = out.withColumn("seqs", F.transform("events", lambda e: F.get_json_object(e, "$.seq").cast("bigint")))
    assert rows(got, *keys, "start_no", "times", "seqs") == rows(want, *keys, "start_no", "times", "seqs")


def test_a_rule_without_keys(spark, replay, drain):
    df = frame(spark, [(i, "ab"[i % 2], 1_000_000 * i, i) for i in range(1, 8)])
    steps = [patterns.next_("b", F.col("vc") % 3 == 0)]
    fed = stream.watermarked(replay(df.where("seq < 4"), df.where("seq >= 4"), *ends(spark)), "et")
    got = drain(stateful.match_sequence(fed, [], "seq", "et", F.col("vc") % 3 == 2, steps)).where("matched")
    want = patterns.match_sequence(df, [], ["et", "seq"], F.col("vc") % 3 == 2, steps).where("matched")
    assert sorted(r.seqs for r in events(got).collect()) == [[2, 3], [5, 6]] and want.count() == 2


def test_many_rows_of_one_key(spark, replay, drain):
    """All rows of a key wait, and all are due at once; each stretch of time is read and dropped once."""
    n = 5_000
    data = spark.range(n).select(F.col("id").alias("seq"), F.lit("a").alias("id"), F.timestamp_micros(F.lit(T0 * 1_000_000) + F.col("id") * 50_000).alias("et"), F.col("id").cast("int").alias("vc"))
    fed = stream.watermarked(replay(data, *ends(spark)), "et")
    got = drain(stateful.rising_alerts(fed, ["id"], "seq", "et", "vc", 10 * SECOND)).where("id = 'a'")
    want = alerts.rising_alerts(data, ["id"], ["et", "seq"], "et", "vc", 10 * SECOND)
    assert rows(got, "start_ts", "fire_ts") == rows(want, "start_ts", "fire_ts") and want.count() > 20


def test_event_time_expiry(spark, replay, drain):
    """A key that was silent for the time to live starts anew: the fall against its last value is no longer known."""
    data = [(1, "a", 0, 9), (2, "z", 100_000_000, 0), (3, "z", 101_000_000, 0), (4, "a", 102_000_000, 5), (5, "a", 104_000_000, 6)]
    df = frame(spark, data)
    fed = lambda: stream.watermarked(replay(*[df.where(F.col("seq") == i) for i in range(1, 6)], *ends(spark)), "et")
    start_of = lambda ttl: {int(r.start_at / 1000 - T0) for r in drain(stateful.rising_alerts(fed(), ["id"], "seq", "et", "vc", SECOND, ttl)).where("id = 'a' and late_seq is null").collect()}
    assert start_of(None) == {0, 104} and start_of(10 * SECOND) == {0, 102, 104}


def test_expired_state_is_gone_after_a_restart(spark, tmp_path):
    df = sensors(spark)
    folder, checkpoint, target = str(tmp_path / "src"), str(tmp_path / "cp"), str(tmp_path / "out")

    def run():
        reader = spark.readStream.schema(df.schema).parquet(folder)
        rolled = stateful.rolling(reader, ["id"], "seq", {"total": ("sum", "vc")}, timedelta(milliseconds=1500))
        writer = rolled.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        query = writer.trigger(once=True).start()  # with the clock's timers a query has no last batch
        assert query.awaitTermination(90)

    df.where("seq <= 4").write.mode("append").parquet(folder)
    run()
    time.sleep(2)
    df.where("seq > 4").write.mode("append").parquet(folder)
    run()
    totals = dict(rows(spark.read.parquet(target), "seq", "total"))
    first = {r.id: 0 for r in df.collect()}
    want = {}
    for part in ("seq <= 4", "seq > 4"):
        sums = dict(first)
        for r in df.where(part).orderBy("seq").collect():
            sums[r.id] += r.vc
            want[r.seq] = sums[r.id]
    assert totals == want
