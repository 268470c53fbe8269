"""Events with an unknown type, null types, ids and times, in a folder of several files: every row-keeping query still equals its SQL."""

import duckdb
import pytest
from conftest import DATA
from pyspark.sql import functions as F
from test_queries import canonical

import __spark_entry__ as driver

NAMES = ["cep_next", "cep_not_next", "cep_followed_by", "cep_not_followed_by", "cep_three_steps", "cep_match_map", "cep_global", "over_count_desc",
         "per_row_trigger", "window_running_count", "lateness_classify", "late_rows", "late_merge", "blacklist_pass", "blacklist_alarm", "stream_pv_hourly"]


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("awkward"))
    events = spark.read.parquet(f"{DATA}/sf0.001/events.parquet").orderBy("event_id")
    at = lambda n, k: F.col("event_id") % n == k
    odd = (events.withColumn("event_type", F.when(at(7, 3), "hover").when(at(41, 5), None).otherwise(F.col("event_type")))
           .withColumn("user_id", F.when(at(53, 7), None).otherwise(F.col("user_id"))).withColumn("ts", F.when(at(59, 11), None).otherwise(F.col("ts"))))
    odd.repartition(5, "event_id").write.parquet(f"{folder}/events.parquet")
    duck = duckdb.connect()
    duck.sql(f"create view events as select * from '{folder}/events.parquet/*.parquet'")
    return folder, duck


@pytest.mark.parametrize("name", NAMES)
def test_equals_its_sql(spark, awkward, name):
    folder, duck = awkward
    got, want = driver.queries()[name](spark, folder), duck.sql(driver.oracle_sql()[name])
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical(want.columns, want.fetchall())


def test_separators(spark):
    from millrace.operators.transforms import split_words
    from millrace.sources.lines import parse_csv

    for sep in ("|", "||", "^", ",", " ", ".", "\\", "]", "\t"):
        line = sep.join(["a1", "b2", "c3"])
        df = spark.createDataFrame([(line,)], "value string")
        assert [r.word for r in split_words(df, "value", sep=sep).collect()] == ["a1", "b2", "c3"]
        assert tuple(parse_csv(df, {"x": "string", "y": "string", "z": "string"}, sep).first()) == ("a1", "b2", "c3")


def test_streams_keep_fractions(spark, replay, drain):
    from millrace.streaming import stateful

    rows = spark.createDataFrame([(1, "k", 1.9), (2, "k", 1.9), (3, "k", 1.9)], "seq bigint, id string, v double")
    got = drain(stateful.count_windows(replay(rows), ["id"], "seq", "v", 3)).collect()
    assert [round(r.total, 6) for r in got] == [5.7]
    got = drain(stateful.rolling(replay(rows), ["id"], "seq", {"s": ("sum", "v")})).orderBy("seq").collect()
    assert [round(r.s, 6) for r in got] == [1.9, 3.8, 5.7]


def test_stream_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{DATA}/sf0.001/events.parquet").limit(0).write.parquet(str(tmp_path / "events.parquet"))
    assert driver.queries()["stream_pv_hourly"](spark, str(tmp_path)).collect() == []


def test_reconcile_by_arrival(spark, tight):
    """Against a keyed cache that takes one row at a time."""
    import random

    from millrace.operators import joins

    rng = random.Random(8)
    cases = {"a": "LRLR", "b": "LRR", "c": "LLR", "d": "R", "e": "LLLRRRLLRLRRL"} | {f"k{i}": "".join(rng.choice("LR") for _ in range(rng.randrange(1, 30))) for i in range(25)}
    rows = [(k, n, side) for k, sides in cases.items() for n, side in enumerate(sides)] + [("", 1, "L"), (None, 2, "R")]
    want, waits = [], []
    for k, sides in cases.items():
        held = None
        for n, side in enumerate(sides):
            if held and held[0] != side:
                want.append((k, *((held[1], n) if held[0] == "L" else (n, held[1]))))
                held = None
            else:
                held = (side, n)
        if held:
            waits.append((k, "left" if held[0] == "L" else "right"))
    side = lambda s: spark.createDataFrame([(k, n) for k, n, x in rows if x == s], "k string, n bigint")
    got = joins.reconcile(side("L"), side("R"), "k", "n", "n")
    assert sorted((r.k, r.left.n, r.right.n) for r in joins.matches(got).collect()) == sorted(want)
    assert sorted(tuple(r) for r in joins.gaps(got).collect()) == sorted(waits)


def test_large_keys_stay_exact(spark):
    from datetime import timedelta

    from millrace.operators.alerts import rising_alerts
    from millrace.operators.udaf import aggregate_with

    class Rows:
        accumulator_schema = result_schema = "n bigint"
        create = staticmethod(lambda: (0,))
        add = staticmethod(lambda held, rows: (held[0] + len(rows),))
        merge = staticmethod(lambda a, b: (a[0] + b[0],))
        result = staticmethod(lambda held: held)

    big = 9007199254740993
    rows = spark.createDataFrame([(big, 1, 1.0), (None, 2, 1.0), (big, 3, 2.0), (7, 4, 1.0)], "id bigint, seq bigint, v double").coalesce(1)
    assert sorted(aggregate_with(rows, ["id"], Rows()).collect(), key=repr) == [(7, 1), (big, 2), (None, 1)]
    timed = rows.withColumn("ts", F.timestamp_seconds("seq"))
    got = rising_alerts(timed, ["id"], ["seq"], "ts", "v", timedelta(seconds=1))
    assert {r.id for r in got.collect()} == {7, big, None}
