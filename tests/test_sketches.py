"""Approximate distinct counts: Bloom filters against one row after the other, sketches against exact counts, both from streams."""

import hashlib
import random
from datetime import timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import distinct
from millrace.streaming import sketches
from samples import T0

SECOND = timedelta(seconds=1)
BITS, HASHES = 64, 3


@pytest.fixture
def visits(spark):
    rng = random.Random(3)
    data = [(i, f"u{rng.randrange(60)}" if i % 31 else None, None if i % 23 == 7 else T0 + rng.randrange(40)) for i in range(400)]
    return spark.createDataFrame(data, "seq bigint, user string, s bigint").select("seq", "user", F.timestamp_seconds("s").alias("et"))


def sequential(df):
    """A Bloom filter per window, fed row by row."""
    filters, counts = {}, {}
    for r in sorted(df.collect(), key=lambda r: r.seq):
        if r.et is None or r.user is None:
            continue
        digest = hashlib.md5(r.user.encode()).hexdigest()
        first, step = (int(digest[a:a + 15], 16) % BITS for a in (0, 16))
        window = int(r.et.timestamp()) // 10
        bits = {(first + i * step) % BITS for i in range(HASHES)}
        if not bits <= filters.setdefault(window, set()):
            counts[window] = counts.get(window, 0) + 1
            filters[window] |= bits
    return [counts[w] for w in sorted(counts)]


def test_bloom_counts_row_by_row(spark, visits):
    got = rows(distinct.bloom_per_window(visits, "et", 10 * SECOND, "user", "seq", BITS, HASHES))
    exact = rows(distinct.distinct_per_window(visits.where("user is not null"), "et", 10 * SECOND, "user"))
    assert [n for *_, n in got] == sequential(visits)
    assert all(a <= b for (*_, a), (*_, b) in zip(got, exact)) and sum(n for *_, n in got) < sum(n for *_, n in exact)


def test_bloom_parts_merge_by_the_minimum(visits):
    part = lambda df: distinct.bloom_firsts(df, "et", 10 * SECOND, "user", "seq", BITS, HASHES)
    both = part(visits.where("seq % 3 = 0")).union(part(visits.where("seq % 3 > 0")))
    merged = both.groupBy("window_start", "window_end", "bit").agg(F.min("first").alias("first"))
    assert rows(distinct.bloom_count(merged)) == rows(distinct.bloom_per_window(visits, "et", 10 * SECOND, "user", "seq", BITS, HASHES))


def test_bloom_size():
    assert distinct.bloom_size(1_000_000_000, 0.01) == (9_585_058_378, 7)
    assert distinct.bloom_size(1, 0.5) == (2, 1)


def test_large_filters(visits):
    """With room for all, the count is exact; positions beyond one bitmap too."""
    bits, hashes = distinct.bloom_size(10_000_000, 0.01)
    got = distinct.bloom_per_window(visits, "et", 10 * SECOND, "user", "seq", bits, hashes)
    assert rows(got) == rows(distinct.distinct_per_window(visits.where("user is not null"), "et", 10 * SECOND, "user"))


@pytest.mark.parametrize("bits, fold", [(BITS, 2), (10_000_019, 32)])
def test_bloom_of_a_stream(spark, replay, visits, tmp_path, bits, fold):
    """Batches in order give the count of the whole table, after a failed batch too."""
    stream = replay(*[visits.where((F.col("seq") >= a) & (F.col("seq") < a + 80)) for a in range(0, 400, 80)])
    state = sketches.BloomWindows(spark, f"{tmp_path}/bloom", "et", 10 * SECOND, "user", "seq", bits, HASHES, fold)
    failing = {2}

    def write(batch, batch_id):
        state.add(batch, batch_id)
        if batch_id in failing:
            failing.remove(batch_id)
            raise RuntimeError("lost")

    for _ in range(2):
        try:
            stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
        except Exception as e:
            assert "lost" in str(e)
    assert not failing
    assert rows(state.table()) == rows(distinct.bloom_per_window(visits, "et", 10 * SECOND, "user", "seq", bits, HASHES))


def test_sliding_sketches(spark, replay, visits, tmp_path):
    got = distinct.approx_sliding(visits, "et", 20 * SECOND, 5 * SECOND, "user")
    seen = visits.groupBy(F.window("et", "20 seconds", "5 seconds"), "user").agg(F.lit(1).alias("x"))
    exact = rows(seen.groupBy("window.start", "window.end").agg(F.count("user").alias("uv")))
    assert len(exact) > 8 and rows(got) == exact  # so few values are counted exactly
    stream = replay(visits.where("seq < 100"), visits.where("seq between 100 and 250"), visits.where("seq > 250"))
    state = sketches.SketchWindows(spark, f"{tmp_path}/sketch", "et", 20 * SECOND, 5 * SECOND, "user", fold=2)
    sketches.kept(stream, state).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert rows(state.table()) == exact


def test_sketches_of_many_values(spark):
    df = spark.range(200_000).select(F.timestamp_seconds(F.lit(T0) + F.col("id") % 60).alias("et"), (F.col("id") % 50_000).alias("v"))
    for *_, n in rows(distinct.approx_sliding(df, "et", 60 * SECOND, 30 * SECOND, "v")):
        assert n > 20_000
    whole = [n for *_, n in rows(distinct.approx_sliding(df, "et", 60 * SECOND, 60 * SECOND, "v"))]
    assert sum(0.93 * 50_000 <= n <= 1.07 * 50_000 for n in whole) >= 1
