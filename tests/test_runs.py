"""Rising alerts: all runs of a batch together, against one row after the other."""

import random

import numpy as np
import pytest

from millrace.operators import alerts


def one_by_one(at, fall, low, carried, wait):
    fired, timer, ends = [], carried, [*low[1:], len(at)]
    for run, (start, end) in enumerate(zip(low, ends)):
        timer = timer if run == 0 else None
        for i in range(start, end):
            if timer is not None and at[i] > timer:
                fired.append((run, timer))
                timer = None
            if fall[i]:
                timer = None
            elif timer is None:
                timer = at[i] + wait
        if run < len(low) - 1 and timer is not None:
            fired.append((run, timer))
    return sorted(fired), timer


@pytest.mark.parametrize("few", [0, 16, 1000])
def test_runs_together_equal_one_by_one(monkeypatch, few):
    """The search for all runs at once and the one for few runs; timers carried in; runs that end in a fall."""
    monkeypatch.setattr(alerts, "FEW_RUNS", few)
    rng = random.Random(few)
    for _ in range(400):
        n = rng.randrange(1, 60)
        low = sorted({0, *[rng.randrange(n) for _ in range(rng.choice([0, 2, 30]))]})
        at, fall = np.zeros(n, np.int64), np.zeros(n, bool)
        for start, end in zip(low, [*low[1:], n]):
            at[start:end] = rng.randrange(100) + np.cumsum([rng.choice([0, 1, 3]) for _ in range(end - start)])
            fall[end - 1] = rng.random() < 0.4
        carried, wait = rng.choice([None, int(at[0]) + rng.randrange(5)]), rng.choice([1, 4, 9])
        runs, times, timer = alerts.walk_runs(at, fall, np.array(low), carried, wait)
        assert (sorted(zip(runs.tolist(), times.tolist())), timer) == one_by_one(at, fall, low, carried, wait)


def test_rows_without_a_time():
    none = alerts.NO_TIME
    runs, times, timer = alerts.walk_runs(np.array([none, none, 5, 30]), np.zeros(4, bool), np.array([0, 2]), None, 10)
    assert (runs.tolist(), times.tolist(), timer) == ([1, 0], [15, alerts.NEVER], 40)


@pytest.mark.parametrize("size, slide", [(6, 4), (4, 6), (5, 2), (3, 3), (1, 1)])
def test_count_windows_by_panes(spark, size, slide):
    from conftest import rows
    from pyspark.sql import functions as F

    from millrace.operators import windows

    rng = random.Random(size)
    df = spark.createDataFrame([(i, rng.choice("aab"), rng.choice([None, *range(9)])) for i in range(50)], "seq bigint, k string, v int")
    got = windows.count_sliding_panes(df, ["k"], ["seq"], size, slide, {"n": ("count", None), "total": ("sum", "v"), "low": ("min", "v")})
    want = windows.count_sliding(df, ["k"], ["seq"], size, slide, F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.min("v").alias("low"))
    assert rows(got, "k", "fired_at", "n", "total", "low") == rows(want, "k", "fired_at", "n", "total", "low") and want.count() > 4
