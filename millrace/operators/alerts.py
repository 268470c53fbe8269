"""Rules that keep state per key: rising values, a broadcast switch, click limits, order payment."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.checkpoints import reliable
from millrace.functions.spans import floor_time, interval
from millrace.operators.ordered import CHUNK, latest, ordered, previous, small

DAY = timedelta(days=1)


def rising_alerts(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, value: str,
                  hold: timedelta, max_rows: int | None = None) -> DataFrame:
    """Keys whose value has not fallen for ``hold``: ``keys, start_ts, fire_ts``.

    A row without a running timer starts one; a fall cancels it and starts none; the timer fires when event time
    passes it, and the next row starts the next one. A fall and a pause longer than ``hold`` both leave the key
    without a timer, so the rows between them form independent runs, which are spread over tasks. A run with
    more than ``max_rows`` rows is itself cut into chunks.
    """
    rows = ordered(df, keys, order, max_rows).running(
        {"__value": previous(value), "__ts": previous(ts)}, exclusive=True)
    rows = rows.with_columns({"__fall": F.coalesce(F.col(value) < F.col("__value"), F.lit(False))})
    rows = rows.running({"__after_fall": previous("__fall")}, exclusive=True)
    fresh = F.col("__ts").isNull() | F.col("__after_fall") | (F.col(ts) > F.col("__ts") + interval(hold))
    rows = rows.running({"__run": latest(F.when(fresh, F.struct(*[F.col(c) for c in order])))})
    runs, places = [f"__r{i}" for i in range(len(order))], [f"__o{i}" for i in range(len(order))]
    types = dict(df.dtypes)
    # integers that pass through pandas beside a null would be inexact, so they go as text
    sent = lambda c, kind: c.cast("string") if kind in ("tinyint", "smallint", "int", "bigint") else c
    flat = rows.to_df().select(
        *[sent(F.col(k), types[k]).alias(k) for k in keys],
        *[sent(F.col("__run")[c], types[c]).alias(r) for c, r in zip(order, runs)],
        *[F.col(c).alias(o) for c, o in zip(order, places)], F.col(ts).alias("__at"), "__fall")
    group = [*keys, *runs]
    cut = ordered(flat, group, places, max_rows) if rows.split else None
    if cut is None or not cut.split:
        return _short_runs(flat, group, places, hold).select(*[F.col(k).cast(types[k]) for k in keys], "start_ts", "fire_ts")
    short = _short_runs(cut.df.where(f"{CHUNK} = 0"), group, places, hold)
    long = _long_runs(cut.df.where(f"{CHUNK} > 0"), group, hold, max_rows)
    return short.unionByName(long).select(*[F.col(k).cast(types[k]) for k in keys], "start_ts", "fire_ts")


def _short_runs(flat: DataFrame, group: Sequence[str], places: Sequence[str], hold: timedelta) -> DataFrame:
    """Alerts of runs that fit one task: all runs of a batch go from one timer's end to the next together."""
    names, wait = list(group), hold // timedelta(microseconds=1)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, timer = None, None  # the run that is open, as a frame of one row, and its timer
        for batch in batches:
            if not len(batch):
                continue
            change = np.zeros(len(batch), bool)
            for name in names:
                code = pd.factorize(batch[name], use_na_sentinel=False)[0]
                change[1:] |= code[1:] != code[:-1]
            low = np.append(0, np.flatnonzero(change))
            heads = batch[names].iloc[low].reset_index(drop=True)
            carried = timer if here is not None and first_key(heads) == first_key(here) else None
            if timer is not None and carried is None:
                yield alerts(here, [timer])
            runs, times, timer = walk_runs(batch["__at"].to_numpy().astype("datetime64[us]").view(np.int64), batch["__fall"].to_numpy(bool), low, carried, wait)
            here = heads.iloc[-1:]
            yield alerts(heads.iloc[runs], times)
        if timer is not None:
            yield alerts(here, [timer])

    def first_key(frame: pd.DataFrame) -> tuple:
        return tuple(None if pd.isna(v) else v for v in frame.iloc[0])

    def alerts(keys: pd.DataFrame, timers) -> pd.DataFrame:
        fire = np.asarray(timers, np.int64)
        known = fire != NEVER
        time = lambda x: np.where(known, x, NO_TIME).view("datetime64[us]").astype("datetime64[ns]")
        return keys.reset_index(drop=True).assign(start_ts=time(fire - wait), fire_ts=time(fire))

    rows = flat.repartition(*group).sortWithinPartitions(*group, *places).select(*group, "__at", "__fall")
    return rows.mapInPandas(walk, _schema(rows, group, "start_ts", "fire_ts"))


NO_TIME, NEVER = np.iinfo(np.int64).min, np.iinfo(np.int64).max
FEW_RUNS = 16


def walk_runs(at: np.ndarray, fall: np.ndarray, low: np.ndarray, carried: int | None, wait: int) -> tuple[np.ndarray, np.ndarray, int | None]:
    """Alerts of runs that begin at ``low`` (numbers of runs, and when their timers fire), and the timer that the last run is left with.

    ``carried`` is the timer with which the first run goes on. Only the last row of a run can be a fall; event time doesn't go back.
    A timer that is started by a row without a time never passes before the run ends.
    """
    high = np.append(low[1:], len(at))
    run = np.repeat(np.arange(len(low)), high - low)
    if ((at[1:] < at[:-1]) & (run[1:] == run[:-1])).any():
        at = pd.Series(at).groupby(run).cummax().to_numpy()
    timer, runs_ = np.full(len(low), NO_TIME), np.arange(len(low))  # NO_TIME: none is running
    if carried is not None:
        timer[0] = carried
    place, live = low.copy(), runs_
    fired_runs, fired_times = [], []
    while len(live):
        idle = timer[live] == NO_TIME
        ended = idle & fall[place[live]]
        starts = live[idle & ~ended]
        begun = at[place[starts]]
        timer[starts] = np.where(begun == NO_TIME, NEVER, begun + wait)
        live = live[~ended]
        place[live] = first_after(at, place[live], high[live], timer[live])
        live = live[place[live] < high[live]]
        fired_runs.append(live)
        fired_times.append(timer[live])
        timer[live] = NO_TIME
    timer[fall[high - 1]] = NO_TIME
    left = runs_[:-1][timer[:-1] != NO_TIME]
    last = int(timer[-1])
    return np.concatenate([*fired_runs, left]), np.concatenate([*fired_times, timer[left]]), None if last == NO_TIME else last


def first_after(at: np.ndarray, low: np.ndarray, high: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """For each stretch [low, high) of ascending times its first place with a time above ``limit``, else ``high``."""
    if len(low) <= FEW_RUNS:
        return np.array([a + np.searchsorted(at[a:b], t, "right") for a, b, t in zip(low, high, limit)], np.int64)
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = np.where(open_, (low + high) // 2, 0)
        above = at[middle] > limit
        high = np.where(open_ & above, middle, high)
        low = np.where(open_ & ~above, middle + 1, low)
    return low


def _long_runs(rows: DataFrame, group: Sequence[str], hold: timedelta, max_rows: int | None) -> DataFrame:
    """Alerts of runs cut into chunks; a run ends at its fall, which cancels a timer still running."""
    starts = _long_run_starts(rows, group, hold, max_rows)
    falls = rows.where("__fall").groupBy(*group).agg(F.min("__at").alias("__fall_at"))
    fire = F.col("start_ts") + interval(hold)
    kept = starts.join(*_lookup(falls, group), "left").where(F.col("__fall_at").isNull() | (F.col("__fall_at") > fire))
    return kept.select(*group, "start_ts", fire.alias("fire_ts"))


def _lookup(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``df`` with its keys renamed, and the null-safe condition that joins them."""
    same = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(keys)]
    return df.withColumnsRenamed({c: f"__k{i}" for i, c in enumerate(keys)}), reduce(Column.__and__, same)


def _long_run_starts(rows: DataFrame, group: Sequence[str], hold: timedelta, max_rows: int | None) -> DataFrame:
    """Times that start a timer: the first of a run, then each first time later than the timer before it.

    Each time's next start is a running value over times and deadlines together. From the first time of each run the starts are reached by
    hops that double in length: joins on (run, time), in which no run is one group.
    """
    times = rows.where("not __fall").select(*group, "__at").distinct()
    marks = times.select(*group, F.col("__at").alias("__t"), F.lit(0).alias("__deadline")).unionByName(
        times.select(*group, (F.col("__at") + interval(hold)).alias("__t"), F.lit(1).alias("__deadline")))
    seen = ordered(marks, group, ["__t", "__deadline"], max_rows).running(
        {"__next": latest(F.when(F.col("__deadline") == 0, F.col("__t")))}, reverse=True, exclusive=True)
    hops = reliable(seen.to_df().where("__deadline = 1 and __next is not null").select(
        *group, (F.col("__t") - interval(hold)).alias("__at"), "__next"))
    reached = reliable(times.groupBy(*group).agg(F.min("__at").alias("__at")))
    known = reached.count()
    while True:
        onward, same = _lookup(hops, [*group, "__at"])
        further = reached.join(onward, same).select(*group, F.col("__next").alias("__at"))
        reached = reliable(reached.unionByName(further).distinct())
        before, known = known, reached.count()
        if known == before:
            return reached.withColumnRenamed("__at", "start_ts")
        onward = onward.withColumnRenamed("__next", "__then")
        keys = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(group)] + [F.col("__next") == F.col(f"__k{len(group)}")]
        hops = reliable(hops.join(onward, reduce(Column.__and__, keys)).select(*group, "__at", F.col("__then").alias("__next")))


def _schema(df: DataFrame, columns: Sequence[str], *times: str) -> str:
    types = dict(df.dtypes)
    return ", ".join([*[f"`{c}` {types[c]}" for c in columns], *[f"{t} {types['__at']}" for t in times]])


def switched(df: DataFrame, arrival: Sequence[str], is_control: Column, setting: Column,
             max_rows: int | None = None, before: Column | None = None) -> DataFrame:
    """Main rows with ``switch``: "on" when the newest control row before them is "1", else "off". ``before``: the setting before all rows."""
    rows = ordered(df.withColumn("__control", is_control), [], arrival, max_rows).running(
        {"__setting": latest(F.when(F.col("__control"), setting))}).to_df()
    setting_ = F.col("__setting") if before is None else F.coalesce("__setting", before)
    on = F.coalesce(setting_ == "1", F.lit(False))
    return rows.where(~F.col("__control")).withColumn(
        "switch", F.when(on, "on").otherwise("off")).drop("__control", "__setting")


def click_limit(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], limit: int = 100) -> DataFrame:
    """The first ``limit`` + 1 rows of each key and UTC day, numbered ``click_no``.

    Later rows are dropped by the rule anyway, so Spark keeps no more than these per task: a key
    that clicks without end never reaches one task.
    """
    day = df.withColumn("day_start", floor_time(ts, DAY))
    number = F.row_number().over(Window.partitionBy(*keys, "day_start").orderBy(*order))
    return day.withColumn("click_no", number).where(F.col("click_no") <= limit + 1)


def clicks_passed(limited: DataFrame, limit: int = 100) -> DataFrame:
    return limited.where(F.col("click_no") <= limit)


def click_alarms(limited: DataFrame, limit: int = 100) -> DataFrame:
    """One row per key and day: the first click beyond the limit."""
    return limited.where(F.col("click_no") == limit + 1)


def payment_status(df: DataFrame, keys: Sequence[str], ts: str, is_create: Column, is_pay: Column,
                   limit: timedelta) -> DataFrame:
    """Per order: ``normal``, ``late_paid``, ``timeout`` (never paid) or ``missing_create``."""
    seen = df.groupBy(*keys).agg(F.min(F.when(is_create, F.col(ts))).alias("created_at"),
                                 F.min(F.when(is_pay, F.col(ts))).alias("paid_at"))
    created, paid = F.col("created_at"), F.col("paid_at")
    status = (F.when(created.isNull(), "missing_create").when(paid.isNull(), "timeout")
              .when(paid >= created + interval(limit), "late_paid").otherwise("normal"))
    return seen.where(created.isNotNull() | paid.isNotNull()).withColumn("status", status)
