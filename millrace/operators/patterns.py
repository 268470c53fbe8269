"""Event patterns over the ordered rows of a key.

A sequence is resolved from its last step backwards: for every row, "the first later row that
fits step k, with its own continuation attached" is one running value over the reversed order.
Each start row then holds its whole match, without a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.spans import floor_time, interval
from millrace.operators.ordered import count, latest, ordered, previous

NEXT = "next"
NOT_NEXT = "not_next"
FOLLOWED_BY = "followed_by"
NOT_FOLLOWED_BY = "not_followed_by"


@dataclass(frozen=True)
class Step:
    """One step after the start: its name, how it is reached and its condition."""

    name: str
    how: str
    where: Column


def next_(name: str, where: Column) -> Step:
    """The very next row of the key."""
    return Step(name, NEXT, where)


def not_next(name: str, where: Column) -> Step:
    """There is a next row and it does not fit."""
    return Step(name, NOT_NEXT, where)


def followed_by(name: str, where: Column) -> Step:
    """The first later row that fits; rows in between are skipped."""
    return Step(name, FOLLOWED_BY, where)


def not_followed_by(name: str, where: Column) -> Step:
    """No fitting row before the match of the step that comes after this one."""
    return Step(name, NOT_FOLLOWED_BY, where)


def match_sequence(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: Column,
                   steps: Sequence[Step], ts: str | None = None, within: timedelta | None = None,
                   max_rows: int | None = None) -> DataFrame:
    """One row per start row: ``start`` and one struct per positive step, ``matched``, and with
    ``within`` also ``timed_out`` and ``timeout_at``.

    ``within`` is strict: a match that takes exactly that long has timed out. ``order`` must be
    unique within a key and begin with the event time when ``within`` is given.
    """
    if steps and steps[-1].how == NOT_FOLLOWED_BY:
        raise ValueError("a sequence cannot end in not_followed_by")
    event = F.struct(*[F.col(c) for c in df.columns])
    position = F.struct(*[F.col(c) for c in order])
    rows = ordered(df, keys, order, max_rows)
    later: Column | None = None  # continuation after the step being resolved
    for k in reversed(range(len(steps))):
        step, name = steps[k], f"__s{k}"
        fits = F.coalesce(step.where, F.lit(False))
        found = [position.alias("at"), event.alias("event"), fits.alias("fits")]
        negative = step.how in (NOT_NEXT, NOT_FOLLOWED_BY)
        if later is not None and not negative:
            found.append(later.alias("rest"))
        found = F.struct(*found)
        run = previous(found) if step.how in (NEXT, NOT_NEXT) else latest(F.when(fits, found))
        rows = rows.running({name: run}, reverse=True, exclusive=True)
        here = F.col(name)
        if negative:
            if step.how == NOT_NEXT:
                broken = here["fits"]
                clear = here.isNotNull() & ~broken
            else:
                broken = here.isNotNull() & (later.isNull() | (here["at"] < later["at"]))
                clear = ~broken
            guard = [clear.alias("clear"), broken.alias("broken"), here["event"].alias("event")]
            if later is not None:
                guard += [later["at"].alias("at"), later.alias("rest")]
            here = F.struct(*guard)
        later = here
    starts = rows.to_df().where(start)
    picked, checks, deaths = [event.alias("start")], [F.lit(True)], [F.lit(False)]
    here, last = later, event
    for k, step in enumerate(steps):
        more = k + 1 < len(steps)
        if step.how in (NOT_NEXT, NOT_FOLLOWED_BY):
            checks.append(F.coalesce(here["clear"], F.lit(False)))
            deaths.append(here["broken"] & _soon(here["event"], ts, within))
            here = here["rest"] if more else None
            continue
        fits = here["fits"]
        picked.append(F.when(fits, here["event"]).alias(step.name))
        checks.append(F.coalesce(fits, F.lit(False)))
        if step.how == NEXT:
            deaths.append(~fits & _soon(here["event"], ts, within))
        last = here["event"]
        here = here["rest"] if more else None
    complete = reduce(Column.__and__, checks)
    if within is None:
        return starts.select(*picked, complete.alias("matched"))
    deadline = F.col(ts) + interval(within)
    matched = complete & F.coalesce(last[ts] < deadline, F.lit(False))
    dead = reduce(Column.__or__, [F.coalesce(d, F.lit(False)) for d in deaths])
    return starts.select(*picked, matched.alias("matched"), (~matched & ~dead).alias("timed_out"),
                         deadline.alias("timeout_at"))


def _soon(event: Column, ts: str | None, within: timedelta | None) -> Column:
    return F.lit(True) if within is None else event[ts] < F.col(ts) + interval(within)


def as_match_map(matched: DataFrame, names: Sequence[str]) -> DataFrame:
    """Matches as one map from step name to its list of events."""
    entries = [part for name in names for part in (F.lit(name), F.array(F.col(name)))]
    return matched.where("matched").select(F.create_map(*entries).alias("match"))


def match_times(df: DataFrame, keys: Sequence[str], order: Sequence[str], where: Column,
                least: int, most: int | None = None, ts: str | None = None,
                within: timedelta | None = None, max_rows: int | None = None) -> DataFrame:
    """Runs of ``least`` to ``most`` fitting rows from every start; other rows are skipped.

    Returns ``keys, start_no, times, events`` with the events in order.
    """
    most = most or least
    event = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in df.columns if c not in order])
    rows = ordered(df.where(where), keys, order, max_rows).running({"__rn": count()}).to_df()
    rn = F.col("__rn")
    member = rows.select(*keys, rn.alias("__rn"), event.alias("event"), F.explode(
        F.sequence(F.greatest(rn - (most - 1), F.lit(1)), rn)).alias("start_no"))
    runs = member.groupBy(*keys, "start_no").agg(F.array_sort(F.collect_list("event")).alias("__all"))
    lengths = F.explode(F.sequence(F.lit(least), F.lit(most))).alias("times")
    out = runs.select(*keys, "start_no", "__all", lengths).where(F.size("__all") >= F.col("times"))
    out = out.select(*keys, "start_no", F.col("times").cast("bigint").alias("times"),
                     F.slice("__all", F.lit(1), F.col("times")).alias("events"))
    if within is None:
        return out
    return out.where(F.element_at("events", -1)[ts] < F.element_at("events", 1)[ts] + interval(within))


def match_any_later(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column,
                    second: Column, ts: str, within: timedelta) -> DataFrame:
    """``first`` followed by any later ``second`` in less than ``within``, one row per pair.

    The key is joined with time buckets as wide as ``within``: each start meets its own bucket and the next one only.
    """
    event, position = F.struct(*[F.col(c) for c in df.columns]), F.struct(*[F.col(c) for c in order])
    bucket = floor_time(ts, within)
    starts = df.where(first).select(
        *keys, event.alias("start"), position.alias("__from"), bucket.alias("__b")).withColumn(
        "__bucket", F.explode(F.array("__b", F.col("__b") + interval(within)))).drop("__b")
    ends = df.where(second).select(*keys, event.alias("later"), position.alias("__to"), bucket.alias("__bucket"))
    pairs = starts.join(ends, [*keys, "__bucket"]).where(
        (F.col("__to") > F.col("__from")) & (F.col("later")[ts] < F.col("start")[ts] + interval(within)))
    return pairs.select(*keys, "start", "later")
