"""Streaming operators with keyed state; the results equal those of the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.spans import epoch_micros, micros
from millrace.operators.patterns import Step
from millrace.streaming import processors as p


INTEGERS = ("tinyint", "smallint", "int", "bigint")


def _place(df: DataFrame, order: str) -> Column:
    """The order as a number that keeps it: a timestamp's microseconds, or an integer."""
    return epoch_micros(F.col(order)) if dict(df.dtypes)[order].startswith("timestamp") else F.col(order).cast("bigint")


def _wide(df: DataFrame, value: str) -> str:
    """The type that sums of a column need."""
    kind = dict(df.dtypes)[value]
    return "bigint" if kind in INTEGERS else "double" if kind == "float" else kind


def rolling(df: DataFrame, keys: Sequence[str], order: str, columns: Mapping[str, tuple[str, str | None]], ttl: timedelta | None = None) -> DataFrame:
    """One row per input row with running values ``{name: (kind, column)}``; a key without rows for ``ttl`` (by the clock) starts anew."""
    types = dict(df.dtypes)
    out = ["bigint" if kind == "count" or (kind == "sum" and types[field] in INTEGERS) else types[field] for kind, field in columns.values()]
    fields = [f"v{i} {kind}" for i, kind in enumerate(out)]
    rows = df.withColumn("seq", _place(df, order))
    folded = _run(rows, keys, p.RollingFold(list(keys), list(columns.values()), ", ".join(fields), ttl and micros(ttl) // 1000),
                  f"seq bigint, {', '.join(fields)}", "ProcessingTime" if ttl else "None")
    return folded.select(*keys, F.col("seq").alias(order), *[F.col(f"v{i}").alias(n) for i, n in enumerate(columns)])


def rolling_reduce(df: DataFrame, keys: Sequence[str], order: str, fields: Sequence[str],
                   function: Callable[[tuple, tuple], tuple]) -> DataFrame:
    """Rolling reduce over the tuple of ``fields``."""
    types = dict(df.dtypes)
    schema = ", ".join(f"`{f}` {types[f]}" for f in fields)
    rows = df.withColumn("seq", _place(df, order))
    return _run(rows, keys, p.RollingReduce(list(keys), function, list(fields), schema), f"seq bigint, {schema}")


def running_distinct(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    rows = df.select(*keys, _place(df, order).alias("seq"), F.col(value).cast("string").alias("value"))
    return _run(rows, keys, p.RunningDistinct(list(keys)), "seq bigint, uv bigint")


def count_windows(df: DataFrame, keys: Sequence[str], order: str, value: str, size: int, slide: int | None = None) -> DataFrame:
    kind = _wide(df, value)
    rows = df.select(*keys, _place(df, order).alias("seq"), F.col(value).cast(kind).alias("value"))
    return _run(rows, keys, p.CountWindows(list(keys), size, slide or size, kind), f"fired_at bigint, total {kind}")


def count_changes(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The retract log of a count; one withdrawn and one added row per input row."""
    rows = df.select(*keys, _place(df, order).alias("seq"))
    types = dict(df.dtypes)
    schema = ", ".join(["seq bigint", *[f"`{k}` {types[k]}" for k in keys], "is_add boolean", "cnt bigint"])
    return rows.groupBy(*keys).transformWithState(p.CountChanges(list(keys)), schema, "Append", "None")


def switched(main: DataFrame, control: DataFrame, order: str, setting: str, buckets: int = 64) -> DataFrame:
    """Main rows with the control setting in force; the control rows go to every bucket."""
    wide = main.select(_place(main, order).alias("seq"), F.lit(False).alias("is_control"),
                       F.lit(None).cast("string").alias("setting"),
                       F.pmod(F.xxhash64(order), F.lit(buckets)).cast("int").alias("bucket"))
    copies = control.select(_place(control, order).alias("seq"), F.lit(True).alias("is_control"),
                            F.col(setting).cast("string").alias("setting"),
                            F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    rows = wide.unionByName(copies)
    return rows.groupBy("bucket").transformWithState(p.Switch(), "seq bigint, switch string", "Append", "None")


def reconcile(left: DataFrame, right: DataFrame, key: str, left_order: str, right_order: str) -> DataFrame:
    """Pairs of the two sides, as JSON payloads; rows wait until their partner arrives."""

    def side(df, order, name):
        named = F.col(key) != "" if dict(df.dtypes)[key] == "string" else F.col(key).isNotNull()
        return df.where(named).select(
            F.col(key).alias("key"), _place(df, order).alias("seq"), F.lit(name).alias("side"),
            F.to_json(F.struct(*df.columns)).alias("payload"))

    rows = side(left, left_order, "left").unionByName(side(right, right_order, "right"))
    kind = dict(left.dtypes)[key]
    return rows.groupBy("key").transformWithState(
        p.Reconcile(), f"key {kind}, left string, right string", "Append", "None")


def click_limit(df: DataFrame, keys: Sequence[str], order: str, ts: str, limit: int = 100) -> DataFrame:
    """Rows passed and alarms raised per key and UTC day (``kind``); ``df`` needs a watermark on ``ts``."""
    day = micros(timedelta(days=1)) // 1000
    rows = df.select(*keys, ts, _place(df, order).alias("seq"),
                     ((F.floor(F.unix_millis(ts) / day) + 1) * day).alias("day_end"))
    keyed = [*keys, "day_end"]
    return _run(rows, keyed, p.ClickLimit(keyed, limit), "seq bigint, kind string", "EventTime")


def with_context(df: DataFrame, keys: Sequence[str], order: str, ts: str, cancel: Column, delay: timedelta,
                 by_event_time=True) -> DataFrame:
    """Each row with its watermark and clock, and a ``timer`` row when the key's timer fires."""
    rows = df.select(*keys, ts, _place(df, order).alias("seq"), F.unix_millis(ts).alias("at"),
                     F.coalesce(cancel, F.lit(False)).alias("cancel"))
    return _run(rows, keys, p.Context(list(keys), micros(delay) // 1000, by_event_time),
                "kind string, at bigint, watermark bigint, now bigint",
                "EventTime" if by_event_time else "ProcessingTime")


def payment_timer(df: DataFrame, keys: Sequence[str], order: str, ts: str, is_create: Column, limit: timedelta) -> DataFrame:
    """Order status in arrival order, with a timer for the missing half."""
    rows = df.select(*keys, ts, _place(df, order).alias("seq"), epoch_micros(F.col(ts)).alias("at"),
                     is_create.alias("is_create"))
    return _run(rows, keys, p.PaymentTimer(list(keys), micros(limit)), "status string", "EventTime")


def rising_alerts(df: DataFrame, keys: Sequence[str], order: str, ts: str, value: str, hold: timedelta, ttl: timedelta | None = None) -> DataFrame:
    """``start_ts`` and ``fire_ts`` of alerts (also in milliseconds, ``start_at`` and ``fire_at``). A row that comes after the watermark has
    passed it is a row with only ``late_seq`` set, its place in ``order``; so in the other rules here. ``ttl``: a key is forgotten after so
    long without a row, in event time."""
    kind = _wide(df, value)
    rows = _events(df, keys, order, ts, [], F.col(value).cast(kind))
    found = _run(rows, keys, p.RisingAlerts(list(keys) or [EVERY], micros(hold), kind, ttl and micros(ttl)), "start_us bigint, fire_us bigint, late_seq bigint", "EventTime")
    return found.select(*keys, *[F.floor(F.col(f"{n}_us") / 1000).alias(f"{n}_at") for n in ("start", "fire")],
                        *[F.timestamp_micros(f"{n}_us").alias(f"{n}_ts") for n in ("start", "fire")], "late_seq")


def match_sequence(df: DataFrame, keys: Sequence[str], order: str, ts: str, start: Column,
                   steps: Sequence[Step], within: timedelta | None = None, ttl: timedelta | None = None) -> DataFrame:
    """Matches (``matched``) and timed-out partial matches, with their events as JSON texts. Without keys, all rows are one sequence."""
    rows = _events(df, keys, order, ts, [start, *[s.where for s in steps]], F.lit(None).cast("bigint"))
    limit = None if within is None else micros(within)
    found = _run(rows, keys, p.SequenceMatcher(list(keys) or [EVERY], [s.how for s in steps], limit, ttl and micros(ttl)),
                 "matched boolean, events array<string>, timeout_us bigint, late_seq bigint", "EventTime")
    return found.select(*keys, "matched", "events", F.floor(F.col("timeout_us") / 1000).alias("timeout_at"),
                        F.timestamp_micros("timeout_us").alias("timeout_ts"), "late_seq")


def match_times(df: DataFrame, keys: Sequence[str], order: str, ts: str, where: Column, least: int, most: int | None = None,
                within: timedelta | None = None, ttl: timedelta | None = None) -> DataFrame:
    """``start_no, times, events``: runs of ``least`` to ``most`` fitting rows from every start, events as JSON texts."""
    rows = _events(df, keys, order, ts, [where], F.lit(None).cast("bigint"))
    limit = None if within is None else micros(within)
    return _run(rows, keys, p.TimesMatcher(list(keys) or [EVERY], least, most or least, limit, ttl and micros(ttl)),
                "start_no bigint, times bigint, events array<string>, late_seq bigint", "EventTime")


EVERY = "__every"  # the key of rules over all rows: one state in one task, as such a rule is


def _events(df, keys, order, ts, marks, value):
    """The rows of a rule. The column that carries the watermark stays out: with it, Spark would drop late rows before they get here."""
    flags = [F.coalesce(m, F.lit(False)) for m in marks] or [F.lit(False)]
    payload = F.to_json(F.struct(*df.columns)) if marks else F.lit(None).cast("string")
    return df.select(*keys, epoch_micros(F.col(ts)).alias("at"), _place(df, order).alias("seq"),
                     value.alias("value"), payload.alias("payload"), F.array(*flags).alias("marks"))


def _run(rows, keys, processor, schema, time_mode="None"):
    if not keys:
        return _run(rows.withColumn(EVERY, F.lit(0)), [EVERY], processor, schema, time_mode).drop(EVERY)
    types = dict(rows.dtypes)
    keyed = ", ".join(f"`{k}` {types[k]}" for k in keys)
    return rows.groupBy(*keys).transformWithState(processor, f"{keyed}, {schema}", "Append", time_mode)
