"""Windows of a stream that are evaluated when a trigger says so, by a function over all rows of the window.

A window is one keyed state: its rows, small notes that the trigger and the function may keep, and timers. Nothing holds a window whole in
memory; a function gets its rows as an iterator over the state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import timedelta
from itertools import chain

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from millrace.functions.spans import epoch_micros, micros
from millrace.streaming.stateful import _place

CONTINUE, FIRE, PURGE, FIRE_AND_PURGE = 0, 1, 2, 3
EVENT_TIME, CLOCK, ROWS_ONLY = "EventTime", "ProcessingTime", "None"


class Window:
    """What triggers and functions see of a window: bounds in microseconds, the number of rows kept, notes (texts by name), timers."""

    def __init__(self, key: tuple, start: int, end: int, count: int, notes, handle, now: int | None):
        self.key, self.start, self.end, self.count, self.now = key, start, end, count, now
        self._notes, self._handle = notes, handle

    def note(self, name: str) -> str | None:
        return self._notes.getValue((name,))[0] if self._notes.containsKey((name,)) else None

    def write(self, name: str, text: str) -> None:
        self._notes.updateValue((name,), (text,))

    def wake(self, at: int) -> None:
        """A timer at ``at`` microseconds (rounded up to milliseconds) on the trigger's clock."""
        self._handle.registerTimer(-(-at // 1000))


class Trigger:
    """When a window is evaluated (FIRE) and emptied (PURGE). ``clock`` is what timers follow."""

    clock = ROWS_ONLY

    def on_row(self, row: Row, window: Window) -> int:
        return CONTINUE

    def on_timer(self, at: int, window: Window) -> int:
        return CONTINUE


class EachRow(Trigger):
    """Evaluate every row by itself and keep none."""

    def on_row(self, row, window):
        return FIRE_AND_PURGE


class EveryRows(Trigger):
    """Evaluate when ``n`` rows have come since the last time; ``purge`` empties the window then."""

    def __init__(self, n: int, purge: bool = True):
        self.n, self.purge = n, purge

    def on_row(self, row, window):
        seen = int(window.note("trigger.rows") or 0) + 1
        window.write("trigger.rows", str(seen % self.n))
        return CONTINUE if seen < self.n else FIRE_AND_PURGE if self.purge else FIRE


class AtEnd(Trigger):
    """Evaluate once the watermark passes the window's end; within ``allowed`` after it, again for each late row."""

    clock = EVENT_TIME

    def __init__(self, allowed: timedelta = timedelta(0)):
        self.allowed = micros(allowed)

    def on_row(self, row, window):
        if window.now is not None and window.now >= window.end:
            window.wake(window.end + self.allowed)
            return FIRE
        window.wake(window.end)
        return CONTINUE

    def on_timer(self, at, window):
        fired = window.note("trigger.fired")
        window.write("trigger.fired", "1")
        if at >= window.end + self.allowed:
            return PURGE if fired else FIRE_AND_PURGE
        window.wake(window.end + self.allowed)
        return CONTINUE if fired else FIRE


class EveryInterval(Trigger):
    """Evaluate every so often by the wall clock, as long as rows come."""

    clock = CLOCK

    def __init__(self, every: timedelta, purge: bool = False):
        self.every, self.purge = micros(every), purge

    def on_row(self, row, window):
        if window.note("trigger.waits") != "1":
            window.write("trigger.waits", "1")
            window.wake(window.now + self.every)
        return CONTINUE

    def on_timer(self, at, window):
        window.write("trigger.waits", "0")
        return FIRE_AND_PURGE if self.purge else FIRE


#: Rows of results from a window and an iterator over the rows that it keeps.
Evaluate = Callable[[Window, Iterator[Row]], Iterable[tuple]]


class TriggeredWindows(StatefulProcessor):
    """``kept``: what the window holds of a row besides its order and time, of types ``schema``; ``fields``: what ``evaluate`` gives."""

    def __init__(self, keys: Sequence[str], size: int, trigger: Trigger, evaluate: Evaluate, kept: Sequence[str], schema: Sequence[str], fields: Sequence[str], allowed: int):
        self.keys, self.size, self.trigger, self.evaluate = keys, size, trigger, evaluate
        self.kept, self.schema, self.fields, self.allowed = kept, schema, fields, allowed

    def init(self, handle):
        self.handle = handle
        self.rows = handle.getListState("rows", ", ".join(["seq bigint, at bigint", *self.schema]))
        self.size_now = handle.getValueState("size", "n bigint")
        self.notes = handle.getMapState("notes", "name string", "text string")

    def window(self, key, timerValues) -> Window:
        start = key[-1]
        now = {EVENT_TIME: timerValues.getCurrentWatermarkInMs, CLOCK: timerValues.getCurrentProcessingTimeInMs}.get(self.trigger.clock)
        count = self.size_now.get()[0] if self.size_now.exists() else 0
        return Window(key[:-1], start, start + self.size, count, self.notes, self.handle, now() * 1000 if now else None)

    def result(self, key, window, values=None, late=None) -> Row:
        values = values or (None,) * len(self.fields)
        return Row(**dict(zip(self.keys, key)), start_us=window.start, end_us=window.end, late_seq=late, **dict(zip(self.fields, values)))

    def fired(self, key, window, fresh) -> Iterator[Row]:
        kept = map(self.named, self.rows.get()) if window.count > len(fresh) and self.rows.exists() else ()
        for values in self.evaluate(window, chain(kept, fresh)):
            yield self.result(key, window, values)

    def named(self, values) -> Row:
        return Row("seq", "at", *self.kept)(*values)

    def handleInputRows(self, key, rows, timerValues):
        window, fresh = self.window(key, timerValues), []
        if window.now is not None:  # what was due before these rows came goes first
            for at in sorted(t for t in self.handle.listTimers() if t * 1000 <= window.now):
                self.handle.deleteTimer(at)
                yield from self.rung(key, window, at * 1000)
        for row in sorted(rows, key=lambda r: (r["seq"] is None, r["seq"])):
            if self.trigger.clock == EVENT_TIME and window.now >= window.end + self.allowed:
                yield self.result(key, window, late=row["seq"])
                continue
            fresh.append(self.named((row["seq"], row["at"], *(row[f"f_{n}"] for n in self.kept))))
            window.count += 1
            said = self.trigger.on_row(row, window)
            if said & FIRE:
                yield from self.fired(key, window, fresh)
            if said & PURGE:
                fresh = []
                self.purge(window)
        if fresh:
            self.rows.appendList([tuple(r) for r in fresh])
        if window.count:
            self.size_now.update((window.count,))

    def purge(self, window) -> None:
        window.count = 0
        self.rows.clear()
        self.size_now.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self.rung(key, self.window(key, timerValues), expiredTimerInfo.getExpiryTimeInMs() * 1000)

    def rung(self, key, window, at) -> Iterator[Row]:
        said = self.trigger.on_timer(at, window)
        if said & FIRE:
            yield from self.fired(key, window, [])
        if said & PURGE:
            self.purge(window)
            if self.trigger.clock == EVENT_TIME and window.now >= window.end + self.allowed:
                self.notes.clear()  # no row of this window is taken any more


def triggered(df: DataFrame, keys: Sequence[str], order: str, ts: str, size: timedelta, trigger: Trigger, evaluate: Evaluate, schema: str,
              fields: Sequence[str], allowed: timedelta = timedelta(0)) -> DataFrame:
    """Results of ``evaluate`` (columns ``schema``) with keys, window_start and window_end; ``fields`` of the rows are kept in the window.

    With an event-time trigger, a row whose window closed ``allowed`` ago comes out as a row with only ``late_seq`` set, its place in
    ``order``; so no row is lost. Rows without a time have no window and are left out. A window is the state of one task.
    """
    types, step = dict(df.dtypes), micros(size)
    at = epoch_micros(F.col(ts))
    start = at - F.pmod(at, F.lit(step))
    # the watermark is known to the query; the column that carries it stays out, or Spark would drop late rows before they get here
    rows = df.where(F.col(ts).isNotNull()).select(*keys, start.alias("start_us"), _place(df, order).alias("seq"), at.alias("at"), *[F.col(f).alias(f"f_{f}") for f in fields])
    kept = [f"`f_{f}` {types[f]}" for f in fields]
    keyed = [*keys, "start_us"]
    names = [c.strip().split()[0].strip("`") for c in schema.split(",")]
    processor = TriggeredWindows(list(keys), step, trigger, evaluate, list(fields), kept, names, micros(allowed))
    out = ", ".join([*[f"`{k}` {types[k]}" for k in keys], "start_us bigint, end_us bigint, late_seq bigint", schema])
    found = rows.groupBy(*keyed).transformWithState(processor, out, "Append", trigger.clock)
    bound = lambda c: F.timestamp_micros(F.col(c))
    return found.select(*keys, bound("start_us").alias("window_start"), bound("end_us").alias("window_end"), "late_seq", *names)
