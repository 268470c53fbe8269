"""Keyed state and timers for streams.

Conditions, times and payloads are computed as columns before the rows get here, so the Python
side only moves state. Timers ring in epoch milliseconds. A micro-batch of a key is sorted by its
arrival number; its size is bounded by the source's per-trigger limit.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Iterable, Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor

NEXT, NOT_NEXT, FOLLOWED_BY, NOT_FOLLOWED_BY = "next", "not_next", "followed_by", "not_followed_by"


class RollingFold(StatefulProcessor):
    """One output per input: the row's ``seq`` and its key's running values.

    ``folds`` are (kind, field) pairs; kinds: sum, count, max, min, first, latest, previous.
    """

    def __init__(self, keys, folds, state_schema, ttl=None):
        self.keys, self.folds, self.state_schema, self.ttl = keys, folds, state_schema, ttl

    def init(self, handle):
        self.state = handle.getValueState("values", self.state_schema, self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.state.get() if self.state.exists() else None
        for row in sorted(rows, key=lambda r: r["seq"]):
            shown, held = self.step(held, row)
            yield Row(**dict(zip(self.keys, key)), seq=row["seq"],
                      **{f"v{i}": v for i, v in enumerate(shown)})
        if held is not None:
            self.state.update(tuple(held))

    def step(self, held, row):
        shown, kept = [], []
        for i, (kind, field) in enumerate(self.folds):
            old = held[i] if held is not None else None
            new = row[field] if field else 1
            if kind == "previous":
                shown.append(old)
                kept.append(new)
                continue
            if held is None:
                value = new
            elif kind in ("sum", "count"):
                value = new if old is None else old if new is None else old + new
            elif kind in ("max", "min"):
                pick = max if kind == "max" else min
                value = pick((v for v in (old, new) if v is not None), default=None)
            elif kind == "first":
                value = old
            else:
                value = old if new is None else new
            shown.append(value)
            kept.append(value)
        return shown, kept


class RollingReduce(StatefulProcessor):
    """Rolling reduce with any function of (accumulator, row): the first row of a key passes unchanged."""

    def __init__(self, keys, reduce, fields, state_schema):
        self.keys, self.reduce, self.fields, self.state_schema = keys, reduce, fields, state_schema

    def init(self, handle):
        self.state = handle.getValueState("accumulator", self.state_schema)

    def handleInputRows(self, key, rows, timerValues):
        held = self.state.get() if self.state.exists() else None
        for row in sorted(rows, key=lambda r: r["seq"]):
            values = tuple(row[f] for f in self.fields)
            held = values if held is None else tuple(self.reduce(held, values))
            yield Row(**dict(zip(self.keys, key)), seq=row["seq"], **dict(zip(self.fields, held)))
        if held is not None:
            self.state.update(held)


class RunningDistinct(StatefulProcessor):
    """After each row, how many distinct values the key has seen."""

    def __init__(self, keys):
        self.keys = keys

    def init(self, handle):
        self.seen = handle.getMapState("seen", "value string", "here boolean")
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues):
        n = self.count.get()[0] if self.count.exists() else 0
        for row in sorted(rows, key=lambda r: r["seq"]):
            if not self.seen.containsKey((row["value"],)):
                self.seen.updateValue((row["value"],), (True,))
                n += 1
            yield Row(**dict(zip(self.keys, key)), seq=row["seq"], uv=n)
        self.count.update((n,))


class CountWindows(StatefulProcessor):
    """Fires at every ``slide``-th row of a key with the sum over its last ``size`` rows.

    With ``slide == size`` these are tumbling count windows.
    """

    def __init__(self, keys, size, slide, kind="bigint"):
        self.keys, self.size, self.slide, self.kind = keys, size, slide, kind

    def init(self, handle):
        self.count = handle.getValueState("count", "n bigint")
        self.last = handle.getListState("last", f"value {self.kind}")

    def handleInputRows(self, key, rows, timerValues):
        n = self.count.get()[0] if self.count.exists() else 0
        last = [v[0] for v in self.last.get()] if self.last.exists() else []
        for row in sorted(rows, key=lambda r: r["seq"]):
            n += 1
            last = [*last, row["value"]][-self.size:]
            if n % self.slide == 0:
                yield Row(**dict(zip(self.keys, key)), fired_at=n, total=sum(last))
        self.count.update((n,))
        self.last.put([(v,) for v in last])


class CountChanges(StatefulProcessor):
    """For each row, withdraw the key's old count and add the new one."""

    def __init__(self, keys):
        self.keys = keys

    def init(self, handle):
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues):
        n = self.count.get()[0] if self.count.exists() else 0
        named = dict(zip(self.keys, key))
        for row in sorted(rows, key=lambda r: r["seq"]):
            if n:
                yield Row(seq=row["seq"], **named, is_add=False, cnt=n)
            n += 1
            yield Row(seq=row["seq"], **named, is_add=True, cnt=n)
        self.count.update((n,))


class Switch(StatefulProcessor):
    """Main rows with the newest control setting before them; every bucket sees all control rows."""

    def init(self, handle):
        self.setting = handle.getValueState("setting", "value string")

    def handleInputRows(self, key, rows, timerValues):
        setting = self.setting.get()[0] if self.setting.exists() else None
        for row in sorted(rows, key=lambda r: r["seq"]):
            if row["is_control"]:
                setting = row["setting"]
                self.setting.update((setting,))
            else:
                yield Row(seq=row["seq"], switch="on" if setting == "1" else "off")


class Reconcile(StatefulProcessor):
    """Two sides of a key: each waits for its partner, is emitted once and forgotten."""

    def init(self, handle):
        self.cache = {side: handle.getValueState(side, "payload string") for side in ("left", "right")}

    def handleInputRows(self, key, rows, timerValues):
        for row in sorted(rows, key=lambda r: r["seq"]):
            side = row["side"]
            other = self.cache["right" if side == "left" else "left"]
            if other.exists():
                pair = {side: row["payload"], "right" if side == "left" else "left": other.get()[0]}
                other.clear()
                yield Row(key=key[0], left=pair["left"], right=pair["right"])
            else:
                self.cache[side].update((row["payload"],))


class ClickLimit(StatefulProcessor):
    """Passes the first ``limit`` rows of a (key, day), alarms once, drops the rest; a timer at midnight forgets."""

    def __init__(self, keys, limit):
        self.keys, self.limit = keys, limit

    def init(self, handle):
        self.handle = handle
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues):
        n = self.count.get()[0] if self.count.exists() else 0
        named = dict(zip(self.keys, key))
        if not n:
            self.handle.registerTimer(named["day_end"])
        for row in sorted(rows, key=lambda r: r["seq"]):
            n += 1
            if n <= self.limit + 1:
                yield Row(**named, seq=row["seq"], kind="pass" if n <= self.limit else "alarm")
        self.count.update((n,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.count.clear()
        return iter(())


class Context(StatefulProcessor):
    """Each row with what its process function can see, and its timers: registered, dropped, fired.

    A row asks for a timer ``delay`` later; a row marked ``cancel`` drops the key's timer instead.
    ``by_event_time`` picks the clock.
    """

    def __init__(self, keys, delay, by_event_time):
        self.keys, self.delay, self.by_event_time = keys, delay, by_event_time

    def init(self, handle):
        self.handle = handle
        self.timer = handle.getValueState("timer", "at bigint")

    def handleInputRows(self, key, rows, timerValues):
        named = dict(zip(self.keys, key))
        watermark, now = timerValues.getCurrentWatermarkInMs(), timerValues.getCurrentProcessingTimeInMs()
        for row in sorted(rows, key=lambda r: r["seq"]):
            held = self.timer.get()[0] if self.timer.exists() else None
            if row["cancel"] and held is not None:
                self.handle.deleteTimer(held)
                self.timer.clear()
            elif not row["cancel"] and held is None:
                at = (row["at"] if self.by_event_time else now) + self.delay
                self.handle.registerTimer(at)
                self.timer.update((at,))
            yield Row(**named, kind="row", at=row["at"], watermark=watermark, now=now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.timer.clear()
        yield Row(**dict(zip(self.keys, key)), kind="timer", at=expiredTimerInfo.getExpiryTimeInMs(),
                  watermark=timerValues.getCurrentWatermarkInMs(), now=timerValues.getCurrentProcessingTimeInMs())


def milliseconds(at: int) -> int:
    """A time in microseconds as a timer that doesn't ring before it."""
    return -(-at // 1000)


class PaymentTimer(StatefulProcessor):
    """Order payment in arrival order: the first of (create, pay) sets a timer, the second settles the order. Times are microseconds."""

    def __init__(self, keys, limit):
        self.keys, self.limit = keys, limit

    def init(self, handle):
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "created bigint, paid bigint, timer bigint")

    def handleInputRows(self, key, rows, timerValues):
        named = dict(zip(self.keys, key))
        for row in sorted(rows, key=lambda r: r["seq"]):
            created, paid, timer = self.waiting.get() if self.waiting.exists() else (None, None, None)
            if row["is_create"]:
                created = row["at"]
            else:
                paid = row["at"]
            if created is not None and paid is not None:
                self.handle.deleteTimer(timer)
                self.waiting.clear()
                yield Row(**named, status="late_paid" if paid - created >= self.limit else "normal")
                continue
            if timer is None:
                timer = milliseconds(row["at"] + self.limit)
                self.handle.registerTimer(timer)
            self.waiting.update((created, paid, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.waiting.exists():
            created = self.waiting.get()[0]
            self.waiting.clear()
            yield Row(**dict(zip(self.keys, key)), status="missing_create" if created is None else "timeout")


Event = namedtuple("Event", "at seq value payload marks")


class EventTimeOrder(StatefulProcessor):
    """Base: holds rows until the watermark has passed them, then hands them on by (time, arrival). Times are microseconds.

    Held rows lie in a map by stretches of time, and one timer rings for the first of them, so a firing reads only what is due. A row that
    comes after the watermark has passed its time, or has none, goes out at once with its place in ``late_seq``. With ``ttl``, a key that
    has had no row for so long in event time is forgotten.
    """

    kind = "bigint"  # of the value
    fields: tuple = ()  # of the output, besides keys and late_seq
    stretch = 1_000_000
    ttl: int | None = None

    def init(self, handle):
        self.handle = handle
        event = f"at bigint, seq bigint, value {self.kind}, payload string, marks array<boolean>"
        self.held = handle.getMapState("held", "stretch bigint", f"rows array<struct<{event}>>")
        self.clock = handle.getValueState("clock", "wake bigint, seen bigint, expiry bigint")
        self.begin(handle)

    def handleInputRows(self, key, rows, timerValues):
        watermark, fresh = timerValues.getCurrentWatermarkInMs() * 1000, {}
        for r in rows:
            if r["at"] is None or r["at"] <= watermark:
                yield Row(**dict(zip(self.keys, key)), **dict.fromkeys(self.fields), late_seq=r["seq"])
            else:
                fresh.setdefault(r["at"] // self.stretch, []).append((r["at"], r["seq"], r["value"], r["payload"], list(r["marks"])))
        for place, new in fresh.items():
            before = [tuple(e) for e in self.held.getValue((place,))[0]] if self.held.containsKey((place,)) else []
            self.held.updateValue((place,), (before + new,))
        if fresh:
            times = [e[0] for new in fresh.values() for e in new]
            wake, seen, expiry = self.clock.get() if self.clock.exists() else (None, None, None)
            wake = self.rings(wake, min(times))
            seen = max(times) if seen is None else max(seen, *times)
            if self.ttl is not None and expiry is None:
                expiry = self.rings(None, seen + self.ttl)
            self.clock.update((wake, seen, expiry))

    def rings(self, wake: int | None, at: int) -> int:
        """The earlier of a timer that is set and one at ``at``, which is set if it is the earlier."""
        timer = milliseconds(at)
        if wake is not None and wake <= timer:
            return wake
        self.handle.registerTimer(timer)
        return timer

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        due, later = [], []
        for (place,) in sorted(tuple(k) for k in self.held.keys()):
            if place * self.stretch > watermark:
                later.append(place * self.stretch)
                break
            events = [Event(*e) for e in self.held.getValue((place,))[0]]
            due += [e for e in events if e.at <= watermark]
            waiting = [tuple(e) for e in events if e.at > watermark]
            if waiting:
                self.held.updateValue((place,), (waiting,))
                later.append(min(e[0] for e in waiting))
            else:
                self.held.removeKey((place,))
        _, seen, expiry = self.clock.get() if self.clock.exists() else (None, None, None)
        wake = self.rings(None, min(later)) if later else None
        yield from self.advance(key, sorted(due, key=lambda e: (e.at, e.seq)), watermark)
        if self.ttl is not None and expiry is not None and expiry * 1000 <= watermark:
            if not later and seen + self.ttl <= watermark:
                self.clock.clear()
                self.forget()
                return
            expiry = self.rings(None, seen + self.ttl)
        if seen is not None:
            self.clock.update((wake, seen, expiry))

    def begin(self, handle):
        """Declare further state."""

    def forget(self):
        """Clear that state."""

    def advance(self, key, events: Iterable[Event], watermark: int) -> Iterator[Row]:
        raise NotImplementedError


class RisingAlerts(EventTimeOrder):
    """Alerts for keys whose value has not fallen for ``hold``."""

    fields = ("start_us", "fire_us")

    def __init__(self, keys, hold, kind="bigint", ttl=None):
        self.keys, self.hold, self.kind, self.ttl = keys, hold, kind, ttl

    def begin(self, handle):
        self.state = handle.getValueState("rising", f"timer bigint, value {self.kind}")

    def forget(self):
        self.state.clear()

    def advance(self, key, events, watermark):
        timer, last = self.state.get() if self.state.exists() else (None, None)
        named = dict(zip(self.keys, key))
        for event in events:
            if timer is not None and event.at > timer:
                yield self.alert(named, timer)
                timer = None
            if last is not None and event.value < last:
                timer = None
            elif timer is None:
                timer = event.at + self.hold
                self.handle.registerTimer(milliseconds(timer))
            last = event.value
        if timer is not None and timer <= watermark:
            yield self.alert(named, timer)
            timer = None
        if last is not None:
            self.state.update((timer, last))

    def alert(self, named, timer):
        return Row(**named, start_us=timer - self.hold, fire_us=timer, late_seq=None)


class TimesMatcher(EventTimeOrder):
    """Runs of ``least`` to ``most`` fitting rows from every start; rows that don't fit are skipped.

    The matches that are open share one buffer: each is a stretch of the last ``most`` - 1 fitting rows.
    """

    fields = ("start_no", "times", "events")

    def __init__(self, keys, least, most, within, ttl=None):
        self.keys, self.least, self.most, self.within, self.ttl = keys, least, most, within, ttl

    def begin(self, handle):
        self.buffer = handle.getValueState("buffer", "n bigint, rows array<struct<at bigint, payload string>>")

    def forget(self):
        self.buffer.clear()

    def advance(self, key, events, watermark):
        n, kept = self.buffer.get() if self.buffer.exists() else (0, [])
        kept, before = [tuple(e) for e in kept], n
        for event in events:
            if not event.marks[0]:
                continue
            n += 1
            kept = [*kept, (event.at, event.payload)][-self.most:]
            for times in range(self.least, min(self.most, len(kept)) + 1):
                if self.within is None or event.at < kept[-times][0] + self.within:
                    yield Row(**dict(zip(self.keys, key)), start_no=n - times + 1, times=times, events=[p for _, p in kept[-times:]], late_seq=None)
            kept = kept[-(self.most - 1):] if self.most > 1 else []
        if n > before:
            self.buffer.update((n, kept))


class SequenceMatcher(EventTimeOrder):
    """Matches and timed-out partial matches of a pattern.

    ``marks[0]`` tells whether a row can start a match, ``marks[k + 1]`` whether it fits step ``k``.
    """

    fields = ("matched", "events", "timeout_us")

    def __init__(self, keys, steps, within, ttl=None):
        self.keys, self.steps, self.within, self.ttl = keys, steps, within, ttl

    def begin(self, handle):
        self.partials = handle.getListState("partials", "step int, started bigint, events array<string>")

    def forget(self):
        self.partials.clear()

    def advance(self, key, events, watermark):
        partials = [tuple(p) for p in self.partials.get()] if self.partials.exists() else []
        before = list(partials)
        named = dict(zip(self.keys, key))
        for event in events:
            kept = []
            for partial in partials:
                if self.overdue(partial, event.at):
                    yield self.output(named, partial, False)
                    continue
                moved = self.move(partial, event)
                if moved is None:
                    continue
                if moved[0] == len(self.steps):
                    yield self.output(named, moved, True)
                else:
                    kept.append(moved)
            if event.marks[0]:
                fresh = (0, event.at, [event.payload])
                if not self.steps:
                    yield self.output(named, fresh, True)
                else:
                    kept.append(fresh)
                    if self.within is not None:
                        self.handle.registerTimer(milliseconds(event.at + self.within))
            partials = kept
        for partial in partials:
            if self.overdue(partial, watermark):
                yield self.output(named, partial, False)
        partials = [p for p in partials if not self.overdue(p, watermark)]
        if partials:
            self.partials.put(partials)
        elif before:
            self.partials.clear()

    def overdue(self, partial, now):
        return self.within is not None and now >= partial[1] + self.within

    def move(self, partial, event):
        """The partial match after ``event``; None when it is broken."""
        step, started, events = partial
        how, fits = self.steps[step], event.marks[step + 1]
        if how == NOT_NEXT:
            if fits:
                return None
            passed = (step + 1, started, events)
            return passed if step + 1 == len(self.steps) else self.move(passed, event)
        if how == NOT_FOLLOWED_BY:
            if event.marks[step + 2]:
                return step + 2, started, [*events, event.payload]
            return None if fits else partial
        if fits:
            return step + 1, started, [*events, event.payload]
        return None if how == NEXT else partial

    def output(self, named, partial, matched):
        deadline = None if self.within is None else partial[1] + self.within
        return Row(**named, matched=matched, events=list(partial[2]), timeout_us=deadline, late_seq=None)
