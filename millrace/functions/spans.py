"""Durations and small column helpers."""

import re
from datetime import timedelta
from math import gcd

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROSECOND = timedelta(microseconds=1)


def micros(span: timedelta) -> int:
    return span // MICROSECOND


def text(span: timedelta) -> str:
    """The duration as Spark's window functions read it."""
    return f"{micros(span)} microseconds"


def interval(span: timedelta) -> Column:
    return F.expr(f"INTERVAL '{micros(span) / 1e6:.6f}' SECOND")


def common(a: timedelta, b: timedelta) -> timedelta:
    """The longest duration that divides both."""
    return gcd(micros(a), micros(b)) * MICROSECOND


def floor_time(ts, span: timedelta) -> Column:
    """Start of the epoch-aligned bucket that holds ``ts`` (keeps the timestamp type; null for null, and no row is lost)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    past = F.pmod(epoch_micros(ts), F.lit(micros(span)))
    return ts - F.expr("INTERVAL '0.000001' SECOND") * past


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970; those of the wall clock for a timestamp without zone."""
    instant = ts.cast("timestamp")
    local = F.from_utc_timestamp(instant, F.current_timezone())
    return F.unix_micros(F.when(F.typeof(ts) == "timestamp_ntz", local).otherwise(instant))


def literal(separator: str) -> str:
    """A pattern that matches just this text; plain where it has no special characters, which splits faster."""
    return separator if re.fullmatch(r"[\w ,;:]*", separator) else re.sub(r"(\W)", r"\\\1", separator)
