"""Window join, interval join, reconciliation, NOT IN."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.spans import floor_time, interval
from millrace.operators.ordered import latest, ordered, previous, total


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, size: timedelta) -> DataFrame:
    """Inner join of rows with equal keys in the same tumbling window.

    The right side's other columns must have names of their own; its ``ts`` comes back as
    ``right_<ts>``.
    """
    mark = lambda df: df.withColumn("window_start", floor_time(ts, size))
    right = mark(right).withColumnRenamed(ts, f"right_{ts}")
    return mark(left).join(right, [*keys, "window_start"])


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                  lower: timedelta, upper: timedelta) -> DataFrame:
    """Pairs with equal keys and ``left_ts + lower <= right_ts <= left_ts + upper``.

    Time buckets as wide as the range join the key, so that a key spreads over tasks and only neighbouring buckets are compared.
    """
    in_range = F.col(right_ts).between(F.col(left_ts) + interval(lower), F.col(left_ts) + interval(upper))
    width = max(upper - lower, timedelta(microseconds=1))
    ends = F.array(*(floor_time(F.col(left_ts) + interval(shift), width) for shift in (lower, upper)))
    left = left.withColumn("__bucket", F.explode(F.array_distinct(ends)))
    right = right.withColumn("__bucket", floor_time(right_ts, width))
    return left.join(right, [*keys, "__bucket"]).where(in_range).drop("__bucket")


def reconcile(left: DataFrame, right: DataFrame, key: str, left_order: str | Sequence[str], right_order: str | Sequence[str],
              max_rows: int | None = None) -> DataFrame:
    """Match two sides one to one on ``key``, in one order of arrival over both; rows without a partner keep null on the other side.

    As with a keyed cache, a row waits for the other side, a newer row of its own side takes its place, and a match uses up both.
    The two orders are columns of equal types; of equal ones the left side comes first. Empty and null keys never match and are left
    out. Returns ``key, left, right`` (structs): the matches, and for each key what waits at the end.

    Arrivals fall into runs of one side. The first row of a run matches when the run before left a row waiting, and that is its last
    one. After a run a row waits unless the run was that one matching row; so a longer run starts the count anew and single
    rows alternate.
    """
    listed = lambda names: [names] if isinstance(names, str) else list(names)
    places = [f"__o{i}" for i in range(len(listed(left_order)))]

    def side(df, order, number):
        named = F.col(key) != "" if dict(df.dtypes)[key] == "string" else F.col(key).isNotNull()
        row = lambda mine, frame: (F.struct(*frame.columns) if mine else F.lit(None))
        return df.where(named).select(F.col(key).alias("__key"), F.lit(number).alias("__side"), *[F.col(o).alias(p) for o, p in zip(listed(order), places)],
                                      row(number == 0, df).alias("__left"), row(number == 1, df).alias("__right"))

    both = side(left, left_order, 0).unionByName(side(right, right_order, 1))
    order = [*places, "__side"]
    rows = ordered(both, ["__key"], order, max_rows).running({"__before": previous("__side")}, exclusive=True)
    rows = rows.with_columns({"__turn": (F.col("__before").isNull() | (F.col("__before") != F.col("__side"))).cast("bigint")})
    rows = rows.running({"__run": total("__turn")}).to_df()
    at = F.struct(*order)
    ends = [pick(F.struct(f"__{s}"), at).alias(f"__{name}_{s}") for pick, name in ((F.min_by, "first"), (F.max_by, "last")) for s in ("left", "right")]
    runs = rows.groupBy("__key", "__run").agg(F.min("__side").alias("__side"), F.count(F.lit(1)).alias("__n"), *ends)
    runs = runs.withColumn("__long", F.when(F.col("__n") > 1, F.col("__run")))
    runs = ordered(runs, ["__key"], ["__run"], max_rows).running(
        {"__reset": latest("__long"), "__last": previous(F.struct("__last_left", "__last_right"))}, exclusive=True)
    waiting = F.when(F.col("__reset").isNull(), F.col("__run") % 2 == 0).otherwise((F.col("__run") - F.col("__reset")) % 2 == 1)
    runs = runs.with_columns({"__matched": waiting}).running({"__next": previous("__run")}, reverse=True, exclusive=True).to_df()
    one = lambda s: F.coalesce(F.col(f"__first_{s}")[f"__{s}"], F.col("__last")[f"__last_{s}"][f"__{s}"]).alias(s)
    found = runs.where("__matched").select(F.col("__key").alias(key), one("left"), one("right"))
    open_ = runs.where(F.col("__next").isNull() & ((F.col("__n") > 1) | ~F.col("__matched")))
    end = lambda s: F.col(f"__last_{s}")[f"__{s}"].alias(s)
    return found.unionByName(open_.select(F.col("__key").alias(key), end("left"), end("right")))


def matches(reconciled: DataFrame) -> DataFrame:
    return reconciled.where(F.col("left").isNotNull() & F.col("right").isNotNull())


def gaps(reconciled: DataFrame) -> DataFrame:
    """Keys present on one side only, with the name of that side."""
    side = F.when(F.col("right").isNull(), "left").otherwise("right")
    return reconciled.where(F.col("left").isNull() | F.col("right").isNull()).select(
        reconciled.columns[0], side.alias("side"))


def not_in(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """SQL ``column NOT IN (values)`` as a shuffled anti join.

    Spark plans NOT IN as a broadcast of the list; this form also holds for a list of any size.
    A null in the list leaves no row; a null in ``column`` passes only an empty list.
    """
    listed = values.select(F.col(values.columns[0]).alias("__v"))
    sizes = listed.agg(F.struct(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("__v").isNull()).alias("nulls"))).scalar()
    kept = df.join(listed.distinct(), F.col(column) == F.col("__v"), "left_anti")
    return kept.where((sizes["nulls"] == 0) & (F.col(column).isNotNull() | (sizes["rows"] == 0)))
