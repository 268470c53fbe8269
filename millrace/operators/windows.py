"""Time, session and count windows."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from datetime import timedelta
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from millrace.functions.spans import common, floor_time, interval, text
from millrace.operators.ordered import count, latest, ordered, previous

# How rows are folded, and how the values of two panes of the same window combine. A "sketch" counts distinct values, roughly; "bits" is a
# bitmap of positions within a bucket.
MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max, "sketch": F.hll_union_agg, "bits": F.bitmap_or_agg}
FOLDS = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "sketch": F.hll_sketch_agg, "bits": F.bitmap_construct_agg}

STRETCH = 8  # sliding windows are summed in stretches of time this many windows long
MOST_FOUND = 10_000  # rows of a function over whole windows that go back to Spark at once

# name -> (count | sum | min | max | sketch | bits, column); a count without a column counts rows.
Folds = Mapping[str, tuple[str, Column | str | None]]


def _fold(aggs: Folds) -> list[Column]:
    return [FOLDS[kind](F.lit(1) if value is None else value).alias(name) for name, (kind, value) in aggs.items()]


def _merge(aggs: Folds) -> list[Column]:
    return [MERGES[kind](name).alias(name) for name, (kind, _) in aggs.items()]


def tumbling(df: DataFrame, ts: str, size: timedelta, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Epoch-aligned windows ``[start, end)``; without keys, one row per window."""
    return _bounds(df.groupBy(F.window(ts, text(size)), *keys).agg(*aggs))


def sliding(df: DataFrame, ts: str, size: timedelta, slide: timedelta, keys: Sequence[str],
            aggs: Folds) -> DataFrame:
    """Sliding windows.

    Rows are first folded into panes that no window cuts, so a hot key shrinks to one row per pane
    and task before the first shuffle. The panes, not their size/slide copies, then move to the
    task that owns their key and stretch of time; the copies are made and summed there.
    """
    pane, stretch = common(size, slide), STRETCH * size
    copies = -(-size // slide)
    panes = df.groupBy(F.window(ts, text(pane))["start"].alias("__pane"), *keys).agg(*_fold(aggs))
    panes = panes.withColumn("__newest", F.col("__pane") if pane == slide else floor_time("__pane", slide))
    panes = panes.withColumn("__oldest", F.col("__newest") - interval((copies - 1) * slide))
    panes = panes.withColumn("__hi", floor_time("__newest", stretch))
    panes = panes.withColumn("__lo", floor_time("__oldest", stretch))
    owned = panes.withColumn("__stretch", F.explode(F.array_distinct(F.array("__lo", "__hi"))))
    # A fixed number of partitions: sizes seen before the copies are made would merge too many.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owned = owned.drop("__oldest", "__hi", "__lo").repartition(tasks, *keys, "__stretch")
    copied = owned.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("__back"))
    start = F.col("window_start")
    copied = copied.withColumn("window_start", F.col("__newest") - F.col("__back") * interval(slide)).where(
        (start >= F.col("__stretch")) & (start < F.col("__stretch") + interval(stretch)))
    if size % slide:
        copied = copied.where(start + interval(size) > F.col("__pane"))
    out = copied.groupBy("window_start", "__stretch", *keys).agg(*_merge(aggs))
    return out.select("window_start", (start + interval(size)).alias("window_end"), *keys, *aggs)


def sessions(df: DataFrame, ts: str, gap: timedelta, keys: Sequence[str],
             aggs: Folds) -> DataFrame:
    """Session windows ``[first, last + gap)``; windows that touch merge.

    Two rows of a key in the same gap-wide pane always share a session, so rows fold into panes
    first: a key then has at most one row per gap of time, whatever the row count. A long history is split like any hot key.
    Rows without a time have no window.
    """
    panes = df.groupBy(F.window(ts, text(gap))["start"].alias("__pane"), *keys).agg(
        F.min(ts).alias("__lo"), F.max(ts).alias("__hi"),
        *_fold(aggs))
    last_end = F.col("__before") + interval(gap)
    opened = ordered(panes, keys, ["__pane"]).running({"__before": previous("__hi")}, exclusive=True).with_columns(
        {"__new": F.when(last_end.isNull() | (F.col("__lo") > last_end), F.col("__lo"))})
    marked = opened.running({"window_start": latest("__new")}).to_df()
    out = marked.groupBy(*keys, "window_start").agg(
        F.max("__hi").alias("__hi"),
        *_merge(aggs))
    return out.select("window_start", (F.col("__hi") + interval(gap)).alias("window_end"), *keys, *aggs)


def count_tumbling(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int,
                   *aggs: Column, max_rows: int | None = None) -> DataFrame:
    """A window for every ``size`` rows of a key; an incomplete tail is not emitted."""
    numbered = ordered(df, keys, order, max_rows).running({"__rn": count()}).to_df()
    groups = numbered.groupBy(*keys, F.floor((F.col("__rn") - 1) / size).alias("window_no"))
    return groups.agg(*aggs, F.count(F.lit(1)).alias("__n")).where(F.col("__n") == size).drop("__n")


def count_sliding(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, slide: int,
                  *aggs: Column, max_rows: int | None = None) -> DataFrame:
    """Fires at every ``slide``-th row of a key over its last ``size`` rows (fewer at the start)."""
    numbered = ordered(df, keys, order, max_rows).running({"__rn": count()}).to_df()
    rn = F.col("__rn")
    from_, to = F.ceil(rn / slide) * slide, F.floor((rn + size - 1) / slide) * slide
    fires = F.when(from_ <= to, F.sequence(from_, to, F.lit(slide).cast("bigint")))
    spread = numbered.withColumn("fired_at", F.explode(fires))
    out = spread.groupBy(*keys, "fired_at").agg(*aggs, F.max("__rn").alias("__last"))
    return out.where(F.col("__last") == F.col("fired_at")).drop("__last")


def count_sliding_panes(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, slide: int, aggs: Folds,
                        max_rows: int | None = None) -> DataFrame:
    """`count_sliding` for aggregates that merge: rows fold into panes that no window cuts, and panes are copied instead of rows."""
    pane = math.gcd(size, slide)
    numbered = ordered(df, keys, order, max_rows).running({"__rn": count()}).to_df()
    at = F.floor((F.col("__rn") - 1) / pane).alias("__pane")
    panes = numbered.groupBy(*keys, at).agg(*_fold(aggs), F.count(F.lit(1)).alias("__rows"))
    end = (F.col("__pane") + 1) * pane  # the row that fills the pane
    from_, to = F.ceil(end / slide) * slide, F.floor((end + size - pane) / slide) * slide
    fires = F.when(from_ <= to, F.sequence(from_, to, F.lit(slide).cast("bigint")))
    copied = panes.withColumn("fired_at", F.explode(fires)).withColumn("__filled", (end == F.col("fired_at")) & (F.col("__rows") == pane))
    out = copied.groupBy(*keys, "fired_at").agg(*_merge(aggs), F.max("__filled").alias("__fires"))
    return out.where("__fires").drop("__fires")


def _bounds(df: DataFrame) -> DataFrame:
    others = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *others)


def _cut(batches: Iterable[pa.RecordBatch], named: Sequence[str]) -> Iterator[tuple]:
    """Sorted rows, cut where a window begins: the window's number in the task, the keys of all windows that begin in its batch (as rows and
    as values) with its place there, and a piece of its rows. Only a window's first piece has the right keys."""
    number = 0
    for batch in batches:
        first = batch.column("__first").to_pylist()
        cuts = [k for k, f in enumerate(first) if f or not k]
        rows = batch.drop_columns("__first")
        heads = rows.select(named).filter(batch.column("__first"))
        values = list(zip(*(c.to_pylist() for c in heads.columns)))
        place = -1
        for a, b in zip(cuts, [*cuts[1:], len(first)]):
            number, place = number + first[a], place + first[a]
            yield number, (heads, values, place), rows.slice(a, b - a)


def processed(df: DataFrame, ts: str, size: timedelta, keys: Sequence[str], function: Callable[[tuple, Iterator[pa.RecordBatch]], Iterable[tuple]],
              schema: str) -> DataFrame:
    """A user function over each whole window: ``function(key, batches)`` gives rows of ``schema`` from the window's rows.

    ``key`` is (start, end, *keys). The rows come in order of time as Arrow batches, one after the other, so a task never holds a window
    whole; what the function keeps is its own. All rows of a (window, key) go to one task: what `sliding` and `tumbling` can fold should go there.
    Small windows share a batch on their way to Python and back, because a stream of batches for each of them takes far longer than their rows.
    """
    rows = df.where(F.col(ts).isNotNull()).withColumn("__w", F.window(ts, text(size)))
    rows = rows.select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *df.columns)
    named = ["window_start", "window_end", *keys]
    rows = rows.withColumn("__first", F.row_number().over(Window.partitionBy(*named).orderBy(ts)) == 1)
    types = dict(rows.dtypes)
    made = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in DataType.fromDDL(schema).fields])

    def batch_of(heads: pa.RecordBatch, places: list[int], found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found) if found else [[] for _ in made]
        own = heads.take(pa.array(places, pa.int64()))
        return pa.RecordBatch.from_arrays([*own.columns, *[pa.array(c, f.type) for c, f in zip(columns, made)]], [*named, *made.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, places, found = None, [], []
        for _, pieces in groupby(_cut(batches, named), key=lambda piece: piece[0]):
            _, (heads, values, place), rows = next(pieces)
            if heads is not held:
                if found:
                    yield batch_of(held, places, found)
                held, places, found = heads, [], []
            for row in function(values[place], chain([rows], (more for *_, more in pieces))):
                places.append(place)
                found.append(row)
                if len(found) == MOST_FOUND:
                    yield batch_of(held, places, found)
                    places, found = [], []
        if found:
            yield batch_of(held, places, found)

    out = ", ".join(f"`{k}` {types[k]}" for k in named)
    return rows.mapInArrow(run, f"{out}, {schema}")
