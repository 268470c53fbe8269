"""Running computations over an order within each key, safe for hot keys.

A plain window puts every row of a key into one task. Here the rows of each key are counted
first. Keys that fit the bound keep the plain window. The rows of larger keys are range
partitioned on (key, order), so that one key spreads over many chunks; a window runs inside each
chunk, and what the earlier chunks leave behind is carried in from a table with one row per chunk.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.checkpoints import reliable

MAX_ROWS = 1 << 18  # rows of one key that a single task may hold, unless MAX_ROWS_CONF says otherwise
MAX_ROWS_CONF = "spark.millrace.maxRowsPerKey"
BROADCAST_BYTES = 32 << 20  # largest helper table sent to every executor, measured as text

CHUNK = "__chunk"


@dataclass(frozen=True)
class Run:
    """One running value: how to fold it inside a chunk and how to join chunks."""

    kind: str
    value: Column

    def fold(self) -> Column:
        return {
            "sum": F.sum,
            "count": F.count,
            "max": F.max,
            "min": F.min,
            "first": lambda c: F.first(F.struct(c.alias("v"))),
            "latest": lambda c: F.last(c, ignorenulls=True),
            "previous": lambda c: F.last(F.struct(c.alias("v"))),
        }[self.kind](self.value)

    def fold_chunks(self, name: str) -> Column:
        column = F.col(name)
        return {
            "sum": F.sum(column),
            "count": F.sum(column),
            "max": F.max(column),
            "min": F.min(column),
            "first": F.first(column, ignorenulls=True),
            "latest": F.last(column, ignorenulls=True),
            "previous": F.last(column, ignorenulls=True),
        }[self.kind]

    def combine(self, carried: Column, local: Column) -> Column:
        if self.kind == "sum":
            return F.coalesce(carried + local, carried, local)
        if self.kind == "count":
            return F.coalesce(carried, F.lit(0)) + local
        if self.kind == "max":
            return F.greatest(carried, local)
        if self.kind == "min":
            return F.least(carried, local)
        if self.kind == "first":
            return F.coalesce(carried, local)
        return F.coalesce(local, carried)

    def unwrap(self, column: Column) -> Column:
        return column["v"] if self.kind in ("first", "previous") else column


def total(value) -> Run:
    return Run("sum", _col(value))


def count(value=None) -> Run:
    return Run("count", F.lit(1) if value is None else _col(value))


def highest(value) -> Run:
    return Run("max", _col(value))


def lowest(value) -> Run:
    return Run("min", _col(value))


def first(value) -> Run:
    """The value of the key's first row, null or not."""
    return Run("first", _col(value))


def latest(value) -> Run:
    """The newest value that is not null."""
    return Run("latest", _col(value))


def previous(value) -> Run:
    """The value of the row before (use with ``exclusive=True``)."""
    return Run("previous", _col(value))


@dataclass(frozen=True)
class Ordered:
    """Rows with keys and an order; build with :func:`ordered`."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: bool

    def running(self, columns: Mapping[str, Run], reverse=False, exclusive=False) -> Ordered:
        """Add running values over the rows up to here (``exclusive``: before here).

        ``reverse`` walks each key from its last row, which gives "first later row" lookups
        without the quadratic cost of a frame that is open at its end.
        """
        sort = [F.col(c).desc() if reverse else F.col(c).asc() for c in self.order]
        group = [*self.keys, CHUNK] if self.split else list(self.keys)
        base = Window.partitionBy(*group).orderBy(*sort)
        start = Window.unboundedPreceding
        frame = base.rowsBetween(start, -1 if exclusive else 0)
        if not self.split:
            return replace(self, df=self.df.withColumns(
                {n: r.unwrap(r.fold().over(frame)) for n, r in columns.items()}))

        whole = base.rowsBetween(start, 0)
        ends = self.df.where(F.col(CHUNK) > 0).select(
            *self.keys, CHUNK,
            *[r.fold().over(whole).alias(n) for n, r in columns.items()],
            F.lead(F.lit(1)).over(base).isNull().alias("__end"),
        ).where("__end")
        by_chunk = F.col(CHUNK).desc() if reverse else F.col(CHUNK).asc()
        before = Window.partitionBy(*self.keys).orderBy(by_chunk).rowsBetween(start, -1)
        carried = reliable(ends.select(
            *[F.col(k).alias(f"__k_{k}") for k in self.keys], F.col(CHUNK).alias("__k_chunk"),
            *[r.fold_chunks(n).over(before).alias(f"__c_{n}") for n, r in columns.items()]))
        local = self.df.withColumns({f"__l_{n}": r.fold().over(frame) for n, r in columns.items()})
        joined = local.join(
            small(carried),
            reduce(Column.__and__, [F.col(CHUNK) == F.col("__k_chunk")]
                   + [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in self.keys]), "left")
        out = joined.withColumns(
            {n: r.unwrap(r.combine(F.col(f"__c_{n}"), F.col(f"__l_{n}"))) for n, r in columns.items()})
        names = list(dict.fromkeys([*self.df.columns, *columns]))
        return replace(self, df=out.select(*names))

    def with_columns(self, columns: Mapping[str, Column]) -> Ordered:
        return replace(self, df=self.df.withColumns(dict(columns)))

    def to_df(self) -> DataFrame:
        return self.df.drop(CHUNK)


def ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int | None = None) -> Ordered:
    """Prepare ``df`` for running values by ``order`` within ``keys`` (no keys: the whole table).

    The order must be unique within a key.
    """
    keys, order = tuple(keys), tuple(order)
    max_rows = max_rows or row_limit(df)
    hot = hot_keys(df, keys, max_rows)
    if hot is None:
        return Ordered(df, keys, order, split=False)
    rows = hot.agg(F.sum("__rows")).first()[0]
    chunks = math.ceil(rows / max_rows) + 1
    if keys:
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
        marked = small(hot.drop("__rows"))
        large, cold = df.join(marked, same, "left_semi"), df.join(marked, same, "left_anti")
    else:
        large, cold = df, None
    large = reliable(large.repartitionByRange(chunks, *keys, *order)
                     .withColumn(CHUNK, F.spark_partition_id() + 1))
    both = large if cold is None else large.unionByName(cold.withColumn(CHUNK, F.lit(0)))
    return Ordered(both, keys, order, split=True)


def row_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(MAX_ROWS_CONF, str(MAX_ROWS)))


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int | None = None) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows and their row counts, or None when there are none.

    At most (rows of the table / ``max_rows``) keys can qualify.
    """
    max_rows = max_rows or row_limit(df)
    rows = df.select(*keys).count()
    if rows <= max_rows:
        return None
    if not keys:
        return df.sparkSession.range(1).select(F.lit(rows).alias("__rows"))
    counts = (df.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys])
              .agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > max_rows))
    if counts.isEmpty():
        return None
    return reliable(counts)


def small(df: DataFrame) -> DataFrame:
    """Hint a broadcast when the measured size allows it; otherwise leave the join to Spark."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("bigint"))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value
