"""User-defined aggregates with separate accumulator and result types."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLUSH_KEYS = 50_000  # accumulators held by a task before they are passed on


class AggregateFunction(Protocol):
    """Accumulators and results are tuples in the order of their schema."""

    accumulator_schema: str
    result_schema: str

    def create(self) -> tuple: ...
    def add(self, accumulator: tuple, rows: pd.DataFrame) -> tuple: ...
    def merge(self, a: tuple, b: tuple) -> tuple: ...
    def result(self, accumulator: tuple) -> tuple: ...


def aggregate_with(df: DataFrame, keys: Sequence[str], function: AggregateFunction) -> DataFrame:
    """Two phases, like a built-in aggregate: ``add`` runs before the shuffle, ``merge`` after it.

    The shuffle carries one accumulator per key and task, so no task receives the rows of a key. Built-in aggregates come first: this
    one is for accumulators that they can't express. Integer keys travel as text, since pandas would make those beside a null inexact.
    """
    named, types = list(keys), dict(df.dtypes)
    keys = [f"__key{i}" for i in range(len(named))]
    sent = ["string" if types[k] in ("tinyint", "smallint", "int", "bigint") else types[k] for k in named]
    df = df.withColumns({k: F.col(n).cast(t) for k, n, t in zip(keys, named, sent)})
    key_schema = ", ".join(f"`{k}` {t}" for k, t in zip(keys, sent))
    fields = [part.split()[0] for part in function.accumulator_schema.split(",")]
    results = [part.split()[0] for part in function.result_schema.split(",")]

    def plain(key: tuple) -> tuple:
        return tuple(None if pd.isna(v) else v for v in key)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            for key, rows in batch.groupby(keys, dropna=False, sort=False):
                key = plain(key)
                held[key] = function.add(held.get(key) or function.create(), rows)
            if len(held) >= FLUSH_KEYS:
                yield pd.DataFrame([(*k, *a) for k, a in held.items()], columns=[*keys, *fields])
                held = {}
        yield pd.DataFrame([(*k, *a) for k, a in held.items()], columns=[*keys, *fields])

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, None
        for batch in batches:
            done = []
            for row in batch[[*keys, *fields]].itertuples(index=False, name=None):
                here, accumulator = plain(row[:len(keys)]), row[len(keys):]
                if held is not None and here == key:
                    held = function.merge(held, accumulator)
                    continue
                if held is not None:
                    done.append((*key, *function.result(held)))
                key, held = here, accumulator
            yield pd.DataFrame(done, columns=[*keys, *results])
        if held is not None:
            yield pd.DataFrame([(*key, *function.result(held))], columns=[*keys, *results])

    partial = df.mapInPandas(fold, f"{key_schema}, {function.accumulator_schema}")
    sorted_ = partial.repartition(*keys).sortWithinPartitions(*keys)
    out = sorted_.mapInPandas(merge, f"{key_schema}, {function.result_schema}")
    return out.select(*[F.col(k).cast(types[n]).alias(n) for k, n in zip(keys, named)], *[c for c in out.columns if c not in keys])
