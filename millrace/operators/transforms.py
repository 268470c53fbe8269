"""Row-wise operators: reshaping, tagging, routing, repartitioning and co-streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.functions.spans import literal


def split_words(df: DataFrame, text: str, word="word", sep=" ") -> DataFrame:
    """One row per ``sep``-separated token; trailing empty tokens are cut, inner ones are kept."""
    kept = F.rtrim(F.col(text), F.lit(sep))
    tokens = F.when((kept != "") | (F.col(text) == ""), F.split(kept, literal(sep)))
    return df.select(*[c for c in df.columns if c != text], F.explode(tokens).alias(word))


def expand_where(df: DataFrame, array: Column, keep: Callable[[Column], Column], name: str) -> DataFrame:
    """Flat map with a condition: the elements of ``array`` that satisfy ``keep``."""
    return df.select(*df.columns, F.explode(F.filter(array, keep)).alias(name))


def with_tags(df: DataFrame, tags: Mapping[str, Column], name="tags") -> DataFrame:
    """An array column with every tag whose condition holds."""
    marks = [F.when(cond, F.lit(tag)) for tag, cond in tags.items()]
    return df.withColumn(name, F.filter(F.array(*marks), lambda t: t.isNotNull()))


def tagged(df: DataFrame, tag: str, name="tags") -> DataFrame:
    return df.where(F.array_contains(name, tag))


def side_output(df: DataFrame, when: Column, *alarm: Column) -> tuple[DataFrame, DataFrame]:
    """Main output (all rows) and the alarm output (rows where ``when`` holds)."""
    return df, df.where(when).select(*(alarm or ["*"]))


def append_key(df: DataFrame, value: Column, *keys: str, name="keyed") -> DataFrame:
    return df.withColumn(name, F.concat_ws("", value.cast("string"), *[F.col(k).cast("string") for k in keys]))


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union of frames of the same type."""
    return reduce(DataFrame.unionByName, frames)


def connect(left: DataFrame, right: DataFrame,
            on_left: Sequence[Column], on_right: Sequence[Column]) -> DataFrame:
    """Two differently typed inputs, each with its own mapping, merged into one output."""
    return left.select(*on_left).unionByName(right.select(*on_right), allowMissingColumns=True)


def tagged_union(left: DataFrame, right: DataFrame, side="side",
                 names=("left", "right")) -> DataFrame:
    """Both inputs as one, with the name of the side; missing columns are null."""
    return left.withColumn(side, F.lit(names[0])).unionByName(
        right.withColumn(side, F.lit(names[1])), allowMissingColumns=True)


def map_with_setup(df: DataFrame, schema: str, setup: Callable[[], object],
                   apply: Callable[[object, pd.DataFrame], pd.DataFrame],
                   teardown: Callable[[object], None] = lambda resource: None) -> DataFrame:
    """Map with a resource opened once per task and closed at its end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup()
        try:
            for batch in batches:
                yield apply(resource, batch)
        finally:
            teardown(resource)

    return df.mapInPandas(run, schema)


def counted(df: DataFrame, name="rows") -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that can be read once an action has run."""
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias(name)), observation
