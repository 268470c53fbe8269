"""Sinks: files, JDBC tables, keyed stores, document files, Kafka, console."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def write_csv(df: DataFrame, path: str, sep=",", mode="append") -> None:
    df.write.mode(mode).option("sep", sep).csv(path)


def insert_into(df: DataFrame, table: str) -> None:
    """Append to a catalog table, by position."""
    df.write.insertInto(table)


def labelled(df: DataFrame, label: str) -> DataFrame:
    return df.select(F.lit(label).alias("label"), *df.columns)


def print_stream(df: DataFrame, label: str | None = None, mode="append") -> DataStreamWriter:
    return (labelled(df, label) if label else df).writeStream.outputMode(mode).format("console")


def append_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    """Append rows over JDBC, one connection and prepared insert per partition."""
    df.write.mode("append").options(**options).jdbc(url, table)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key."""
    newest = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(newest).select("__row.*")


def upsert_keyed(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 open_store: Callable[[], object], put: Callable[[object, pd.DataFrame], None],
                 close: Callable[[object], None] = lambda store: None) -> None:
    """Write the newest row per key to a keyed store.

    ``open_store`` runs once per task, ``put`` once per batch of rows. Writing a key again gives
    the same state, so a retried task does no harm.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        store, n = open_store(), 0
        try:
            for batch in batches:
                put(store, batch)
                n += len(batch)
        finally:
            close(store)
        yield pd.DataFrame({"rows": [n]})

    newest = last_per_key(df, keys, order)
    newest.mapInPandas(run, "rows bigint").agg(F.sum("rows")).write.format("noop").mode("overwrite").save()


def append_version(df: DataFrame, keys: Sequence[str], order: Sequence[str], path: str, batch_id: int) -> None:
    """Upsert as a log: each batch adds its newest row per key under its own number.

    The cost follows the batch, not the table. A repeated batch replaces its own version.
    """
    last_per_key(df, keys, order).write.mode("overwrite").parquet(f"{path}/version={batch_id}")


def latest_version(spark: SparkSession, keys: Sequence[str], path: str) -> DataFrame:
    """The newest row per key of such a log."""
    return last_per_key(spark.read.parquet(path), keys, ["version"]).drop("version")


def as_documents(df: DataFrame) -> DataFrame:
    """One JSON document per row: ``{"data": "<fields>"}``."""
    text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns])
    return df.select(F.to_json(F.struct(text.alias("data"))).alias("value"))


def index_documents(df: DataFrame, post: Callable[[Sequence[str]], None], bulk: int = 1000) -> None:
    """Send documents in groups of at most ``bulk``, from every partition."""

    def send(rows) -> None:
        group = []
        for row in rows:
            group.append(row[0])
            if len(group) == bulk:
                post(group)
                group = []
        if group:
            post(group)

    as_documents(df).foreachPartition(send)


def write_documents(df: DataFrame, path: str, mode="append") -> None:
    """Documents as newline-delimited JSON files."""
    as_documents(df).write.mode(mode).text(path)


def kafka_writer(df: DataFrame, servers: str, topic: str, value="value") -> DataStreamWriter:
    """Raw string values to a topic; needs Spark's Kafka package and a checkpoint location."""
    return (df.select(F.col(value).cast("string").alias("value")).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic))
