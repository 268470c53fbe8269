"""External tables and message queues."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_table(spark: SparkSession, name: str, path: str, fields: Mapping[str, str], sep=",") -> DataFrame:
    """Register delimited files as a table of the session's catalog, for reading and appending."""
    columns = ", ".join(f"`{n}` {t}" for n, t in fields.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING csv OPTIONS (sep '{sep}') LOCATION '{path}'")
    return spark.table(f"`{name}`")


def use_catalog(spark: SparkSession, catalog: str, database: str | None = None) -> None:
    spark.catalog.setCurrentCatalog(catalog)
    if database:
        spark.catalog.setCurrentDatabase(database)


def stream_kafka(spark: SparkSession, servers: str, topic: str, starting="earliest") -> DataFrame:
    """String values of a topic. Offsets live in the query's checkpoint; needs Spark's Kafka package."""
    rows = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).load())
    return rows.select(F.col("value").cast("string").alias("value"))
