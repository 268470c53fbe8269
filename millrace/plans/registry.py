"""Queries by name, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register the decorated function under its own name."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle:
            ORACLES[function.__name__] = oracle
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Events as sensor readings: arrival number, sensor, event time, level."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("id"), "ts",
        F.floor("value").cast("int").alias("vc"))


READINGS = "r as (select event_id as seq, user_id as id, ts, cast(floor(value) as int) as vc from events)"


def all_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events of every type, without the unused columns."""
    return table(spark, folder, "events").select(F.col("event_id").alias("seq"), "user_id", "event_type", "ts")


def of_type(spark: SparkSession, folder: str, *types: str) -> DataFrame:
    """Events of the given types, without the unused columns."""
    events = table(spark, folder, "events").where(F.col("event_type").isin(*types))
    return events.select(F.col("event_id").alias("seq"), "user_id", "event_type", "ts")
