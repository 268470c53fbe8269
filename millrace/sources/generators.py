"""Seeded event sources: the same seed gives the same rows."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Fixed values of the marketing events.
BEHAVIORS = ["DOWNLOAD", "INSTALL", "UPDATE", "UNINSTALL"]
CHANNELS = ["XIAOMI", "HUAWEI", "OPPO", "VIVO", "APPSTORE"]


def sensor_events(spark: SparkSession, rows: int, seed: int = 0, start_ms: int = 0) -> DataFrame:
    """Readings of three sensors with levels 40..49, one per second."""
    draw = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(n))
    return spark.range(rows).select(
        F.concat(F.lit("sensor_"), draw(1, 3)).alias("id"),
        (F.lit(start_ms) + F.col("id") * 1000).alias("ts"), (draw(2, 10) + 40).cast("int").alias("vc"))


def marketing_events(spark: SparkSession, rows: int, seed: int = 0, start_ms: int = 0) -> DataFrame:
    """Application events: a user, one of four behaviours, one of five channels, one per second."""
    draw = lambda salt: F.xxhash64("id", F.lit(seed), F.lit(salt))
    pick = lambda values, salt: F.element_at(F.array(*map(F.lit, values)), (F.pmod(draw(salt), F.lit(len(values))) + 1).cast("int"))
    return spark.range(rows).select(
        draw(1).alias("user_id"), pick(BEHAVIORS, 2).alias("behavior"), pick(CHANNELS, 3).alias("channel"),
        (F.lit(start_ms) + F.col("id") * 1000).alias("ts"))


class SensorReader(DataSourceStreamReader):
    """Rows fall due by the clock, ``rowsPerSecond`` of them since ``start`` (epoch seconds).

    A row depends on the seed and its number only, so executors can make any range again.
    """

    def __init__(self, options):
        self.seed = int(options.get("seed", "0"))
        self.rate = int(options.get("rowsPerSecond", "1"))
        self.start = float(options.get("start", time.time()))
        self.total = int(options.get("rows", "0"))  # 0: no end
        self.parts = int(options.get("numPartitions", "4"))

    def initialOffset(self):
        return {"row": 0}

    def latestOffset(self):
        due = int(max(0.0, time.time() - self.start) * self.rate)
        return {"row": min(due, self.total) if self.total else due}

    def partitions(self, start, end):
        step = max(1, -(-(end["row"] - start["row"]) // self.parts))
        return [InputPartition((low, min(low + step, end["row"]))) for low in range(start["row"], end["row"], step)]

    def read(self, partition):
        from random import Random

        for n in range(*partition.value):
            draw = Random(self.seed * 1_000_003 + n)
            yield f"sensor_{draw.randrange(3)}", n * 1000, 40 + draw.randrange(10)


class SensorSource(DataSource):
    """Unbounded sensor readings as ``readStream.format("sensors")``; replayable from any offset."""

    @classmethod
    def name(cls):
        return "sensors"

    def schema(self):
        return "id string, ts bigint, vc int"

    def streamReader(self, schema):
        return SensorReader(self.options)


def stream_sensors(spark: SparkSession, **options) -> DataFrame:
    spark.dataSource.register(SensorSource)
    reader = spark.readStream.format("sensors")
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load()
