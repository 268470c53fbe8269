"""Text lines and their parsers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.spans import literal

# Record layouts (fixed values).
SENSOR = {"id": "string", "ts": "bigint", "vc": "int"}
USER_BEHAVIOR = {"user_id": "bigint", "item_id": "bigint", "category_id": "int", "behavior": "string", "ts": "bigint"}
AD_CLICK = {"user_id": "bigint", "ad_id": "bigint", "province": "string", "city": "string", "ts": "bigint"}
LOGIN = {"user_id": "bigint", "ip": "string", "event_type": "string", "ts": "bigint"}
ORDER = {"order_id": "bigint", "event_type": "string", "tx_id": "string", "ts": "bigint"}
RECEIPT = {"tx_id": "string", "channel": "string", "ts": "bigint"}

ACCESS_TIME = "dd/MM/yyyy:HH:mm:ss"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines of a socket (a source for trials: it cannot replay after a failure)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def parse_csv(lines: DataFrame, fields: Mapping[str, str], sep=",", value="value") -> DataFrame:
    """Cut each line at ``sep`` and cast by position; a bad number fails the job.

    An empty field stays an empty string, which the CSV reader would turn into null.
    """
    parts = F.split(F.col(value), literal(sep))
    return lines.select(*[parts[i].cast(kind).alias(name) for i, (name, kind) in enumerate(fields.items())])


def parse_access_log(lines: DataFrame, value="value") -> DataFrame:
    """Web server log lines: fields 0, 2, 3, 5 and 6 are address, user, time, method and page."""
    parts = F.split(F.col(value), " ")
    time = F.to_timestamp_ntz(parts[3], F.lit(ACCESS_TIME))
    return lines.select(parts[0].alias("ip"), parts[2].alias("user_id"), time.alias("event_time"),
                        parts[5].alias("method"), parts[6].alias("url"))


def with_event_time(df: DataFrame, seconds: str = "ts", name="event_time") -> DataFrame:
    """Event time from epoch seconds."""
    return df.withColumn(name, F.timestamp_seconds(seconds))
