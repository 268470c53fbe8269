"""Updating aggregates as a log of added and withdrawn rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import count, ordered


def count_changes(df: DataFrame, keys: Sequence[str], order: str, name="cnt", max_rows: int | None = None) -> DataFrame:
    """For each input row, withdraw the key's old count (if any) and add the new one."""
    counted = ordered(df, keys, [order], max_rows).running({"__n": count()}).to_df()
    n = F.col("__n")
    add = F.struct(F.lit(True).alias("is_add"), n.alias(name))
    withdraw = F.struct(F.lit(False).alias("is_add"), (n - 1).alias(name))
    changes = F.explode(F.when(n > 1, F.array(withdraw, add)).otherwise(F.array(add)))
    return counted.select(order, *keys, changes.alias("__c")).select(order, *keys, "__c.is_add", f"__c.{name}")
