"""First n rows per group."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, name="rn") -> DataFrame:
    """Rows ranked 1..n in each group.

    The rank filter lets Spark keep only n rows per group and task before the shuffle, so the
    size of a group does not matter. ``order`` must end in a unique key.
    """
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col(name) <= n).withColumn(name, F.col(name).cast("bigint"))
