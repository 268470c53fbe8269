"""Tables written between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import gc
import os

from pyspark.sql import DataFrame, SparkSession

from millrace.checkpoints import remove_folder, run_folder


class Workspace:
    """Cuts the lineage with written tables, so a lost executor costs one step and not the whole chain.

    ``cut`` also lets Spark drop the shuffle files of the steps before, and ``drop`` deletes tables that no later step reads.
    The tables behind a returned result stay until the checkpoint folder is cleared, since the caller reads them later.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.tables = spark, run_folder(spark, name), 0

    def path(self, name: str) -> str:
        self.tables += 1
        return os.path.join(self.folder, f"{self.tables:03d}-{name}")

    def cut(self, df: DataFrame, name: str, *, free: bool = True) -> DataFrame:
        path, schema = self.path(name), df.schema
        df.write.parquet(path)
        if free:
            del df
            self.free()
        back = self.spark.read.schema(schema).parquet(path)
        back._workspace_path = path
        return back

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            remove_folder(self.spark, table._workspace_path)

    def free(self) -> None:
        """Shuffle files go when the JVM collects the plans that made them; Python must let go of them first."""
        gc.collect()
        self.spark._jvm.System.gc()
