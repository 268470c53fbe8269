"""Reliable cuts of the lineage, in the folder shared by all executors."""

import os

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where none is named, a folder beside the warehouse, on a local master only."""
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "checkpoints")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder path for one run's output or streaming checkpoint; whoever asks for it calls `remove_folder` after the last read."""
    return os.path.join(shared_folder(spark), f"{name}-{os.urandom(6).hex()}")


def _at(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove_folder(spark: SparkSession, folder: str) -> None:
    files, path = _at(spark, folder)
    files.delete(path, True)


def written(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the complete tables ``name=<number>`` in a folder, in ascending order."""
    files, path = _at(spark, folder)
    if not files.exists(path):
        return []
    found = [s.getPath() for s in files.listStatus(path) if s.getPath().getName().startswith(f"{name}=")]
    mark = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(p.getName().split("=")[1]) for p in found if files.exists(mark(p, "_SUCCESS")))


def reliable(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, so a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
