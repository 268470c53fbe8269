"""A control stream beside a large one: each row meets the setting in force when it arrived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators import alerts
from millrace.streaming.late import Carried, Write


def switched(df: DataFrame, folder: str, order: str, is_control: Column, setting: Column, *writes: Write) -> DataStreamWriter:
    """Hands the main rows of each batch to ``writes`` with ``switch``, as the batch operator of that name gives it.

    Main and control rows come in one stream (a union, where they have two sources), in batches by ``order``. Within a batch the settings
    are looked up as of each row; what is in force at its end is kept in ``folder`` by batch. Main rows are neither copied nor keyed, so
    the large stream is not bound to a number of tasks, and a batch that runs again sees the same setting.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        carried = Carried(batch.sparkSession, folder)
        before = carried.before(batch_id, "string")
        batch = batch.persist()
        rows = alerts.switched(batch, [order], is_control, setting, before=before).persist()
        try:
            for write in writes:
                write(rows, batch_id)
            newest = batch.where(is_control).agg(F.max_by(setting, order))
            carried.put(newest if before is None else newest.toDF("value").select(F.coalesce("value", before)), batch_id)
        finally:
            rows.unpersist()
            batch.unpersist()

    return df.writeStream.foreachBatch(run)
