"""Sinks fed by a stream, and the watermark of several inputs."""

from datetime import timedelta

from conftest import rows
from pyspark.sql import functions as F
from samples import sensors

from millrace.sinks import stores
from millrace.streaming import windows


def test_print_stream(spark, replay):
    stores.print_stream(replay(sensors(spark).select("id", "vc")), "readings").trigger(availableNow=True).start().awaitTermination()


def test_sinks_from_batches(spark, replay, tmp_path):
    """Keyed upserts and documents from foreachBatch; a batch that is written again changes nothing."""
    store = tmp_path / "store"
    store.mkdir()

    def put(folder, batch):
        for row in batch.itertuples():
            (folder / row.id).write_text(str(row.vc))

    def write(batch, batch_id):
        for _ in range(2):
            stores.upsert_keyed(batch, ["id"], ["seq"], lambda: store, put)
            stores.append_version(batch, ["id"], ["seq"], str(tmp_path / "log"), batch_id)
        stores.write_documents(batch.select("id", "vc"), str(tmp_path / f"docs{batch_id}"))

    data = sensors(spark).select("id", "seq", "vc")
    stream = replay(data.where("seq < 5"), data.where("seq >= 5"))
    stream.writeStream.foreachBatch(write).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    want = {"sensor_1": "7", "sensor_2": "6", "sensor_3": "9"}
    assert {p.name: p.read_text() for p in store.iterdir()} == want
    assert {r.id: str(r.vc) for r in stores.latest_version(spark, ["id"], str(tmp_path / "log")).collect()} == want
    assert spark.read.text(str(tmp_path / "docs*")).count() == 9


def test_the_slower_input_holds_the_watermark(spark, replay, drain):
    """One input is far ahead; windows of the other still count its rows, since the watermark is that of the slower one."""
    at = lambda *seconds: spark.createDataFrame([(s,) for s in seconds], "s bigint").select(F.timestamp_seconds("s").alias("ts"))
    ahead = windows.watermarked(replay(at(1), at(1000), at(2000)), "ts")
    behind = windows.watermarked(replay(at(2), at(3), at(4)), "ts")
    counts = windows.windowed(ahead.union(behind), "ts", timedelta(seconds=10), [], F.count(F.lit(1)).alias("n"))
    got = rows(drain(counts, "update"), "window_start", "n")
    assert max(n for start, n in got if start.timestamp() == 0) == 4
