from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.sinks import stores
from millrace.sources import generators, lines, tables
from samples import SENSORS, sensors


def test_csv_lines(spark, tmp_path):
    path = str(tmp_path / "order.csv")
    with open(path, "w") as f:
        f.write("34729,create,,1558430842\n34729,pay,sd76f87d6,1558430844\n")
    parsed = lines.parse_csv(lines.read_lines(spark, path), lines.ORDER)
    assert rows(parsed) == [(34729, "create", "", 1558430842), (34729, "pay", "sd76f87d6", 1558430844)]
    timed = lines.with_event_time(parsed)
    assert timed.where("event_time = timestamp'2019-05-21 09:27:22'").count() == 1
    bad = lines.parse_csv(spark.createDataFrame([("x,create,,1",)], "value string"), lines.ORDER)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.collect()


def test_access_log(spark):
    line = '83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/img.png'
    got = lines.parse_access_log(spark.createDataFrame([(line,)], "value string")).first()
    assert (got.ip, got.user_id, str(got.event_time), got.method, got.url) == (
        "83.149.9.216", "-", "2015-05-17 10:05:03", "GET", "/presentations/img.png")


def test_text_stream(spark, tmp_path, drain):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.txt").write_text("sensor_1,1,2\n")
    parsed = lines.parse_csv(lines.stream_lines(spark, str(tmp_path / "w"), 1), lines.SENSOR)
    assert rows(drain(parsed)) == [("sensor_1", 1, 2)]


def test_generators(spark, drain):
    assert rows(generators.sensor_events(spark, 50, 1)) == rows(generators.sensor_events(spark, 50, 1))
    assert generators.sensor_events(spark, 200).where("vc not between 40 and 49").isEmpty()
    market = generators.marketing_events(spark, 500)
    assert {r[0] for r in market.select("behavior").distinct().collect()} == set(generators.BEHAVIORS)
    assert {r[0] for r in market.select("channel").distinct().collect()} == set(generators.CHANNELS)


def test_sensor_stream(spark, tmp_path):
    df = generators.stream_sensors(spark, seed=3, rows=25, rowsPerSecond=10, start=0)
    query = (df.writeStream.format("memory").queryName("made").option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(processingTime="0 seconds").start())
    try:
        for _ in range(100):
            if spark.table("made").count() >= 25:
                break
            query.awaitTermination(0.3)
    finally:
        query.stop()
    assert spark.table("made").count() == 25
    assert {r[0] for r in spark.table("made").select("id").distinct().collect()} <= {"sensor_0", "sensor_1", "sensor_2"}


def test_file_table_round_trip(spark, tmp_path):
    """The filter on sensor_1, written as delimited files and read back through SQL."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    stores.write_csv(spark.createDataFrame(SENSORS, "id string, ts bigint, vc int").coalesce(1), source, "|")
    tables.file_table(spark, "fs_in", source, lines.SENSOR, "|")
    tables.file_table(spark, "fs_out", target, lines.SENSOR)
    spark.sql("insert into fs_out select * from fs_in where id = 'sensor_1'")
    text = [r[0] for r in rows(lines.read_lines(spark, target))]
    assert text == ["sensor_1,1549044122,11", "sensor_1,1549044124,23", "sensor_1,1549044128,7"]
    stores.insert_into(spark.table("fs_in").where("id = 'sensor_3'"), "fs_out")
    assert spark.table("fs_out").count() == 5


def test_hive_table(spark):
    tables.use_catalog(spark, "spark_catalog", "default")
    spark.sql("create table if not exists people (id string, name string, age int) using hive")
    people = spark.createDataFrame([("1", "ergou", 18), ("2", "gousheng", 19), ("3", "goudan", 20)], "id string, name string, age int")
    people.createOrReplaceTempView("arrivals")
    spark.sql("insert into people select * from arrivals")
    assert rows(spark.sql("select * from people")) == [("1", "ergou", 18), ("2", "gousheng", 19), ("3", "goudan", 20)]


def test_jdbc_append(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    rows_in = spark.createDataFrame(SENSORS, "id string, ts bigint, vc int")
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "createTableColumnTypes": "id VARCHAR(32)"}
    stores.append_jdbc(rows_in, url, "sensor", **options)
    stores.append_jdbc(rows_in.limit(1), url, "sensor", **options)
    assert spark.read.jdbc(url, "sensor", properties={"driver": options["driver"]}).count() == 10


def test_keyed_upsert(spark, tmp_path):
    store = tmp_path / "store"
    store.mkdir()

    def put(folder, batch):
        for row in batch.itertuples():
            (folder / str(row.ts)).write_text(str(row.vc))

    df = sensors(spark).select("seq", (F.col("ts") % 2).alias("ts"), "vc")
    stores.upsert_keyed(df, ["ts"], ["seq"], lambda: store, put)
    assert {p.name: p.read_text() for p in store.iterdir()} == {"0": "9", "1": "8"}


def test_versioned_upsert(spark, tmp_path):
    path = str(tmp_path / "uv")
    batch = lambda *data: spark.createDataFrame(data, "window_end bigint, uv bigint, seq bigint")
    for _ in range(2):  # a repeated batch changes nothing
        stores.append_version(batch((1, 5, 1), (1, 6, 2), (2, 1, 3)), ["window_end"], ["seq"], path, 0)
    stores.append_version(batch((2, 4, 4),), ["window_end"], ["seq"], path, 1)
    assert rows(stores.latest_version(spark, ["window_end"], path), "window_end", "uv") == [(1, 6), (2, 4)]


def test_documents(spark, tmp_path):
    stores.write_documents(sensors(spark).select("id", "ts", "vc"), str(tmp_path / "docs"))
    docs = spark.read.schema("data string").json(str(tmp_path / "docs"))
    assert "sensor_1,1549044122,11" in {r[0] for r in docs.collect()}
    sent = tmp_path / "sent"
    sent.mkdir()

    def post(group):
        from uuid import uuid4

        (sent / uuid4().hex).write_text(str(len(group)))

    stores.index_documents(sensors(spark).repartition(1), post, bulk=4)
    assert Counter(p.read_text() for p in sent.iterdir()) == Counter({"4": 2, "1": 1})


def test_kafka_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        tables.stream_kafka(spark, "localhost:9092", "sensor").schema  # noqa: B018


def test_console_label(spark, replay):
    labelled = stores.labelled(sensors(spark), "main")
    assert labelled.columns[0] == "label" and labelled.first()[0] == "main"
