"""Small inputs, as literals."""

SENSORS = [("sensor_1", 1549044122, 11), ("sensor_2", 1549044123, 32), ("sensor_1", 1549044124, 23),
           ("sensor_2", 1549044125, 4), ("sensor_2", 1549044126, 5), ("sensor_2", 1549044127, 6),
           ("sensor_1", 1549044128, 7), ("sensor_3", 1549044129, 8), ("sensor_3", 1549044130, 9)]
T0 = 1549044000


def sensors(spark):
    from pyspark.sql import functions as F

    numbered = [(i + 1, *row) for i, row in enumerate(SENSORS)]
    df = spark.createDataFrame(numbered, "seq bigint, id string, ts bigint, vc int")
    return df.withColumn("et", F.timestamp_seconds("ts"))
