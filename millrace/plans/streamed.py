"""The same analyses as replayed streams."""

from datetime import timedelta

from pyspark.sql import functions as F

from millrace.checkpoints import remove_folder, run_folder
from millrace.functions.spans import epoch_micros
from millrace.operators.windows import tumbling
from millrace.plans.registry import query, table
from millrace.plans.timed import ARRIVALS
from millrace.streaming import control, late

MINUTE, HOUR = timedelta(minutes=1), timedelta(hours=1)


@query("""select time_bucket(interval '1 hour', ts) as window_start, time_bucket(interval '1 hour', ts) + interval '1 hour' as window_end,
  count(*) as pv from events where event_type = 'view' and ts is not null group by window_start, window_end""")
def stream_pv_hourly(spark, folder):
    """Page views per hour from a replayed stream: each batch leaves its counts per window, and the windows are their sums.

    However the table is cut into files and batches, no row is late. Writing a batch again replaces what it left.
    """
    run = run_folder(spark, "pv")
    path = f"{folder}/[e]vents.parquet"  # a pattern, so that a file and a folder of files are both read
    events = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)

    def counted(batch, batch_id):
        views = batch.where("event_type = 'view'")
        counts = tumbling(views, "ts", HOUR, [], F.count(F.lit(1)).alias("pv"))
        counts.write.mode("overwrite").parquet(f"{run}/out/batch={batch_id}")

    counted(spark.read.parquet(path).limit(0), -1)  # a table without rows gives an empty result
    (events.writeStream.foreachBatch(counted).option("checkpointLocation", f"{run}/state")
     .trigger(availableNow=True).start().awaitTermination())
    parts = spark.read.parquet(f"{run}/out").groupBy("window_start", "window_end").agg(F.sum("pv").alias("pv"))
    return parts.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "pv")


def _delivered(spark, rows, place, run, pieces=4):
    """``rows`` as a stream in several deliveries, stretches of ``place``; each is a run of its own that goes on from the checkpoint.

    ``run`` gives the writer for the stream and the folder of its outputs, which is returned.
    """
    cuts = rows.select(place.alias("at")).approxQuantile("at", [k / pieces for k in range(1, pieces)], 0.01)
    home = run_folder(spark, "deliveries")
    stretch = sum((F.coalesce(place > cut, F.lit(False)).cast("int") for cut in cuts), F.lit(0))
    for k in range(len(cuts) + 1):
        rows.where(stretch == k).write.parquet(f"{home}/in/piece{k}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{home}/in/*")
        writer = run(stream, home).option("checkpointLocation", f"{home}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    remove_folder(spark, f"{home}/in")
    return home


def _arrivals(spark, folder, run):
    """Events in the order of arrival."""
    late_by = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("event_id") * 7919 % 600)
    events = table(spark, folder, "events").select("event_id", "ts", "user_id").withColumn("arrived", F.col("ts") + late_by)
    return _delivered(spark, events, epoch_micros(F.col("arrived")), run)


@query(f"with {ARRIVALS} select event_id, user_id, window_end from c where status = 'late'")
def stream_late_rows(spark, folder):
    """The side output of five-minute windows with two minutes of grace, from a stream in four deliveries."""
    def run(stream, home):
        return late.judged(stream, f"{home}/latest", ["arrived", "event_id"], "ts", 5 * MINUTE, late.late_only(f"{home}/late"), allowed=2 * MINUTE)

    home = _arrivals(spark, folder, run)
    return spark.read.parquet(f"{home}/late").select("event_id", "user_id", "window_end")


@query(f"""with {ARRIVALS} select window_start, window_end, count(case when status = 'on_time' then 1 end) as on_time,
  count(case when status = 'refire' then 1 end) as refired, count(case when status = 'late' then 1 end) as late,
  count(*) as merged from c group by window_start, window_end""")
def stream_late_merge(spark, folder):
    """Window counts of the same stream, with the rows that came late merged into them."""
    keys = ["window_start", "window_end"]

    def run(stream, home):
        totals = late.Totals(spark, f"{home}/totals", [*keys, "status"], {"rows": ("count", None)}, fold=3)
        return late.judged(stream, f"{home}/latest", ["arrived", "event_id"], "ts", 5 * MINUTE, late.merging(totals), allowed=2 * MINUTE)

    home = _arrivals(spark, folder, run)
    totals = late.Totals(spark, f"{home}/totals", [*keys, "status"], {"rows": ("count", None)})
    return late.by_status(totals.table(), keys, "rows")


@query("""with c as (select event_id, event_type, last_value(case when event_type = 'signup' then user_id % 2 end ignore nulls)
    over (order by event_id rows unbounded preceding) as s_now from events)
select event_id as seq, case when s_now = 1 then 'on' else 'off' end as switch from c where event_type <> 'signup'""")
def stream_switch_state(spark, folder):
    """The switch over a stream in four deliveries."""
    def run(stream, home):
        is_control, setting = F.col("event_type") == "signup", (F.col("user_id") % 2).cast("string")
        save = lambda rows, batch_id: rows.select("seq", "switch").write.mode("overwrite").parquet(f"{home}/out/batch={batch_id}")
        return control.switched(stream, f"{home}/setting", "seq", is_control, setting, save)

    events = table(spark, folder, "events").select(F.col("event_id").alias("seq"), "user_id", "event_type")
    home = _delivered(spark, events, F.col("seq"), run)
    return spark.read.parquet(f"{home}/out").select("seq", "switch")
