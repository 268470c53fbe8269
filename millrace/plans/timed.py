"""Windows, distinct counts and late rows."""

from collections import Counter
from datetime import timedelta

from pyspark.sql import functions as F

from millrace.functions.spans import floor_time
from millrace.operators import distinct, lateness, windows
from millrace.operators.ordered import count, ordered
from millrace.plans.registry import READINGS, of_type, query, readings, table

MINUTE, HOUR = timedelta(minutes=1), timedelta(hours=1)

HOURLY = "time_bucket(interval '1 hour', ts) as window_start, time_bucket(interval '1 hour', ts) + interval '1 hour' as window_end"


@query(f"""with {READINGS} select {HOURLY}, id, cast(sum(vc) as bigint) as total from r
group by window_start, window_end, id""")
def tumble_sum(spark, folder):
    return windows.tumbling(readings(spark, folder), "ts", HOUR, ["id"], F.sum("vc").alias("total"))


SLIDES = """select id, vc, seq, time_bucket(interval '5 minutes', ts) - g * interval '5 minutes' as window_start
  from r, range(12) t(g)"""


@query(f"""with {READINGS}, w as ({SLIDES}) select window_start, window_start + interval '1 hour' as window_end, id,
  count(*) as cnt from w group by window_start, id""")
def slide_count(spark, folder):
    return windows.sliding(readings(spark, folder), "ts", HOUR, 5 * MINUTE, ["id"], {"cnt": ("count", None)})


@query(f"""with {READINGS}, a as (select *, lag(ts) over (partition by id order by ts, seq) as p from r),
b as (select *, sum(case when p is null or ts > p + interval '1 hour' then 1 else 0 end)
  over (partition by id order by ts, seq rows unbounded preceding) as s from a)
select min(ts) as window_start, max(ts) + interval '1 hour' as window_end, id, count(*) as cnt,
  cast(sum(vc) as bigint) as total from b group by id, s""")
def session_count(spark, folder):
    return windows.sessions(readings(spark, folder), "ts", HOUR, ["id"],
                            {"cnt": ("count", None), "total": ("sum", "vc")})


@query(f"""with {READINGS} select {HOURLY}, count(*) as cnt, cast(sum(vc) as bigint) as total from r
group by window_start, window_end""")
def window_all(spark, folder):
    return windows.tumbling(readings(spark, folder), "ts", HOUR, [],
                            F.count(F.lit(1)).alias("cnt"), F.sum("vc").alias("total"))


@query(f"""with {READINGS} select {HOURLY}, id, max(ts) as ts, cast(sum(vc) as bigint) as vc from r
group by window_start, window_end, id""")
def window_reduce(spark, folder):
    return windows.tumbling(readings(spark, folder), "ts", HOUR, ["id"], F.max("ts").alias("ts"), F.sum("vc").alias("vc"))


@query(f"""with {READINGS} select {HOURLY}, id, count(*) as cnt, min(vc) as low, max(vc) as high from r
group by window_start, window_end, id""")
def window_process(spark, folder):
    return windows.tumbling(readings(spark, folder), "ts", HOUR, ["id"], F.count(F.lit(1)).alias("cnt"),
                            F.min("vc").alias("low"), F.max("vc").alias("high"))


def _median(key, batches):
    """The median of ``vc``, from counts of its values."""
    counts = Counter()
    for batch in batches:
        counts.update(v for v in batch.column("vc").to_pylist() if v is not None)
    n, seen, middle = counts.total(), 0, []
    for value in sorted(counts):
        seen += counts[value]
        if 2 * seen >= n and not middle:
            middle.append(value)
        if 2 * seen > n:
            middle.append(value)
            break
    yield n, (middle[0] + middle[1]) / 2 if n else None


@query(f"""with {READINGS} select {HOURLY}, id, count(vc) as cnt, cast(median(vc) as double) as median from r where ts is not null
group by window_start, window_end, id""")
def window_median(spark, folder):
    """A function over whole windows."""
    return windows.processed(readings(spark, folder), "ts", HOUR, ["id"], _median, "cnt bigint, median double")


@query(f"""with {READINGS}, w as ({SLIDES}) select window_start + interval '1 hour' as window_end, id,
  count(*) as cnt from w group by window_start, id""")
def window_count_end(spark, folder):
    counts = windows.sliding(readings(spark, folder), "ts", HOUR, 5 * MINUTE, ["id"], {"cnt": ("count", None)})
    return counts.select("window_end", "id", "cnt")


@query(f"""with {READINGS}, n as (select *, row_number() over (partition by id order by seq) - 1 as p from r)
select id, p // 3 as window_no, cast(sum(vc) as bigint) as total from n group by id, p // 3 having count(*) = 3""")
def count_window_tumble(spark, folder):
    return windows.count_tumbling(readings(spark, folder), ["id"], ["seq"], 3, F.sum("vc").alias("total"))


@query(f"""with {READINGS}, n as (select *, row_number() over w as fired_at,
  sum(vc) over (partition by id order by seq rows between 4 preceding and current row) as s
  from r window w as (partition by id order by seq))
select id, fired_at, cast(s as bigint) as total from n where fired_at % 2 = 0""")
def count_window_slide(spark, folder):
    return windows.count_sliding(readings(spark, folder), ["id"], ["seq"], 5, 2, F.sum("vc").alias("total"))


@query(f"""with {READINGS}, n as (select *, row_number() over w as fired_at,
  sum(vc) over (partition by id order by seq rows between 11 preceding and current row) as s,
  max(vc) over (partition by id order by seq rows between 11 preceding and current row) as high,
  count(*) over (partition by id order by seq rows between 11 preceding and current row) as cnt
  from r window w as (partition by id order by seq))
select id, fired_at, cast(s as bigint) as total, high, cnt from n where fired_at % 8 = 0""")
def count_window_panes(spark, folder):
    """The last 12 rows of a key at every 8th, from panes of 4."""
    folds = {"total": ("sum", "vc"), "high": ("max", "vc"), "cnt": ("count", None)}
    return windows.count_sliding_panes(readings(spark, folder), ["id"], ["seq"], 12, 8, folds)


@query(f"""with {READINGS}, h as (select seq, id, time_bucket(interval '1 hour', ts) as window_start from r),
f as (select *, row_number() over (partition by window_start, id order by seq) = 1 as is_new from h)
select seq, window_start, count(case when is_new then 1 end)
  over (partition by window_start order by seq rows unbounded preceding) as uv from f""")
def per_row_trigger(spark, folder):
    rows = readings(spark, folder).withColumn("window_start", floor_time("ts", HOUR))
    rows = rows.select("seq", "id", "window_start")
    return distinct.running_distinct(rows, "id", "seq", ["window_start"]).select("seq", "window_start", "uv")


@query("""with v as (select event_id as seq, row_number() over (partition by user_id order by event_id) = 1 as is_new
  from events where event_type = 'view')
select seq, count(case when is_new then 1 end) over (order by seq rows unbounded preceding) as uv from v""")
def running_uv(spark, folder):
    views = of_type(spark, folder, "view").select("seq", "user_id")
    return distinct.running_distinct(views, "user_id", "seq").select("seq", "uv")


@query(f"""select {HOURLY}, count(distinct user_id) as uv from events where event_type = 'view'
group by window_start, window_end""")
def uv_hourly(spark, folder):
    return distinct.distinct_per_window(of_type(spark, folder, "view"), "ts", HOUR, "user_id")


@query(f"""select {HOURLY}, true as within from events where event_type = 'view' and ts is not null group by window_start, window_end""")
def uv_approx(spark, folder):
    """Whether each window's approximate count is within 5 % (or one visitor) of the exact one."""
    views = of_type(spark, folder, "view")
    about = distinct.approx_per_window(views, "ts", HOUR, "user_id").withColumnRenamed("uv", "about")
    exact = distinct.distinct_per_window(views, "ts", HOUR, "user_id")
    off = F.abs(F.col("about") - F.col("uv"))
    return exact.join(about, ["window_start", "window_end"]).select("window_start", "window_end", (off <= F.greatest(0.05 * F.col("uv"), F.lit(1))).alias("within"))


@query("""with v as (select user_id, time_bucket(interval '5 minutes', ts) - g * interval '5 minutes' as window_start
  from events, range(12) t(g) where event_type = 'view' and ts is not null)
select window_start, window_start + interval '1 hour' as window_end, count(distinct user_id) as uv, true as not_below, true as not_above
from v group by window_start""")
def uv_sliding_sketch(spark, folder):
    """Exact visitors of each hour at five-minute steps, and whether the union of pane sketches is within 7 % (or one visitor) on either side."""
    views = of_type(spark, folder, "view")
    about = distinct.approx_sliding(views, "ts", HOUR, 5 * MINUTE, "user_id", name="about")
    seen = views.groupBy(F.window("ts", "1 hour", "5 minutes"), "user_id").agg(F.lit(1).alias("one"))
    exact = seen.groupBy(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")).agg(F.count("user_id").alias("uv"))
    margin = F.greatest(0.07 * F.col("uv"), F.lit(1))
    return exact.join(about, ["window_start", "window_end"], "left").select(
        "window_start", "window_end", "uv", F.coalesce(F.col("about") >= F.col("uv") - margin, F.lit(False)).alias("not_below"),
        F.coalesce(F.col("about") <= F.col("uv") + margin, F.lit(False)).alias("not_above"))


BLOOM_BITS, BLOOM_HASHES = 1024, 3  # few enough for values to be taken for known ones here


@query(f"""with v as (select event_id, user_id, time_bucket(interval '1 hour', ts) as window_start, md5(cast(user_id as varchar)) as h
  from events where event_type = 'view' and ts is not null),
b as (select event_id, window_start, (('0x' || substr(h, 1, 15))::bigint % {BLOOM_BITS} + g * (('0x' || substr(h, 17, 15))::bigint % {BLOOM_BITS}))
  % {BLOOM_BITS} as bit from v, range({BLOOM_HASHES}) t(g) where user_id is not null),
f as (select window_start, min(event_id) as first from b group by window_start, bit),
c as (select window_start, count(distinct first) as uv from f group by window_start),
e as (select window_start, count(distinct user_id) as exact from v group by window_start)
select window_start, window_start + interval '1 hour' as window_end, uv, exact, true as not_above from c join e using (window_start)""")
def uv_bloom(spark, folder):
    """Visitors per hour as a Bloom filter counts them, and exactly: the former is never larger."""
    views = of_type(spark, folder, "view")
    counted = distinct.bloom_per_window(views, "ts", HOUR, "user_id", "seq", BLOOM_BITS, BLOOM_HASHES)
    exact = distinct.distinct_per_window(views, "ts", HOUR, "user_id", "exact")
    both = counted.join(exact, ["window_start", "window_end"])
    return both.select("window_start", "window_end", "uv", "exact", (F.col("uv") <= F.col("exact")).alias("not_above"))


@query("""with v as (select time_bucket(interval '1 hour', ts) as window_start,
  list_reduce(list_prepend(0::bigint, list_transform(string_split(cast(user_id as varchar), ''), lambda c: ascii(c)::bigint)),
    lambda h, c: (h * 61 + c) & 8589934591) as bit from events where event_type = 'view')
select window_start, window_start + interval '1 hour' as window_end, count(distinct bit) as uv from v group by window_start""")
def uv_bitmap(spark, folder):
    return distinct.bitmap_per_window(of_type(spark, folder, "view"), "ts", HOUR, "user_id")


@query(f"""select {HOURLY}, count(*) as pv from events where event_type = 'view' group by window_start, window_end""")
def pv_hourly(spark, folder):
    return windows.tumbling(of_type(spark, folder, "view"), "ts", HOUR, [], F.count(F.lit(1)).alias("pv"))


ARRIVALS = """a as (select event_id, ts, user_id, ts + (event_id * 7919 % 600) * interval '1 second' as arrived from events),
w as (select *, time_bucket(interval '5 minutes', ts) as window_start,
  max(ts) over (order by arrived nulls first, event_id rows between unbounded preceding and 1 preceding) - interval '1 millisecond'
    as watermark from a),
c as (select event_id, window_start, window_start + interval '5 minutes' as window_end, watermark, user_id,
  case when watermark is null or ts is null or watermark < window_start + interval '5 minutes' - interval '1 millisecond' then 'on_time'
    when watermark < window_start + interval '7 minutes' - interval '1 millisecond' then 'refire' else 'late' end as status from w)"""


def _classified(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "user_id")
    late = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("event_id") * 7919 % 600)
    return lateness.classify(events.withColumn("arrived", F.col("ts") + late), ["arrived", "event_id"], "ts",
                             5 * MINUTE, allowed=2 * MINUTE)


@query(f"with {ARRIVALS} select event_id, window_start, window_end, watermark, status from c")
def lateness_classify(spark, folder):
    return _classified(spark, folder).select("event_id", "window_start", "window_end", "watermark", "status")


@query(f"with {ARRIVALS} select event_id, user_id, window_end from c where status = 'late'")
def late_rows(spark, folder):
    return _classified(spark, folder).where("status = 'late'").select("event_id", "user_id", "window_end")


@query(f"""with {ARRIVALS} select window_start, window_end, count(case when status = 'on_time' then 1 end) as on_time,
  count(case when status = 'refire' then 1 end) as refired, count(case when status = 'late' then 1 end) as late,
  count(*) as merged from c group by window_start, window_end""")
def late_merge(spark, folder):
    return lateness.merge_late(_classified(spark, folder))


@query(f"""with {READINGS} select {HOURLY}, id, row_number() over (partition by id, time_bucket(interval '1 hour', ts)
  order by seq) as cnt, seq from r""")
def window_running_count(spark, folder):
    """A window that fires at every row: its count so far."""
    rows = readings(spark, folder).withColumn("window_start", floor_time("ts", HOUR))
    rows = ordered(rows, ["id", "window_start"], ["seq"]).running({"cnt": count()}).to_df()
    return rows.select("window_start", (F.col("window_start") + F.expr("interval 1 hour")).alias("window_end"),
                       "id", "cnt", "seq")
