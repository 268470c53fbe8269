"""Ready-made analyses."""

from datetime import timedelta

from pyspark.sql import functions as F

from millrace.operators import alerts, windows
from millrace.operators.ordered import count, ordered
from millrace.operators.topn import top_n
from millrace.plans.registry import of_type, query, table

MINUTE, HOUR, DAY = timedelta(minutes=1), timedelta(hours=1), timedelta(days=1)
ONE = {"cnt": ("count", None)}


def top_counts(counts, item, n=3):
    """The ``n`` most frequent items of each window; equal counts rank by item."""
    return top_n(counts, ["window_end"], [F.desc("cnt"), *[F.asc(c) for c in item]], n)


def _top_sql(source, item, size, slide, copies):
    return f"""w as (select {item}, time_bucket(interval '{slide}', ts) - g * interval '{slide}' + interval '{size}' as window_end
  from {source}, range({copies}) t(g)),
counts as (select {item}, window_end, count(*) as cnt from w group by {item}, window_end)
select {item}, cnt, window_end, rn from (select *, row_number() over (partition by window_end order by cnt desc, {item}) as rn
  from counts) where rn <= 3"""


@query("with v as (select user_id, ts from events where event_type = 'view'), "
       + _top_sql("v", "user_id", "1 hour", "5 minutes", 12))
def hot_items_topn_sql(spark, folder):
    """Hot items as SQL text over a windowed table."""
    counts = windows.sliding(of_type(spark, folder, "view"), "ts", HOUR, 5 * MINUTE, ["user_id"], ONE)
    counts.createOrReplaceTempView("item_counts")
    return spark.sql("""
        select user_id, cnt, window_end, cast(rn as bigint) as rn
        from (select *, row_number() over (partition by window_end order by cnt desc, user_id) as rn from item_counts)
        where rn <= 3""")


@query("with v as (select user_id % 50 as item_id, ts from events where event_type = 'view'), "
       + _top_sql("v", "item_id", "1 hour", "5 minutes", 12))
def hot_items(spark, folder):
    views = of_type(spark, folder, "view").withColumn("item_id", F.col("user_id") % 50)
    counts = windows.sliding(views, "ts", HOUR, 5 * MINUTE, ["item_id"], ONE)
    return top_counts(counts, ["item_id"]).select("item_id", "cnt", "window_end", "rn")


@query("with v as (select url, ts from events join pages on page_id = user_id where event_type = 'view'), "
       + _top_sql("v", "url", "10 minutes", "5 seconds", 120))
def hot_pages(spark, folder):
    """Counts per page and pane come first; the address is looked up for the counts, not for the rows."""
    views = of_type(spark, folder, "view")
    panes = views.groupBy(F.window("ts", "5 seconds")["start"].alias("ts"), F.col("user_id").alias("page_id")).agg(
        F.count(F.lit(1)).alias("n"))
    named = panes.join(table(spark, folder, "pages").select("page_id", "url"), "page_id")
    counts = windows.sliding(named, "ts", 10 * MINUTE, timedelta(seconds=5), ["url"], {"cnt": ("sum", "n")})
    return top_counts(counts, ["url"]).select("url", "cnt", "window_end", "rn")


PROVINCES = """v as (select n_name as province, user_id % 10 as ad_id, ts from events join customer on c_custkey = user_id
  join nation on n_nationkey = c_nationkey where event_type = 'click')"""


@query(f"with {PROVINCES}, " + _top_sql("v", "province, ad_id", "1 hour", "5 minutes", 12))
def hot_ads_region(spark, folder):
    panes = of_type(spark, folder, "click").groupBy(
        F.window("ts", "5 minutes")["start"].alias("ts"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("province"))
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    clicks = panes.join(customers, "user_id").join(nations, F.col("n_nationkey") == F.col("c_nationkey"))
    clicks = clicks.withColumn("ad_id", F.col("user_id") % 10)
    counts = windows.sliding(clicks, "ts", HOUR, 5 * MINUTE, ["province", "ad_id"], {"cnt": ("sum", "n")})
    return top_counts(counts, ["province", "ad_id"]).select("province", "ad_id", "cnt", "window_end", "rn")


@query("with v as (select user_id, user_id % 10 as ad_id, ts from events where event_type = 'click'), "
       + _top_sql("v", "user_id, ad_id", "1 hour", "5 minutes", 12))
def hot_ads_user(spark, folder):
    clicks = of_type(spark, folder, "click").withColumn("ad_id", F.col("user_id") % 10)
    counts = windows.sliding(clicks, "ts", HOUR, 5 * MINUTE, ["user_id", "ad_id"], ONE)
    return top_counts(counts, ["user_id", "ad_id"]).select("user_id", "ad_id", "cnt", "window_end", "rn")


LIMIT = 2
LIMITED = """n as (select event_id as seq, user_id, event_type, ts, row_number() over (
  partition by user_id, event_type, time_bucket(interval '1 day', ts) order by event_id) as click_no from events)"""


def _limited(spark, folder):
    events = table(spark, folder, "events").select(F.col("event_id").alias("seq"), "user_id", "event_type", "ts")
    return alerts.click_limit(events, ["user_id", "event_type"], "ts", [F.asc("seq")], LIMIT)


@query(f"with {LIMITED} select seq, user_id, event_type from n where click_no <= {LIMIT}")
def blacklist_pass(spark, folder):
    return alerts.clicks_passed(_limited(spark, folder), LIMIT).select("seq", "user_id", "event_type")


@query(f"""with {LIMITED} select seq, user_id, event_type, time_bucket(interval '1 day', ts) as day_start
from n where click_no = {LIMIT + 1}""")
def blacklist_alarm(spark, folder):
    return alerts.click_alarms(_limited(spark, folder), LIMIT).select("seq", "user_id", "event_type", "day_start")


@query(f"with {LIMITED}, v as (select user_id, ts from n where click_no <= {LIMIT} and event_type = 'click'), "
       + _top_sql("v", "user_id", "1 hour", "5 minutes", 12))
def blacklist_top(spark, folder):
    passed = alerts.clicks_passed(_limited(spark, folder), LIMIT).where("event_type = 'click'")
    counts = windows.sliding(passed, "ts", HOUR, 5 * MINUTE, ["user_id"], ONE)
    return top_counts(counts, ["user_id"]).select("user_id", "cnt", "window_end", "rn")


@query("select count(*) as pv from events where event_type = 'view'")
def pv_total(spark, folder):
    return of_type(spark, folder, "view").agg(F.count(F.lit(1)).alias("pv"))


@query("select event_id as seq, row_number() over (order by event_id) as pv from events where event_type = 'view'")
def pv_running(spark, folder):
    views = of_type(spark, folder, "view").select("seq")
    return ordered(views, [], ["seq"]).running({"pv": count()}).to_df()


@query("select count(distinct user_id) as uv from events where event_type = 'view'")
def uv_total(spark, folder):
    return of_type(spark, folder, "view").groupBy("user_id").agg(F.lit(1)).agg(F.count(F.lit(1)).alias("uv"))


@query("""select event_id as seq, event_type, user_id % 5 as channel,
  row_number() over (partition by event_type, user_id % 5 order by event_id) as cnt from events""")
def marketing_by_channel(spark, folder):
    rows = table(spark, folder, "events").select(
        F.col("event_id").alias("seq"), "event_type", (F.col("user_id") % 5).alias("channel"))
    return ordered(rows, ["event_type", "channel"], ["seq"]).running({"cnt": count()}).to_df()


@query("""select event_id as seq, event_type, row_number() over (partition by event_type order by event_id) as cnt
from events""")
def marketing_by_behavior(spark, folder):
    rows = table(spark, folder, "events").select(F.col("event_id").alias("seq"), "event_type")
    return ordered(rows, ["event_type"], ["seq"]).running({"cnt": count()}).to_df()


@query(f"with {PROVINCES} select province, ad_id, count(*) as cnt from v group by province, ad_id")
def ad_clicks_by_province(spark, folder):
    clicks = of_type(spark, folder, "click").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("province"))
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    named = clicks.join(customers, "user_id").join(nations, F.col("n_nationkey") == F.col("c_nationkey"))
    return named.groupBy("province", (F.col("user_id") % 10).alias("ad_id")).agg(F.sum("n").alias("cnt"))
