"""Projection, routing, unions, rolling aggregates and the table surface."""

from datetime import timedelta

from pyspark.sql import functions as F

from millrace.operators import changelog, transforms
from millrace.operators.alerts import rising_alerts, switched
from millrace.operators.ordered import count, first, highest, lowest, ordered, previous, total
from millrace.operators.topn import top_n
from millrace.operators.udaf import aggregate_with
from millrace.plans.registry import READINGS, of_type, query, readings, table
from millrace.sources.lines import parse_access_log, parse_csv

WORDS = """words as (select doc_id, lang, unnest(string_split(rtrim(text, ' '), ' ')) as word from documents
  where rtrim(text, ' ') <> '' or text = '')"""


@query(f"with {WORDS} select word, count(*) as cnt from words group by word")
def word_count(spark, folder):
    words = transforms.split_words(table(spark, folder, "documents").select("text"), "text")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


@query(f"""with {WORDS}, c as (select lang, word, count(*) as cnt from words group by lang, word)
select lang, word, cnt, rn from (select *, row_number() over (partition by lang order by cnt desc, word) as rn from c)
where rn <= 3""")
def top_words(spark, folder):
    words = transforms.split_words(table(spark, folder, "documents").select("lang", "text"), "text")
    counts = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("cnt"))
    return top_n(counts, ["lang"], [F.desc("cnt"), F.asc("word")], 3)


@query(f"with {READINGS} select seq, cast(vc * 2 as varchar) || '_level' as level, ts as event_time from r")
def project_rename(spark, folder):
    return readings(spark, folder).select(
        "seq", F.concat((F.col("vc") * 2).cast("string"), F.lit("_level")).alias("level"),
        F.col("ts").alias("event_time"))


@query(f"with {READINGS} select seq, id, ts, vc from r where id = 7")
def filter_eq(spark, folder):
    return readings(spark, folder).where(F.col("id") == 7)


@query("""select event_id as seq, case event_type when 'view' then 'pv' when 'click' then 'ad' else 'other' end as kind
from events""")
def case_when(spark, folder):
    kind = F.when(F.col("event_type") == "view", "pv").when(F.col("event_type") == "click", "ad").otherwise("other")
    return table(spark, folder, "events").select(F.col("event_id").alias("seq"), kind.alias("kind"))


@query(f"""with {READINGS} select seq, case when vc < 20 then 'low' when vc < 60 then 'middle' else 'high' end as tag from r
union all select seq, 'watch' as tag from r where vc < 60""")
def split_tags(spark, folder):
    vc = F.col("vc")
    tags = {"low": vc < 20, "middle": (vc >= 20) & (vc < 60), "high": vc >= 60, "watch": vc < 60}
    return transforms.with_tags(readings(spark, folder), tags).select("seq", F.explode("tags").alias("tag"))


@query(f"with {READINGS} select seq, id, 'level ' || cast(vc as varchar) as alarm from r where vc > 100")
def side_output_alarm(spark, folder):
    text = F.concat(F.lit("level "), F.col("vc").cast("string")).alias("alarm")
    _, alarms = transforms.side_output(readings(spark, folder), F.col("vc") > 100, F.col("seq"), F.col("id"), text)
    return alarms


@query("""select event_id as seq, user_id, event_type from events where event_type = 'view'
union all select event_id, user_id, event_type from events where event_type = 'click'
union all select event_id, user_id, event_type from events where event_type in ('view', 'error')""")
def union_all(spark, folder):
    return transforms.union_all(*[of_type(spark, folder, *types).drop("ts")
                                  for types in (["view"], ["click"], ["view", "error"])])


@query(f"""with {READINGS} select 'reading ' || cast(vc as varchar) as text, seq as id from r
union all select 'name ' || c_name, c_custkey from customer""")
def connect_map(spark, folder):
    return transforms.connect(
        readings(spark, folder), table(spark, folder, "customer"),
        [F.concat(F.lit("reading "), F.col("vc").cast("string")).alias("text"), F.col("seq").alias("id")],
        [F.concat(F.lit("name "), F.col("c_name")).alias("text"), F.col("c_custkey").alias("id")])


@query(f"with {READINGS} select seq, id, ts, vc from r")
def repartition_rows(spark, folder):
    return readings(spark, folder).hint("rebalance")


@query(f"with {READINGS} select seq, cast(vc as varchar) || cast(id as varchar) as keyed from r")
def process_key(spark, folder):
    return transforms.append_key(readings(spark, folder), F.col("vc"), "id").select("seq", "keyed")


@query(f"with {READINGS} select id, cast(sum(vc) as bigint) as total from r group by id")
def group_sum(spark, folder):
    return readings(spark, folder).groupBy("id").agg(F.sum("vc").alias("total"))


@query("select event_type, count(*) as cnt from events group by event_type")
def group_count(spark, folder):
    return table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))


@query(f"""with {READINGS} select seq, id,
  cast(sum(vc) over (partition by id order by seq rows unbounded preceding) as bigint) as total from r""")
def rolling_sum(spark, folder):
    rows = ordered(readings(spark, folder), ["id"], ["seq"])
    return rows.running({"total": total("vc")}).to_df().select("seq", "id", "total")


@query(f"""with {READINGS} select seq, id, max(vc) over w as vc, first_value(ts) over w as ts from r
window w as (partition by id order by seq rows unbounded preceding)""")
def rolling_max_first(spark, folder):
    rows = ordered(readings(spark, folder), ["id"], ["seq"])
    return rows.running({"vc": highest("vc"), "ts": first("ts")}).to_df().select("seq", "id", "vc", "ts")


@query(f"""with {READINGS} select seq, id, min(vc) over w as vc, first_value(ts) over w as ts from r
window w as (partition by id order by seq rows unbounded preceding)""")
def rolling_min_first(spark, folder):
    rows = ordered(readings(spark, folder), ["id"], ["seq"])
    return rows.running({"vc": lowest("vc"), "ts": first("ts")}).to_df().select("seq", "id", "vc", "ts")


@query(f"""with {READINGS} select seq, id, first_value(ts) over w as since, max(ts) over w as ts,
  cast(sum(vc) over w as bigint) as vc from r window w as (partition by id order by seq rows unbounded preceding)""")
def rolling_reduce(spark, folder):
    rows = ordered(readings(spark, folder), ["id"], ["seq"]).running(
        {"since": first("ts"), "last_ts": highest("ts"), "total": total("vc")})
    return rows.to_df().select("seq", "id", "since", F.col("last_ts").alias("ts"), F.col("total").alias("vc"))


@query(f"with {READINGS} select seq, id, row_number() over (partition by id order by seq) as cnt from r")
def running_count(spark, folder):
    rows = ordered(readings(spark, folder), ["id"], ["seq"])
    return rows.running({"cnt": count()}).to_df().select("seq", "id", "cnt")


@query("""select event_id as seq, event_type || '_' || cast(user_id % 5 as varchar) as label,
  row_number() over (partition by event_type, user_id % 5 order by event_id) as cnt from events""")
def concat_key_count(spark, folder):
    rows = table(spark, folder, "events").select(
        F.col("event_id").alias("seq"), "event_type", (F.col("user_id") % 5).alias("channel"))
    counted = ordered(rows, ["event_type", "channel"], ["seq"]).running({"cnt": count()}).to_df()
    return counted.select("seq", F.concat_ws("_", "event_type", "channel").alias("label"), "cnt")


@query(f"with {READINGS} select seq, id, vc, lag(vc) over (partition by id order by seq) as before from r")
def value_lag(spark, folder):
    rows = ordered(readings(spark, folder), ["id"], ["seq"])
    return rows.running({"before": previous("vc")}, exclusive=True).to_df().select("seq", "id", "vc", "before")


@query(f"with {READINGS} select seq, id, count(id) over (partition by id order by ts desc) as cnt from r")
def over_count_desc(spark, folder):
    """Rows with an equal or later time: count per time first, then run over the distinct times."""
    rows = readings(spark, folder).select("seq", "id", "ts")
    times = rows.groupBy("id", "ts").agg(F.count("id").alias("n"))
    later = ordered(times, ["id"], ["ts"]).running({"cnt": total("n")}, reverse=True).to_df()
    later = later.select(F.col("id").alias("later_id"), F.col("ts").alias("later_ts"), "cnt")
    same = F.col("id").eqNullSafe(F.col("later_id")) & F.col("ts").eqNullSafe(F.col("later_ts"))
    return rows.join(later, same).select("seq", "id", "cnt")


@query(f"""with {READINGS} select seq, id,
  count(id) over (partition by id order by ts desc, seq desc rows unbounded preceding) as cnt from r""")
def over_rows(spark, folder):
    rows = ordered(readings(spark, folder), ["id"], ["ts", "seq"])
    return rows.running({"cnt": count("id")}, reverse=True).to_df().select("seq", "id", "cnt")


@query(f"""with {READINGS}, c as (select seq, id, row_number() over (partition by id order by seq) as n from r)
select seq, id, true as is_add, n as cnt from c union all select seq, id, false, n - 1 from c where n > 1""")
def retract_count(spark, folder):
    return changelog.count_changes(readings(spark, folder).select("seq", "id"), ["id"], "seq")


class LevelSum:
    """Number of readings and sum of their levels."""

    accumulator_schema = "n bigint, level bigint"
    result_schema = "cnt bigint, level bigint"

    def create(self):
        return 0, 0

    def add(self, accumulator, rows):
        return accumulator[0] + len(rows), accumulator[1] + int(rows["vc"].sum())

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def result(self, accumulator):
        return accumulator


@query(f"with {READINGS} select id, count(*) as cnt, cast(sum(vc) as bigint) as level from r group by id")
def udaf_count(spark, folder):
    return aggregate_with(readings(spark, folder).select("id", "vc"), ["id"], LevelSum())


@query("""select event_id as seq, user_id, event_type, date_trunc('milliseconds', ts) as ts, cast(floor(value) as int) as vc
from events""")
def parse_csv_line(spark, folder):
    millis = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    lines = table(spark, folder, "events").select(F.concat_ws(
        ",", "event_id", "user_id", "event_type", millis, F.floor("value").cast("int")).alias("value"))
    fields = {"seq": "bigint", "user_id": "bigint", "event_type": "string", "ts": "timestamp_ntz", "vc": "int"}
    return parse_csv(lines, fields)


@query("""select 'host' || cast(user_id % 7 as varchar) as ip, cast(user_id as varchar) as user_id,
  date_trunc('second', ts) as event_time, 'GET' as method, '/' || event_type as url from events""")
def parse_log_line(spark, folder):
    lines = table(spark, folder, "events").select(F.concat_ws(
        " ", F.concat(F.lit("host"), (F.col("user_id") % 7).cast("string")), F.lit("-"), "user_id",
        F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), F.lit("GET"),
        F.concat(F.lit("/"), "event_type")).alias("value"))
    return parse_access_log(lines)


@query("select user_id, event_type, count(*) as cnt from events where event_type <> 'error' group by user_id, event_type")
def view_roundtrip(spark, folder):
    table(spark, folder, "events").select("user_id", "event_type").createOrReplaceTempView("raw_events")
    kept = spark.sql("select * from raw_events where event_type <> 'error'")
    kept.createOrReplaceTempView("kept_events")
    return spark.table("kept_events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("cnt"))


@query(f"""with {READINGS}, w as (select *, time_bucket(interval '3 seconds', ts) as window_start from r)
select id, window_start, window_start + interval '3 seconds' as window_end, count(*) as cnt
from w group by id, window_start""")
def sql_window_bounds(spark, folder):
    readings(spark, folder).createOrReplaceTempView("sensor_readings")
    return spark.sql("""
        select id, window.start as window_start, window.end as window_end, count(*) as cnt
        from (select id, window(ts, '3 seconds') as window from sensor_readings) group by id, window""")


@query("""with c as (select event_id, case when event_type = 'signup' then user_id % 2 end as s, event_type,
  last_value(case when event_type = 'signup' then user_id % 2 end ignore nulls)
    over (order by event_id rows unbounded preceding) as s_now from events)
select event_id as seq, case when s_now = 1 then 'on' else 'off' end as switch from c where event_type <> 'signup'""")
def switch_state(spark, folder):
    rows = table(spark, folder, "events").select(F.col("event_id").alias("seq"), "user_id", "event_type")
    out = switched(rows, ["seq"], F.col("event_type") == "signup", (F.col("user_id") % 2).cast("string"))
    return out.select("seq", "switch")


@query(f"""with recursive {READINGS},
a as (select *, lag(ts) over w as pt, lag(vc) over w as pv from r window w as (partition by id order by ts, seq)),
b as (select *, coalesce(vc < pv, false) as fall from a),
c as (select *, lag(fall) over (partition by id order by ts, seq) as after_fall from b),
d as (select *, sum(case when pt is null or after_fall or ts > pt + interval '6 hours' then 1 else 0 end)
  over (partition by id order by ts, seq rows unbounded preceding) as run from c),
live as (select id, run, ts from d where not fall),
ends as (select id, run, min(ts) as fall_ts from d where fall group by id, run),
jump as (select id, run, ts, (select min(n.ts) from live n where n.id = l.id and n.run = l.run
  and n.ts > l.ts + interval '6 hours') as nxt from live l),
chain(id, run, ts, nxt) as (
  select j.id, j.run, j.ts, j.nxt from jump j join (select id, run, min(ts) as ts from live group by id, run) s
    on j.id = s.id and j.run = s.run and j.ts = s.ts
  union all
  select j.id, j.run, j.ts, j.nxt from chain c join jump j on j.id = c.id and j.run = c.run and j.ts = c.nxt)
select distinct c.id, c.ts as start_ts, c.ts + interval '6 hours' as fire_ts from chain c
left join ends e on e.id = c.id and e.run = c.run
where e.fall_ts is null or e.fall_ts > c.ts + interval '6 hours'""")
def rising_alert(spark, folder):
    return rising_alerts(readings(spark, folder), ["id"], ["ts", "seq"], "ts", "vc", timedelta(hours=6))
