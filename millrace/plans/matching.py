"""Event patterns and joins."""

from datetime import timedelta

from pyspark.sql import functions as F

from millrace.operators import joins, patterns
from millrace.operators.alerts import payment_status
from millrace.plans.registry import all_events, of_type, query, table

DAY = timedelta(days=1)
KEY, ORDER = ["user_id"], ["ts", "seq"]


def is_(kind):
    return F.col("event_type") == kind

# Later rows of the same user, in event-time order.
E = "e as (select event_id as seq, user_id, event_type, ts from events)"
AHEAD = """n as (select *, lead(seq) over w as n_seq, lead(event_type) over w as n_type, lead(ts) over w as n_ts
  from e window w as (partition by user_id order by ts nulls first, seq))"""




def _later(kind, name):
    return (f"first_value(case when event_type = '{kind}' then {{}} end ignore nulls) over "
            f"(partition by user_id order by ts nulls first, seq rows between 1 following and unbounded following) as {name}")


def _sequence(spark, folder, first, steps, within=None, named=()):
    """Over all events; over those of the types in ``named`` where no step asks for the very next row."""
    events = of_type(spark, folder, *named) if named else all_events(spark, folder)
    return patterns.match_sequence(events, KEY, ORDER, is_(first), steps, "ts", within)


@query("select event_id as seq, user_id from events where user_id = 7 or value > 100")
def cep_single_or(spark, folder):
    events = table(spark, folder, "events").where((F.col("user_id") == 7) | (F.col("value") > 100))
    return events.select(F.col("event_id").alias("seq"), "user_id")


@query(f"with {E}, {AHEAD} select seq as start_seq, n_seq as next_seq from n where event_type = 'view' and n_type = 'click'")
def cep_next(spark, folder):
    found = _sequence(spark, folder, "view", [patterns.next_("next", is_("click"))]).where("matched")
    return found.select(F.col("start.seq").alias("start_seq"), F.col("next.seq").alias("next_seq"))


@query(f"with {E}, {AHEAD} select seq as start_seq from n where event_type = 'view' and n_seq is not null and n_type is distinct from 'click'")
def cep_not_next(spark, folder):
    found = _sequence(spark, folder, "view", [patterns.not_next("no", is_("click"))]).where("matched")
    return found.select(F.col("start.seq").alias("start_seq"))


@query(f"""with {E}, f as (select *, {_later('purchase', 'end_seq').format('seq')} from e)
select seq as start_seq, end_seq from f where event_type = 'view' and end_seq is not null""")
def cep_followed_by(spark, folder):
    found = _sequence(spark, folder, "view", [patterns.followed_by("buy", is_("purchase"))], named=("view", "purchase")).where("matched")
    return found.select(F.col("start.seq").alias("start_seq"), F.col("buy.seq").alias("end_seq"))


@query(f"""with {E}, o as (select *, row_number() over (partition by user_id order by ts nulls first, seq) as n from e),
f as (select *, {_later('purchase', 'end_seq').format('seq')}, {_later('purchase', 'end_n').format('n')},
  {_later('error', 'bad_n').format('n')} from o)
select seq as start_seq, end_seq from f where event_type = 'view' and end_seq is not null and (bad_n is null or end_n < bad_n)""")
def cep_not_followed_by(spark, folder):
    steps = [patterns.not_followed_by("no", is_("error")), patterns.followed_by("buy", is_("purchase"))]
    found = _sequence(spark, folder, "view", steps, named=("view", "error", "purchase")).where("matched")
    return found.select(F.col("start.seq").alias("start_seq"), F.col("buy.seq").alias("end_seq"))


@query(f"""with {E}, f as (select *, {_later('click', 'c_seq').format('seq')}, {_later('purchase', 'p_seq').format('seq')} from e)
select a.seq as start_seq, b.seq as middle_seq, b.p_seq as end_seq from f a join f b on a.c_seq = b.seq
where a.event_type = 'view' and b.p_seq is not null""")
def cep_three_steps(spark, folder):
    steps = [patterns.followed_by("click", is_("click")), patterns.followed_by("buy", is_("purchase"))]
    found = _sequence(spark, folder, "view", steps, named=("view", "click", "purchase")).where("matched")
    return found.select(F.col("start.seq").alias("start_seq"), F.col("click.seq").alias("middle_seq"),
                        F.col("buy.seq").alias("end_seq"))


@query(f"""with {E} select a.seq as start_seq, b.seq as later_seq from e a join e b on a.user_id = b.user_id
  and a.event_type = 'signup' and b.event_type = 'purchase' and (b.ts, b.seq) > (a.ts, a.seq)
  and b.ts < a.ts + interval '1 day'""")
def cep_followed_by_any(spark, folder):
    pairs = patterns.match_any_later(of_type(spark, folder, "signup", "purchase"), KEY, ORDER,
                                     is_("signup"), is_("purchase"), "ts", DAY)
    return pairs.select(F.col("start.seq").alias("start_seq"), F.col("later.seq").alias("later_seq"))


TIMES = f"""with {E}, m as (select *, row_number() over (partition by user_id order by ts nulls first, seq) as n from e
  where event_type = 'error')
select a.user_id, a.seq as start_seq, b.seq as last_seq, b.n - a.n + 1 as times from m a join m b
  on a.user_id = b.user_id and b.n - a.n"""


@query(f"{TIMES} = 2")
def cep_times(spark, folder):
    return _times(spark, folder, 3, 3)


@query(f"{TIMES} between 0 and 2")
def cep_times_range(spark, folder):
    return _times(spark, folder, 1, 3)


def _times(spark, folder, least, most):
    found = patterns.match_times(of_type(spark, folder, "error"), KEY, ORDER, is_("error"), least, most)
    return found.select("user_id", F.element_at("events", 1)["seq"].alias("start_seq"),
                        F.element_at("events", -1)["seq"].alias("last_seq"), "times")


PAID = f"""with {E}, f as (select *, {_later('purchase', 'end_seq').format('seq')}, {_later('purchase', 'end_ts').format('ts')} from e)
select {{}} from f where event_type = 'signup' and"""


def _paid(spark, folder):
    return patterns.match_sequence(of_type(spark, folder, "signup", "purchase"), KEY, ORDER, is_("signup"),
                                   [patterns.followed_by("pay", is_("purchase"))], "ts", DAY)


@query(PAID.format("seq as start_seq, end_seq") + " end_ts < ts + interval '1 day'")
def cep_within(spark, folder):
    return _paid(spark, folder).where("matched").select(
        F.col("start.seq").alias("start_seq"), F.col("pay.seq").alias("end_seq"))


@query(PAID.format("seq as start_seq, ts + interval '1 day' as timeout_at")
       + " (end_ts is null or end_ts >= ts + interval '1 day')")
def cep_timeout(spark, folder):
    return _paid(spark, folder).where("timed_out").select(F.col("start.seq").alias("start_seq"), "timeout_at")


@query(PAID.format("user_id, seq, case when end_ts < ts + interval '1 day' then 'normal' else 'timeout' end as status")
       + " true")
def order_timeout(spark, folder):
    status = F.when(F.col("matched"), "normal").otherwise("timeout")
    return _paid(spark, folder).select("start.user_id", "start.seq", status.alias("status"))


@query("""with s as (select user_id, min(case when event_type = 'signup' then ts end) as created_at,
  min(case when event_type = 'purchase' then ts end) as paid_at from events
  where event_type in ('signup', 'purchase') group by user_id)
select *, case when created_at is null then 'missing_create' when paid_at is null then 'timeout'
  when paid_at >= created_at + interval '1 day' then 'late_paid' else 'normal' end as status from s""")
def order_status(spark, folder):
    return payment_status(of_type(spark, folder, "signup", "purchase"), KEY, "ts",
                          is_("signup"), is_("purchase"), DAY)


@query(f"""with {E}, {AHEAD} select 'start=' || seq || ',next=' || n_seq as match from n
where event_type = 'view' and n_type = 'click'""")
def cep_match_map(spark, folder):
    found = _sequence(spark, folder, "view", [patterns.next_("next", is_("click"))])
    match = patterns.as_match_map(found, ["start", "next"])
    parts = [F.concat(F.lit(f"{name}="), F.col("match")[name][0]["seq"].cast("string")) for name in ("start", "next")]
    return match.select(F.concat_ws(",", *parts).alias("match"))


@query(f"""with {E}, n as (select *, lead(seq) over w as n_seq, lead(event_type) over w as n_type
  from e window w as (order by ts nulls first, seq))
select seq as start_seq, n_seq as next_seq from n where event_type = 'view' and n_type = 'click'""")
def cep_global(spark, folder):
    events = all_events(spark, folder)
    found = patterns.match_sequence(events, [], ORDER, is_("view"), [patterns.next_("next", is_("click"))])
    return found.where("matched").select(F.col("start.seq").alias("start_seq"), F.col("next.seq").alias("next_seq"))


@query("""with e as (select event_id as seq, user_id, event_type, ts from events where event_type in ('error', 'signup')),
n as (select *, lead(event_type) over w as n_type, lead(ts) over w as n_ts from e window w as (partition by user_id order by ts nulls first, seq))
select user_id, ts as first_fail, n_ts as second_fail from n
where event_type = 'error' and n_type = 'error' and n_ts < ts + interval '1 day'""")
def login_abuse(spark, folder):
    found = patterns.match_sequence(of_type(spark, folder, "error", "signup"), KEY, ORDER, is_("error"),
                                    [patterns.next_("again", is_("error"))], "ts", DAY).where("matched")
    return found.select("start.user_id", F.col("start.ts").alias("first_fail"), F.col("again.ts").alias("second_fail"))


@query("""select v.event_id as view_id, c.event_id as click_id, v.user_id, time_bucket(interval '1 hour', v.ts) as window_start
from events v join events c on v.user_id = c.user_id and time_bucket(interval '1 hour', v.ts) = time_bucket(interval '1 hour', c.ts)
where v.event_type = 'view' and c.event_type = 'click'""")
def window_join(spark, folder):
    views = of_type(spark, folder, "view").select(F.col("seq").alias("view_id"), "user_id", "ts")
    clicks = of_type(spark, folder, "click").select(F.col("seq").alias("click_id"), "user_id", "ts")
    pairs = joins.window_join(views, clicks, ["user_id"], "ts", timedelta(hours=1))
    return pairs.select("view_id", "click_id", "user_id", "window_start")


@query("""select o_orderkey, l_linenumber, l_partkey, o_orderdate, l_shipdate from orders join lineitem on o_orderkey = l_orderkey
  and l_shipdate between o_orderdate - interval '30 days' and o_orderdate + interval '30 days'""")
def interval_join(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_shipdate")
    month = timedelta(days=30)
    pairs = joins.interval_join(orders, lines, ["o_orderkey"], "o_orderdate", "l_shipdate", -month, month)
    return pairs.select("o_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "l_shipdate")




def _reconciled(spark, folder):
    """Orders of a customer against lines of the part with the same number: many of each for one key."""
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("id"),
                                                   *[F.lit(0).cast("bigint").alias(c) for c in ("line", "tie")])
    lines = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_shipdate").alias("at"), F.col("l_orderkey").alias("id"),
                                                    F.col("l_linenumber").cast("bigint").alias("line"), F.col("l_suppkey").cast("bigint").alias("tie"))
    return joins.reconcile(orders, lines, "k", ["at", "id", "line", "tie"], ["at", "id", "line", "tie"])


ARRIVED = """a as (select o_custkey as k, o_orderdate as at_, 0 as side, o_orderkey as id, 0 as line, 0 as tie from orders
  union all select l_partkey, l_shipdate, 1, l_orderkey, l_linenumber, l_suppkey from lineitem),
b as (select *, row_number() over w as n, lag(side) over w as before from a window w as (partition by k order by at_, id, line, tie, side)),
r as (select *, sum(case when before is null or before <> side then 1 else 0 end) over (partition by k order by n) as run from b),
g as (select k, run, min(side) as side, count(*) as cnt, arg_min(id, n) as first_id, arg_min(line, n) as first_line,
  arg_max(id, n) as last_id, arg_max(line, n) as last_line from r group by k, run),
h as (select *, max(case when cnt > 1 then run end) over (partition by k order by run rows between unbounded preceding and 1 preceding) as reset,
  lag(last_id) over (partition by k order by run) as id_before, lag(last_line) over (partition by k order by run) as line_before,
  lead(run) over (partition by k order by run) as run_after from g),
m as (select *, case when reset is null then run % 2 = 0 else (run - reset) % 2 = 1 end as matched from h)"""


@query(f"""with {ARRIVED} select k, case when side = 0 then first_id else id_before end as o_orderkey,
  case when side = 1 then first_id else id_before end as l_orderkey, case when side = 1 then first_line else line_before end as l_linenumber
from m where matched""")
def reconcile_match(spark, folder):
    pairs = joins.matches(_reconciled(spark, folder))
    return pairs.select("k", F.col("left.id").alias("o_orderkey"), F.col("right.id").alias("l_orderkey"), F.col("right.line").alias("l_linenumber"))


@query(f"""with {ARRIVED} select k, case when side = 0 then 'left' else 'right' end as side from m where run_after is null and (cnt > 1 or not matched)""")
def reconcile_gaps(spark, folder):
    return joins.gaps(_reconciled(spark, folder))


@query("select l_orderkey, l_linenumber, l_partkey, o_orderkey, o_orderdate from lineitem right join orders on l_orderkey = o_orderkey")
def right_join(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "right")


@query("""select o_orderkey, o_custkey from orders
where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')""")
def not_in(spark, folder):
    returned = table(spark, folder, "lineitem").where("l_returnflag = 'R'").select("l_orderkey")
    return joins.not_in(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", returned)
