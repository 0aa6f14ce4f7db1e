"""Windows, joins, pivots and ordered operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.functions import scalars as S
from wardline.operators import cohort as C
from wardline.operators import joins as J
from wardline.operators import ordered as O
from wardline.operators import pivot as P
from wardline.operators import windows as WI

from .base import Tables, check

TYPES = ["click", "error", "purchase", "signup", "view"]
HOUR, DAY = 3600, 86_400
ANCHOR = "anchor as (select user_id, min(ts) as t0 from events group by user_id)"


def anchored(t: Tables, days: int, lo_closed=True, hi_closed=True):
    """Events up to so many days after the first event of their user."""
    first = t.events.groupBy("user_id").agg(F.min("ts").alias("t0"))
    return WI.events_in_window(first, t.events, ["user_id"], "ts", F.col("t0"), S.shift("t0", days=days),
                               6 * HOUR, lo_closed, hi_closed)


def rounded(df, digits=4):
    return df.select(*[F.round(c, digits).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


def _stats(frame=""):
    cond = {"": "", "d1": " and ts <= t0 + interval 1 day", "d7": ""}[frame]
    pre = f"{frame}_" if frame else ""
    fns = {"min": "min", "max": "max", "mean": "avg"}
    return ", ".join(
        f"round({fn}(value) filter (event_type = '{e}'{cond}), 8) as {pre}{e}_{s}" for e in TYPES for s, fn in fns.items())


@check("vitals_first_day", "JON3 AGG2 DAT1", f"""
with {ANCHOR}
select user_id, {_stats()} from events join anchor using (user_id)
where ts <= t0 + interval 1 day group by user_id""")
def vitals_first_day(spark, d):
    seen = anchored(Tables(spark, d), 1)
    return rounded(P.summarise(seen, ["user_id"], "event_type", "value", {e: [e] for e in TYPES}, ["min", "max", "mean"]), 8)


@check("vitals_two_frames", "FLT4 AGG3 AGG5 CON3", f"""
with {ANCHOR}
select user_id, {_stats("d1")}, {_stats("d7")} from events join anchor using (user_id)
where ts <= t0 + interval 7 day group by user_id""")
def vitals_two_frames(spark, d):
    frames = {"d7": F.lit(True), "d1": F.col("ts") <= S.shift("t0", days=1)}
    seen = anchored(Tables(spark, d), 7)
    return rounded(P.summarise(seen, ["user_id"], "event_type", "value", {e: [e] for e in TYPES},
                               ["min", "max", "mean"], frames), 8)


@check("label_sets", "AGG5 AGG4", """
select user_id,
  min(value) filter (event_type in ('view','click') and value between 1 and 200) as browse_min,
  max(value) filter (event_type in ('view','click') and value between 1 and 200) as browse_max,
  min(value) filter (event_type in ('purchase','signup') and value between 5 and 150) as convert_min,
  max(value) filter (event_type in ('purchase','signup') and value between 5 and 150) as convert_max
from events group by user_id""")
def label_sets(spark, d):
    def of(*names):
        return F.when(F.col("event_type").isin(*names), F.col("value"))
    return P.minmax(Tables(spark, d).events, ["user_id"],
                    {"browse": of("view", "click"), "convert": of("purchase", "signup")},
                    ranges={"browse": (1, 200), "convert": (5, 150)})


@check("offset_minutes", "DAT2", f"""
with {ANCHOR}
select event_id, round(date_diff('microsecond', t0, ts) / 6e7, 4) as offset_min
from events join anchor using (user_id)""")
def offset_minutes(spark, d):
    t = Tables(spark, d)
    first = t.events.groupBy("user_id").agg(F.min("ts").alias("t0"))
    return t.events.join(first, "user_id").select("event_id", F.round(S.elapsed("t0", "ts"), 4).alias("offset_min"))


@check("open_offset_window", "FLT5", f"""
with {ANCHOR}, o as (select event_id, date_diff('microsecond', t0, ts) / 6e7 as m from events join anchor using (user_id))
select event_id, round(m, 4) as m from o where m > 0 and m < 4320""")
def open_offset_window(spark, d):
    t = Tables(spark, d)
    seen = anchored(t, 3).withColumn("m", S.elapsed("t0", "ts"))
    return rounded(WI.offset_window(seen, "m", 0, 4320, closed=False).select("event_id", "m"))


@check("long_to_wide", "AGG1", "select user_id, cast(ts as date) as day, " + ", ".join(
    f"max(value) filter (event_type = '{e}') as {e}" for e in TYPES) + " from events group by 1, 2")
def long_to_wide(spark, d):
    ev = Tables(spark, d).events.withColumn("day", F.to_date("ts"))
    return P.long_to_wide(ev, ["user_id", "day"], "event_type", "value", TYPES)


@check("signed_sum", "AGG6 CON6", """
select user_id, round(sum(case when event_type = 'error' then -value else value end), 4) as balance
from events group by user_id""")
def signed_sum(spark, d):
    out = P.signed_sum(Tables(spark, d).events, ["user_id"], "value", F.col("event_type") == "error", "balance")
    return rounded(out)


@check("first_times", "AGG7 AGG8 DAT5", """
select user_id, min(ts) filter (value > 100) as first_high, min(ts) as first_ts, max(ts) as last_ts,
  cast(case when max(ts) - min(ts) < interval 25 day then 1 else 0 end as integer) as short
from events group by user_id""")
def first_times(spark, d):
    ev = Tables(spark, d).events
    high = P.first_time_where(ev, ["user_id"], "ts", F.col("value") > 100, "first_high")
    span = P.observed_span(ev, ["user_id"], "ts", "first_ts", "last_ts")
    short = F.when(F.col("last_ts") - F.col("first_ts") < F.expr("INTERVAL '25' DAY"), 1).otherwise(0)
    return J.assemble(span, [high], "user_id").withColumn("short", short)


@check("any_flag", "AGG9 AGG10", """
select user_id, max(case when event_type = 'signup' then 1 else 0 end) as signed_up,
  round(avg(value) filter (event_type = 'view'), 8) as view_mean from events group by user_id""")
def any_flag(spark, d):
    ev = Tables(spark, d).events
    flag = P.any_flag(ev, ["user_id"], F.col("event_type") == "signup", "signed_up")
    mean = P.summarise(ev, ["user_id"], "event_type", "value", {"view": ["view"]}, ["mean"])
    return rounded(J.assemble(flag, [mean], "user_id"), 8)


@check("conditional_having", "AGG12", """
select user_id, cast(ts as date) as day, count(*) as n from events group by 1, 2
having count(case when event_type = 'purchase' then 1 end) < 2""")
def conditional_having(spark, d):
    bought = F.count(F.when(F.col("event_type") == "purchase", 1))
    days = Tables(spark, d).events.groupBy("user_id", F.to_date("ts").alias("day"))
    return days.agg(F.count("*").alias("n"), bought.alias("b")).where("b < 2").drop("b")


@check("ratio_range", "AGG14 MTH7", """
select l_suppkey, round(min(l_extendedprice / nullif(l_quantity, 0)), 8) as unit_min,
  round(max(l_extendedprice / nullif(l_quantity, 0)), 8) as unit_max from lineitem group by 1""")
def ratio_range(spark, d):
    unit = {"unit": S.pf_ratio("l_extendedprice", "l_quantity")}
    return rounded(P.minmax(Tables(spark, d).lineitem, ["l_suppkey"], unit), 8)


# --- joins ------------------------------------------------------------------------------------
@check("asof_tolerance", "JON4 WIN9", """
select p.event_id, p.user_id, case when v.ts >= p.ts - interval 2 hour then v.value end as view_value,
  case when v.ts >= p.ts - interval 2 hour then v.ts end as view_ts
from (select * from events where event_type = 'purchase') p
asof left join (select * from events where event_type = 'view') v on p.user_id = v.user_id and p.ts >= v.ts""")
def asof_tolerance(spark, d):
    ev = Tables(spark, d).events
    bought = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    seen = ev.where("event_type = 'view'").select("user_id", F.col("ts").alias("seen_at"), "value")
    take = {"value": "view_value", "seen_at": "view_ts"}
    hit = O.asof_backward(bought, ["user_id"], "ts", [O.Carried(seen, "seen_at", 2 * HOUR, take)])
    return hit.drop("ts")


@check("prev_within", "JON5 WIN6", """
select event_id, case when ts - lag(ts) over w < interval 6 hour then lag(value) over w else -1.0 end as prev_value
from events window w as (partition by user_id order by ts, event_id)""")
def prev_within(spark, d):
    out = O.previous_within(Tables(spark, d).events, ["user_id"], "ts", ["value"], 6 * HOUR, ["event_id"])
    return out.select("event_id", F.coalesce("prev_value", F.lit(-1.0)).alias("prev_value"))


@check("interval_overlap", "JON6", """
with o as (select o_custkey, min(o_orderdate) as a0, max(o_orderdate) as a1 from orders group by 1),
l as (select o_custkey, min(l_shipdate) as b0, max(l_shipdate) as b1
  from lineitem join orders on l_orderkey = o_orderkey group by 1)
select o.o_custkey, a0, a1, b0, b1 from o join l on o.o_custkey = l.o_custkey and a0 <= b1 and b0 <= a1""")
def interval_overlap(spark, d):
    t = Tables(spark, d)
    ordered = P.observed_span(t.orders, ["o_custkey"], "o_orderdate", "a0", "a1")
    # ship dates reduce to one span per order before they meet the customer
    per_order = P.observed_span(t.lineitem, ["l_orderkey"], "l_shipdate", "b0", "b1")
    keyed = per_order.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    shipped = keyed.groupBy("o_custkey").agg(F.min("b0").alias("b0"), F.max("b1").alias("b1"))
    return WI.span_overlap(ordered, shipped, ["o_custkey"], ("a0", "a1"), ("b0", "b1"))


@check("overlap_flag", "JON6", """
select p_partkey, cast(max(case when p_partkey is not null and
    timestamp '1998-01-01' >= o_start - interval 1 day and timestamp '1998-01-01' <= o_end then 1 else 0 end) as integer) as active
from part left join (select l_partkey, min(l_shipdate) as o_start, max(l_shipdate) as o_end from lineitem group by 1)
  on p_partkey = l_partkey group by 1""")
def overlap_flag(spark, d):
    t = Tables(spark, d)
    spans = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.min("l_shipdate").alias("s"), F.max("l_shipdate").alias("e"))
    base = t.part.select("p_partkey", F.expr("timestamp_ntz'1998-01-01'").alias("at"))
    return WI.overlap_flag(base, spans, "p_partkey", "at", "s", "e", F.expr("INTERVAL 1 DAY"), "active").drop("at")


@check("semi_cohort", "JON7 JON15", """
select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_totalprice > 400000)""")
def semi_cohort(spark, d):
    t = Tables(spark, d)
    big = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return J.in_cohort(t.customer.select("c_custkey", "c_name"), big, ["c_custkey"])


@check("anti_cohort", "JON15", """
select c_custkey, c_name from customer where c_custkey not in
  (select o_custkey from orders where o_totalprice > 400000)""")
def anti_cohort(spark, d):
    t = Tables(spark, d)
    big = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return J.not_in_cohort(t.customer.select("c_custkey", "c_name"), big, ["c_custkey"])


@check("wide_assembly", "JON1 JON2 JON8 PRJ10", """
select c_custkey, c_mktsegment, n_name, n_orders, spend, n_high, cast(null as double) as unknown
from customer join nation on c_nationkey = n_nationkey
left join (select o_custkey, count(*) as n_orders, round(sum(o_totalprice), 2) as spend from orders group by 1) a
  on c_custkey = a.o_custkey
left join (select o_custkey, count(*) as n_high from orders where o_orderpriority = '2-HIGH' group by 1) b
  on c_custkey = b.o_custkey""")
def wide_assembly(spark, d):
    t = Tables(spark, d)
    by = t.orders.withColumnRenamed("o_custkey", "c_custkey").groupBy("c_custkey")
    spend = by.agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spend"))
    high = t.orders.where("o_orderpriority = '2-HIGH'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_high"))
    base = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    wide = J.assemble(base, [spend, high], "c_custkey")
    return wide.select("c_custkey", "c_mktsegment", "n_name", "n_orders", "spend", "n_high",
                       F.lit(None).cast("double").alias("unknown"))


@check("drop_conflicts", "JON9 AGG13", """
with g as (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(distinct l_quantity) <= 1)
select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem join g using (l_orderkey, l_linenumber)""")
def drop_conflicts(spark, d):
    rows = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return J.keep_consistent(rows, ["l_orderkey", "l_linenumber"], "l_quantity")


@check("latest_revision", "WIN5 SRT3", """
select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_quantity from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
    order by l_shipdate desc, l_partkey, l_suppkey, l_quantity, l_extendedprice) as rn from lineitem) where rn = 1""")
def latest_revision(spark, d):
    order = [O.descending_time("l_shipdate"), *map(F.col, ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))]
    return O.first_row(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"], order,
                       ["l_shipdate", "l_partkey", "l_quantity"])


@check("latest_consistent", "WIN5 JON9 CON5", """
with g as (select l_orderkey, l_linenumber, l_shipdate, min(l_quantity) as q from lineitem group by 1, 2, 3
  having count(distinct l_quantity) <= 1),
r as (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc) as rn
  from g where q between 5 and 45)
select l_orderkey, l_linenumber, q as l_quantity from r where rn = 1""")
def latest_consistent(spark, d):
    return J.latest_consistent(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate", "l_quantity",
                               F.col("l_quantity").between(5, 45))


@check("coverage_flag", "JON16", """
with n as (select c_nationkey, c_mktsegment, count(o_orderkey) as k from customer join orders on o_custkey = c_custkey
  where year(o_orderdate) = 1995 and o_totalprice > 300000 group by 1, 2)
select c_custkey, case when k > 3 then 1 else 0 end as covered from customer left join n using (c_nationkey, c_mktsegment)""")
def coverage_flag(spark, d):
    t = Tables(spark, d)
    year = t.orders.where((F.year("o_orderdate") == 1995) & (F.col("o_totalprice") > 300000)).select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    group = ["c_nationkey", "c_mktsegment"]
    n = J.coverage(t.customer, year, "c_custkey", group, "o_orderkey", "k")
    return t.customer.join(n, group, "left").select("c_custkey", F.when(F.col("k") > 3, 1).otherwise(0).alias("covered"))


@check("composite_lookup", "JON10 JON11", """
with m as (select p_brand, p_type, min(p_retailprice) as base_price from part group by 1, 2)
select l_orderkey, l_linenumber, l_partkey, base_price from lineitem join part on l_partkey = p_partkey
left join m using (p_brand, p_type)""")
def composite_lookup(spark, d):
    t = Tables(spark, d)
    prices = t.part.groupBy("p_brand", "p_type").agg(F.min("p_retailprice").alias("base_price"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type"), "l_partkey")
    found = J.lookup(rows, prices, {"p_brand": "p_brand", "p_type": "p_type"}, {"base_price": "base_price"})
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "base_price")


@check("two_step_lookup", "JON12", """
with m as (select p_brand as code, p_type as kind, min(p_size) as size from part where p_size > 45 group by 1, 2),
amb as (select code from m group by 1 having count(*) > 1)
select p_partkey, coalesce(a.size, b.size) as size from part
left join (select * from m where code not in (select code from amb)) a on p_brand = a.code
left join (select * from m where code in (select code from amb)) b on p_brand = b.code and p_type = b.kind""")
def two_step_lookup(spark, d):
    t = Tables(spark, d)
    dim = t.part.where("p_size > 45").groupBy(F.col("p_brand").alias("code"), F.col("p_type").alias("kind")).agg(
        F.min("p_size").alias("size"))
    return J.two_step_lookup(t.part.select("p_partkey", "p_brand", "p_type"), dim, ("p_brand", "code"),
                             ("p_type", "kind"), ["size"]).select("p_partkey", "size")


@check("code_bridge", "JON13 AGG27 STR7", """
with m as (select cast(p_size % 12 as varchar) || '.' || cast(p_partkey % 3 as varchar) as code, p_type from part)
select distinct split_part(code, '.', 1) as code, p_type from m where split_part(code, '.', 1) <> '0'""")
def code_bridge(spark, d):
    part = Tables(spark, d).part
    code = F.concat((F.col("p_size") % 12).cast("string"), F.lit("."), (F.col("p_partkey") % 3).cast("string"))
    return J.code_bridge(part.select(code.alias("code"), "p_type"), "code", "p_type")


RECON = """(select c_custkey, case when c_custkey % 10 = 0 then null else c_acctbal end as bal,
  case when c_custkey % 7 = 0 then 'X' else c_mktsegment end as seg from customer where c_custkey % 4 > 0)"""


@check("reconcile", "JON14", f"""
with j as (select a.*, b.bal, b.seg from (select c_custkey, c_acctbal as abal, c_mktsegment as aseg from customer) a
  left join {RECON} b on a.c_custkey = b.c_custkey)
select count(*) as n_rows, 'bal' as variable, cast(sum(case when abal is not distinct from bal then 1 else 0 end) as bigint) as n_match from j
union all
select count(*), 'seg', cast(sum(case when aseg is not distinct from seg then 1 else 0 end) as bigint) from j""")
def reconcile(spark, d):
    cust = Tables(spark, d).customer
    a = cust.select("c_custkey", F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    b = a.where("c_custkey % 4 > 0").select(
        "c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("bal")).alias("bal"),
        F.when(F.col("c_custkey") % 7 == 0, "X").otherwise(F.col("seg")).alias("seg"))
    return J.reconcile(a, b, "c_custkey", ["bal", "seg"])


@check("mismatches", "JON14", f"""
select a.c_custkey, a.c_mktsegment as seg_a, b.seg as seg_b from customer a left join {RECON} b
  on a.c_custkey = b.c_custkey where a.c_mktsegment is distinct from b.seg""")
def mismatches(spark, d):
    cust = Tables(spark, d).customer
    a = cust.select("c_custkey", F.col("c_mktsegment").alias("seg"))
    b = a.where("c_custkey % 4 > 0").withColumn("seg", F.when(F.col("c_custkey") % 7 == 0, "X").otherwise(F.col("seg")))
    return J.mismatches(a, b, "c_custkey", "seg")


# --- ordered ----------------------------------------------------------------------------------
@check("seq_number", "WIN2 WIN6 WIN11", """
select o_orderkey, o_custkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as seq
from orders""")
def seq_number(spark, d):
    out = O.sequence(Tables(spark, d).orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")],
                     O.time_cell("o_orderdate", 7 * DAY))
    return out.select("o_orderkey", "o_custkey", F.col("seq").cast("long").alias("seq"))


@check("rank_orders", "WIN3", """
select o_orderkey, rank() over (partition by o_custkey order by o_orderdate) as rnk from orders""")
def rank_orders(spark, d):
    out = O.sequence(Tables(spark, d).orders, ["o_custkey"], [F.col("o_orderdate")],
                     O.time_cell("o_orderdate", 7 * DAY), "rnk", ties=True)
    return out.select("o_orderkey", F.col("rnk").cast("long").alias("rnk"))


@check("dup_flag", "WIN10", """
select l_orderkey, l_linenumber, l_suppkey, l_partkey, cast(case when row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_suppkey, l_partkey, l_extendedprice) > 1 then 1 else 0 end as integer) as dup from lineitem""")
def dup_flag(spark, d):
    order = [F.col("l_shipdate").desc_nulls_first(), F.col("l_suppkey"), F.col("l_partkey"), F.col("l_extendedprice")]
    newest_first = -O.time_cell("l_shipdate", 7 * DAY)
    out = O.sequence(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"], order, newest_first, "no")
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", (F.col("no") > 1).cast("int").alias("dup"))


@check("running_spend", "MTH11", """
select o_orderkey, round(sum(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey
  rows unbounded preceding), 2) as spent from orders""")
def running_spend(spark, d):
    out = O.running_total(Tables(spark, d).orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")],
                          F.col("o_totalprice"), O.time_cell("o_orderdate", 7 * DAY), "spent")
    return out.select("o_orderkey", F.round("spent", 2).alias("spent"))


@check("first_stay", "WIN4 COH3", """
select o_custkey, o_orderkey, o_orderdate, o_totalprice from (select *, row_number() over (partition by o_custkey
  order by year(o_orderdate), o_totalprice desc, o_orderkey) as rn from orders where o_orderstatus <> 'P') where rn = 1""")
def first_stay(spark, d):
    done = Tables(spark, d).orders.where("o_orderstatus <> 'P'")
    order = [F.year("o_orderdate"), O.descending("o_totalprice"), F.col("o_orderkey")]
    return C.first_stay(done, ["o_custkey"], order, ["o_orderkey", "o_orderdate", "o_totalprice"])


@check("latest_before", "WIN1", f"""
with {ANCHOR}
select user_id, event_id, event_type from (select e.*, row_number() over (partition by e.user_id order by ts desc, event_id) as rn
  from events e join anchor a on e.user_id = a.user_id and e.ts < a.t0 + interval 3 day) where rn = 1""")
def latest_before(spark, d):
    ev = Tables(spark, d).events
    cut = ev.groupBy("user_id").agg((F.min("ts") + F.expr("INTERVAL 3 DAY")).alias("cut"))
    latest = F.struct("ts", (-F.col("event_id")).alias("order"), "event_id", "event_type")
    found = O.totals_before(cut, ["user_id"], "cut", ev, "ts", maxima={"latest": latest}).where("latest is not null")
    return found.select("user_id", "latest.event_id", "latest.event_type")


@check("view_before_purchase", "WIN1 WIN9", """
with p as (select event_id, user_id, ts from events where event_type = 'purchase'),
s as (select user_id, ts, event_id, event_type, value from events where event_type in ('view', 'purchase')),
w as (select event_id, event_type, max(case when event_type = 'view' then ts end) over o as view_ts,
  count(case when event_type = 'view' then 1 end) over o as n_views, sum(case when event_type = 'view' then value end) over o as spent
  from s window o as (partition by user_id order by ts range between unbounded preceding and interval 1 microsecond preceding))
select event_id, view_ts, n_views, round(coalesce(spent, 0), 4) as spent from w where event_type = 'purchase'""")
def view_before_purchase(spark, d):
    ev = Tables(spark, d).events
    bought = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = ev.where("event_type = 'view'").select("user_id", F.col("ts").alias("t"), "value")
    out = O.totals_before(bought, ["user_id"], "ts", views, "t", {"n_views": F.lit(1), "spent": F.col("value")}, {"view_ts": F.col("t")})
    return out.select("event_id", "view_ts", F.coalesce("n_views", F.lit(0).cast("long")).alias("n_views"),
                      F.round(F.coalesce("spent", F.lit(0.0)), 4).alias("spent"))


@check("worst_obs", "WIN7 WIN8 SRT3", """
select user_id, event_id, value, event_type from (select *, row_number() over (partition by user_id order by value,
  case when event_type = 'error' then 0 else 1 end, ts desc nulls first, event_id) as rn from events) where rn = 1""")
def worst_obs(spark, d):
    order = [F.col("value"), F.col("event_type") != "error", O.descending_time("ts"), F.col("event_id")]
    return O.first_row(Tables(spark, d).events, ["user_id"], order, ["event_id", "value", "event_type"])


@check("sorted_peek", "SRT1 SRT2 SRT4", """
select c_custkey, c_acctbal from customer order by c_acctbal desc, c_custkey limit 50""")
def sorted_peek(spark, d):
    return Tables(spark, d).customer.select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(50)
