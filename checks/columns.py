"""Cleaning, recoding, units, text, time and scoring expressions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions import scalars as S
from wardline.functions import text as X
from wardline.operators import conform as CF
from wardline.operators import joins as J
from wardline.operators import score as SC
from wardline.operators.cohort import attrition as attrition_of
from wardline.operators.cohort import flag_exclusions

from .base import Tables, check
from .shaping import rounded

RANGES = {"view": (1, 200), "click": (2, 150), "purchase": (5, 400), "error": (0, 100)}


@check("range_clean", "PRJ2 PRJ1", """
select event_id, case event_type when 'view' then case when value between 1 and 200 then value end
  when 'click' then case when value between 2 and 150 then value end
  when 'purchase' then case when value between 5 and 400 then value end
  when 'error' then case when value between 0 and 100 then value end end as clean from events""")
def range_clean(spark, d):
    out = None
    for kind, (lo, hi) in RANGES.items():
        cond, kept = F.col("event_type") == kind, S.keep_within("value", lo, hi)
        out = F.when(cond, kept) if out is None else out.when(cond, kept)
    return Tables(spark, d).events.select("event_id", out.alias("clean"))


@check("filter_valid", "PRJ3 FLT1", """
select event_id, event_type, value from events where (event_type in ('view','click') and value > 2 and value <= 150)
  or (event_type = 'purchase' and value >= 10 and value < 300)""")
def filter_valid(spark, d):
    rules = [(("view", "click"), 2, 150, False, True), (("purchase",), 10, 300, True, False)]
    return J.filter_valid(Tables(spark, d).events.select("event_id", "event_type", "value"), "event_type", "value", rules)


@check("label_valid", "PRJ4", """
select event_id, case when event_type in ('view','click') and value > 0 and value < 80 then 'browse'
  when event_type = 'purchase' and value > 10 then 'buy' end as label from events""")
def label_valid(spark, d):
    rules = [("browse", ("view", "click"), 0, 80, False, False), ("buy", ("purchase",), 10, None, False, False)]
    return Tables(spark, d).events.select("event_id", J.label_valid("event_type", "value", rules).alias("label"))


@check("null_safe_filter", "FLT2 FLT3", """
select d.doc_id, d.lang, quality from documents d left join labels l on d.doc_id = l.doc_id
where quality is distinct from 1""")
def null_safe_filter(spark, d):
    t = Tables(spark, d)
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return joined.where(S.differs("quality", 1)).select("doc_id", "lang", "quality")


@check("mask_filter", "FLT8 FLT9", """
select d.doc_id, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id
where not coalesce(toxic > 0, false) and quality is not null""")
def mask_filter(spark, d):
    t = Tables(spark, d)
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return joined.where(~S.is_true(F.col("toxic") > 0)).na.drop(subset=["quality"])


@check("numeric_text", "FLT6 SCH3 STR3", r"""
with whole as (select event_id, regexp_extract(props, '^\{"k": (.*)\}$', 1) as k from events),
mixed as (select event_id, case event_id % 5 when 0 then '-' || k || '.5' when 1 then k || ' mg' when 2 then '.' else k end as k from whole)
select event_id, case when regexp_matches(k, '^-?[0-9]+\.?[0-9]*$') then try_cast(k as double) end as k from mixed""")
def numeric_text(spark, d):
    k = F.regexp_extract("props", r'^\{"k": (.*)\}$', 1)
    mixed = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("-"), k, F.lit(".5"))).when(
        F.col("event_id") % 5 == 1, F.concat(k, F.lit(" mg"))).when(F.col("event_id") % 5 == 2, F.lit(".")).otherwise(k)
    return Tables(spark, d).events.select("event_id", S.numeric_text(mixed).alias("k"))


@check("recode_groups", "PRJ5", """
select o_orderkey, case when o_orderpriority in ('1-URGENT','2-HIGH') then 'fast'
  when o_orderpriority in ('3-MEDIUM') then 'normal' else 'other' end as speed from orders""")
def recode_groups(spark, d):
    groups = {"fast": ["1-URGENT", "2-HIGH"], "normal": ["3-MEDIUM"]}
    return Tables(spark, d).orders.select("o_orderkey", S.recode("o_orderpriority", groups, "other").alias("speed"))


@check("map_codes", "PRJ6 LOG1", """
select c_custkey, case c_mktsegment when 'BUILDING' then 1 when 'MACHINERY' then 2 end as code,
  cast(coalesce(c_nationkey = 3, false) or coalesce(c_custkey % 5 = 3, false) as integer) as any3 from customer""")
def map_codes(spark, d):
    code = S.map_codes("c_mktsegment", {"BUILDING": 1, "MACHINERY": 2, "AUTOMOBILE": None})
    return Tables(spark, d).customer.select(
        "c_custkey", code.alias("code"), S.any_equal(["c_nationkey", F.col("c_custkey") % 5], 3).alias("any3"))


@check("band", "PRJ7", """
select p_partkey, case when p_size < 0 then null when p_size < 10 then '<10' when p_size < 25 then '10 - 24'
  when p_size < 50 then '25 - 49' else '>= 50' end as size_band from part""")
def band(spark, d):
    out = S.band("p_size", [0, 10, 25, 50], [None, "<10", "10 - 24", "25 - 49", ">= 50"])
    return Tables(spark, d).part.select("p_partkey", out.alias("size_band"))


@check("sentinel_null", "PRJ8", """
select l_orderkey, count(nullif(l_linenumber, 1)) as n, cast(sum(nullif(l_linenumber, 1)) as bigint) as s
from lineitem group by 1""")
def sentinel_null(spark, d):
    v = S.sentinel_null("l_linenumber", 1)
    return Tables(spark, d).lineitem.groupBy("l_orderkey").agg(F.count(v).alias("n"), F.sum(v).alias("s"))


@check("unit_convert", "MTH2 MTH3 MTH4 MTH5", """
select event_id, round(case when event_type in ('view','click') then (value - 32) / 1.8 else value end, 4) as celsius,
  round(case when value > 77 and value < 114.8 then (value - 32) / 1.8 when value > 25 and value < 46 then value end, 4) as by_size,
  round(value * 18.018018, 4) as mg,
  round(case when value >= 0.5 and value < 3 then value * 100 when value >= 50 and value <= 300 then value end, 4) as cm,
  round(value * 2.54, 4) as inch_cm,
  round(case when value >= 20 then value / 100.0 else value end, 4) as fraction from events""")
def unit_convert(spark, d):
    by_type = F.when(F.col("event_type").isin("view", "click"), S.fahrenheit_to_celsius("value")).otherwise(F.col("value"))
    return rounded(Tables(spark, d).events.select(
        "event_id", by_type.alias("celsius"), S.celsius_by_value("value").alias("by_size"),
        S.convert("value", "mmol_glucose_to_mg_dl").alias("mg"), S.metres_or_cm("value").alias("cm"),
        S.inches_to_cm("value").alias("inch_cm"), S.percent_to_fraction("value").alias("fraction")))


@check("coalesce_priority", "PRJ9 PRJ14", """
select user_id, coalesce(min(value) filter (event_type = 'purchase' and value > 150),
  min(value) filter (event_type = 'click' and value > 100), min(value) filter (event_type = 'view')) as best from events group by 1""")
def coalesce_priority(spark, d):
    def low(kind, over):
        return F.min(F.when((F.col("event_type") == kind) & (F.col("value") > over), F.col("value")))
    return Tables(spark, d).events.groupBy("user_id").agg(
        F.coalesce(low("purchase", 150), low("click", 100), low("view", -1)).alias("best"))


@check("greatest_least", "PRJ15", """
with a as (select user_id, max(value) filter (event_type = 'error' and value > 120) as e,
  max(value) filter (event_type = 'view' and value > 150) as v from events group by 1)
select user_id, greatest(e, v) as hi, least(e, v) as lo from a""")
def greatest_least(spark, d):
    def top(kind, over):
        return F.max(F.when((F.col("event_type") == kind) & (F.col("value") > over), F.col("value")))
    both = Tables(spark, d).events.groupBy("user_id").agg(top("error", 120).alias("e"), top("view", 150).alias("v"))
    return both.select("user_id", F.greatest("e", "v").alias("hi"), F.least("e", "v").alias("lo"))


@check("overwrite_where", "PRJ12 PRJ11", """
select c_custkey, case when c_acctbal > 9000 and c_mktsegment = 'BUILDING' then 9000.0 else c_acctbal end as c_acctbal,
  case when c_mktsegment in ('BUILDING','FURNITURE') then 'HOME' else c_mktsegment end as c_mktsegment from customer""")
def overwrite_where(spark, d):
    cust = Tables(spark, d).customer.drop("c_name", "c_nationkey")
    capped = CF.overwrite_where(cust, "c_acctbal", (F.col("c_acctbal") > 9000) & (F.col("c_mktsegment") == "BUILDING"), 9000.0)
    return CF.unify_tags(capped, "c_mktsegment", ["BUILDING", "FURNITURE"], "HOME")


MEASURES = """(select p_partkey, case p_partkey % 3 when 0 then p_size || ' kg' when 1 then cast(p_size as varchar) else 'n/a' end as w,
  case p_partkey % 5 when 0 then p_size || ' inch' when 1 then 'NA ' || p_size when 2 then p_size || 'cm' when 3 then 'na' else cast(p_size + 120 as varchar) end as h,
  case p_partkey % 5 when 0 then p_size || ' months' when 1 then p_size || ' yrs' when 2 then p_size || ' Years' when 3 then cast(p_size * 5 as varchar) else 'old' end as a
  from part)"""


def _measures(part):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")

    def join(a, b):
        return F.concat(a if not isinstance(a, str) else F.lit(a), b if not isinstance(b, str) else F.lit(b))
    w = F.when(k % 3 == 0, join(size, " kg")).when(k % 3 == 1, size).otherwise("n/a")
    h = (F.when(k % 5 == 0, join(size, " inch")).when(k % 5 == 1, join("NA ", size)).when(k % 5 == 2, join(size, "cm"))
         .when(k % 5 == 3, "na").otherwise((F.col("p_size") + 120).cast("string")))
    a = (F.when(k % 5 == 0, join(size, " months")).when(k % 5 == 1, join(size, " yrs")).when(k % 5 == 2, join(size, " Years"))
         .when(k % 5 == 3, (F.col("p_size") * 5).cast("string")).otherwise("old"))
    return part.select("p_partkey", w.alias("w"), h.alias("h"), a.alias("a"))


@check("parse_units", "STR4 STR5 STR6 MTH12", f"""
select p_partkey, try_cast(trim(replace(w, 'kg', '')) as double) as kg,
  round(case when lower(h) like '%inch%' then try_cast(trim(replace(lower(h), 'inch', '')) as double) * 2.54
    when lower(h) like '%cm%' then try_cast(trim(replace(lower(h), 'cm', '')) as double)
    else try_cast(trim(replace(lower(h), 'na', '')) as double) end, 4) as cm,
  round(case when lower(a) like '%months%' then try_cast(trim(replace(lower(a), 'months', '')) as double) / 12.0
    when lower(a) like '%yrs%' then try_cast(trim(replace(lower(a), 'yrs', '')) as double)
    when lower(a) like '%years%' then try_cast(trim(replace(lower(a), 'years', '')) as double)
    when try_cast(a as double) <= 150 then try_cast(a as double) end, 4) as years,
  case when try_cast(a as double) between 0 and 100 then try_cast(a as double) end as pct from {MEASURES}""")
def parse_units(spark, d):
    m = _measures(Tables(spark, d).part)
    return rounded(m.select("p_partkey", X.parse_weight("w").alias("kg"), X.parse_height("h").alias("cm"),
                            X.parse_age("a").alias("years"), S.percent_or_null(S.to_number("a")).alias("pct")))


@check("rescue_misplaced", "PRJ13", f"""
select p_partkey, case when h like '%NA%' then trim(replace(h, 'NA', '')) else w end as w,
  case when h like '%NA%' then 'na' else h end as h from {MEASURES}""")
def rescue_misplaced(spark, d):
    w, h = X.rescue_misplaced("w", "h")
    return _measures(Tables(spark, d).part).select("p_partkey", w.alias("w"), h.alias("h"))


@check("keys_and_codes", "STR1 STR7 STR8 STR9 STR10 STR11", """
select p_partkey, 'p_' || p_partkey || '_' || p_brand as key, split_part(cast(p_retailprice as varchar), '.', 1) as main,
  case when lower(p_name) like '%bolt%' then 'metal' else 'other' end as kind, nullif(cast(p_size % 4 as varchar), '0') as code
from part""")
def keys_and_codes(spark, d):
    return Tables(spark, d).part.select(
        "p_partkey", X.key_of(F.lit("p_"), "p_partkey", F.lit("_"), "p_brand").alias("key"),
        X.main_code(F.col("p_retailprice").cast("string")).alias("main"),
        X.contains_flag(F.lower("p_name"), "bolt", "metal", "other").alias("kind"),
        X.code_text(F.col("p_size") % 4).alias("code"))


@check("regex_flags", "STR2 AGG11", """
select source, min(case when regexp_matches(text, '\\b(never|not|no|none)\\b', 'i') then 0
  when regexp_matches(text, '(tion|ment)\\.', 'i') then 1 when regexp_matches(text, 'e', 'i') then 2 end) as code,
  count(case when regexp_matches(text, '\\b(never|not|no|none)\\b', 'i') then 1 end) as n_negative from documents group by 1""")
def regex_flags(spark, d):
    rules = [(r"\b(never|not|no|none)\b", 0), (r"(tion|ment)\.", 1), ("e", 2)]
    code = X.first_match_code("text", rules)
    return Tables(spark, d).documents.groupBy("source").agg(
        F.min(code).alias("code"), F.count(F.when(X.matches("text", rules[0][0]), 1)).alias("n_negative"))


# --- time ---------------------------------------------------------------------------------------
@check("age_years", "DAT3 DAT4 DAT1 MTH10", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as days,
  round(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) / 365.242, 4) as years,
  round(case when l_shipdate > o_orderdate + interval 3 year then 91.6
    else date_diff('microsecond', o_orderdate, l_shipdate) / 8.64e10 / 365.242 end, 2) + 0.0 as top_coded
from lineitem join orders on l_orderkey = o_orderkey""")
def age_years(spark, d):
    t = Tables(spark, d)
    both = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       S.days_between("o_orderdate", "l_shipdate").cast("long").alias("days"),
                       S.age_years("o_orderdate", "l_shipdate", 4).alias("years"),
                       S.age_topcoded("o_orderdate", "l_shipdate", shifted_years=3).alias("top_coded"))


@check("year_filter", "FLT7 DAT6 DAT7 SCH4", """
select o_orderkey, year(o_orderdate) as y, round(o_totalprice / 60.0 / 24.0, 8) as day_part,
  try_cast(cast(cast(o_orderdate as date) as varchar) || ' ' || cast(10 + o_orderkey % 17 as varchar) || ':30:15.25' as timestamp) as parsed
from orders where year(o_orderdate) between 1995 and 1996""")
def year_filter(spark, d):
    kept = Tables(spark, d).orders.where(S.year_between("o_orderdate", 1995, 1996))
    hour = (F.col("o_orderkey") % 17 + 10).cast("string")  # 24 to 26 are no hours
    text = F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit(" "), hour, F.lit(":30:15.25"))
    return kept.select("o_orderkey", F.year("o_orderdate").cast("long").alias("y"),
                       F.round(S.minutes_to_days("o_totalprice"), 8).alias("day_part"), S.to_datetime(text).alias("parsed"))


# --- cohort ---------------------------------------------------------------------------------------
EXCL = """(select c_custkey, cast(coalesce(c_acctbal < 0, false) as integer) as exclusion_debt,
  cast(c_mktsegment = 'HOUSEHOLD' as integer) as exclusion_household,
  cast(coalesce(n < 10, false) as integer) as exclusion_few
  from customer left join (select o_custkey, count(*) as n from orders where o_totalprice > 100000 group by 1) on o_custkey = c_custkey)"""
FLAGS = ["exclusion_debt", "exclusion_household", "exclusion_few"]


def _flagged(t):
    n = t.orders.where("o_totalprice > 100000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return flag_exclusions(t.customer.join(n, "c_custkey", "left"), {
        "exclusion_debt": F.col("c_acctbal") < 0, "exclusion_household": F.col("c_mktsegment") == "HOUSEHOLD",
        "exclusion_few": F.col("n") < 10})


@check("cohort_flags", "FLT7 FLT8", f"select *, greatest({', '.join(FLAGS)}) as excluded from {EXCL}")
def cohort_flags(spark, d):
    return _flagged(Tables(spark, d)).select("c_custkey", *FLAGS, "excluded")


@check("attrition", "AGG23", f"""
with x as (select *, greatest({', '.join(FLAGS)}) as e from {EXCL}), n as (select count(*) as n0 from x)
select 'initial' as step, count(*) as n, 100.0::double as percent from x
union all select 'final', count(*) filter (e = 0), round(100.0 * count(*) filter (e = 0) / count(*), 4) from x
""" + "".join(f"union all select '{f}', cast(sum({f}) as bigint), round(100.0 * sum({f}) / count(*), 4) from x\n" for f in FLAGS))
def attrition(spark, d):
    return rounded(attrition_of(_flagged(Tables(spark, d)), FLAGS))


# --- conformance ----------------------------------------------------------------------------------
@check("stacked_sources", "SCH1 SCH5 SCH6 SCH7 SET1", """
select 'customer' as data_source, 'c_' || c_custkey as party, c_acctbal as balance, cast(c_nationkey as integer) as nation,
  c_mktsegment as segment, cast(null as varchar) as note from customer
union all select 'supplier', 's_' || s_suppkey, s_acctbal, cast(s_nationkey as integer), null, null from supplier""")
def stacked_sources(spark, d):
    t = Tables(spark, d)
    header = T.StructType([
        T.StructField("data_source", T.StringType()), T.StructField("party", T.StringType()),
        T.StructField("balance", T.DoubleType()), T.StructField("nation", T.IntegerType()),
        T.StructField("segment", T.StringType()), T.StructField("note", T.StringType())])
    upper = t.customer.toDF(*[c.upper() for c in t.customer.columns])
    a = CF.apply_field_map(CF.lower_columns(upper), {
        "data_source": F.lit("customer"), "party": X.key_of(F.lit("c_"), "c_custkey"), "balance": "c_acctbal",
        "nation": "c_nationkey", "segment": "c_mktsegment", "note": None}, header)
    b = CF.tag_source(t.supplier.select(X.key_of(F.lit("s_"), "s_suppkey").alias("party"),
                                        F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")), "supplier")
    return CF.stack([a, CF.conform(b, header)])


@check("restrict_names", "SET2", """
select distinct lower(p_type) as p_type from part where p_type in (select p_type from part where p_size > 49)
  and p_type is not null""")
def restrict_names(spark, d):
    part = Tables(spark, d).part
    big = part.where("p_size > 49").select("p_type")
    return CF.restrict_names(part.select("p_type"), big, "p_type").na.drop().select(F.lower("p_type").alias("p_type")).distinct()


# --- scores ---------------------------------------------------------------------------------------
HR = ([40, 50, 100, 110, 120, 140, 155], [8, 5, 0, 1, 5, 7, 13, 17])


def _hr_sql(v):
    edges = " ".join(f"when {v} < {e} then {p}" for e, p in zip(*HR))
    return f"case when {v} is null then null {edges} else {HR[1][-1]} end"


@check("worst_of_bands", "SCO1 SCO2 SCO8", f"""
with x as (select user_id, min(value) as lo, max(value) filter (event_type <> 'view') as hi from events group by 1),
s as (select *, {_hr_sql('lo')} as slo, {_hr_sql('hi')} as shi from x)
select user_id, cast(case when hi is null then null else greatest(slo, shi) end as integer) as points,
  case when hi is null then null when shi >= slo then hi else lo end as worst from s""")
def worst_of_bands(spark, d):
    ends = Tables(spark, d).events.groupBy("user_id").agg(
        F.min("value").alias("lo"), F.max(F.when(F.col("event_type") != "view", F.col("value"))).alias("hi"))
    points, value = SC.worst_of("lo", "hi", SC.band_score("lo", *HR), SC.band_score("hi", *HR))
    return ends.select("user_id", points.alias("points"), value.alias("worst"))


@check("context_bands", "SCO3", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, case when l_returnflag = 'R' and l_quantity < 14 then 0
  when l_quantity < 6 then 17 when l_quantity < 12 then 8 when l_quantity < 14 then 7 when l_quantity < 25 then 0
  when l_quantity < 35 then 6 when l_quantity < 40 then 9 when l_quantity < 50 then 11 else 18 end as points from lineitem""")
def context_bands(spark, d):
    plain = SC.band_score("l_quantity", [6, 12, 14, 25, 35, 40, 50], [17, 8, 7, 0, 6, 9, 11, 18])
    calm = (F.col("l_returnflag") == "R") & (F.col("l_quantity") < 14)
    return Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                                            SC.band_score_if(S.is_true(calm), F.lit(0), plain).alias("points"))


@check("grid_score", "SCO4 SCO5", """
with g(x0, x1, y0, y1, pts) as (values (-1e9, 10.0, -1e9, 0.02, 12), (-1e9, 10.0, 0.02, 1e9, 4), (10.0, 30.0, -1e9, 0.03, 9),
  (10.0, 30.0, 0.03, 0.06, 6), (10.0, 30.0, 0.06, 1e9, 3), (30.0, 1e9, -1e9, 0.05, 0), (30.0, 1e9, 0.05, 1e9, 1))
select l_orderkey, cast(sum(pts) as bigint) as points from lineitem join g on l_quantity >= x0 and l_quantity < x1
  and l_discount >= y0 and l_discount < y1 group by 1""")
def grid_score(spark, d):
    rows = [(10, [0.02], [12, 4]), (30, [0.03, 0.06], [9, 6, 3]), (None, [0.05], [0, 1])]
    pts = SC.grid_score("l_quantity", "l_discount", rows)
    return Tables(spark, d).lineitem.groupBy("l_orderkey").agg(F.sum(pts).alias("points"))


@check("score_total", "SCO10 MTH9 MTH11", """
with s as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, case when l_quantity > 10 then cast(l_quantity as integer) end as a,
  case when l_discount > 0.02 then 3 end as b, case when l_tax > 0.01 then 2 end as c from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, coalesce(a,0)+coalesce(b,0)+coalesce(c,0) as total, a+b+c as strict_total,
  round(1 / (1 + exp(-(-4.4360 + 0.04726 * (coalesce(a,0)+coalesce(b,0)+coalesce(c,0))))), 6) as p from s""")
def score_total(spark, d):
    line = Tables(spark, d).lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        F.when(F.col("l_quantity") > 10, F.col("l_quantity").cast("int")).alias("a"),
        F.when(F.col("l_discount") > 0.02, 3).alias("b"), F.when(F.col("l_tax") > 0.01, 2).alias("c"))
    total = S.sum_known(["a", "b", "c"])
    return line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", total.alias("total"),
                       S.sum_all(["a", "b", "c"]).alias("strict_total"),
                       F.round(S.logistic(-4.4360 + 0.04726 * total), 6).alias("p"))


@check("logistic_impute", "MTH8 SCO11", """
with u as (select user_id, avg(value) filter (event_type = 'view') as v, avg(value) filter (event_type = 'signup') as s,
  avg(value) filter (event_type = 'error' and value > 60) as e from events group by 1),
p as (select *, 1 / (1 + exp(-(-2.5 + coalesce(0.02 * v, 0.8) + coalesce(-0.01 * s, -0.3) + coalesce(0.03 * e, 1.9)))) as prob from u)
select user_id, round(prob, 6) as prob, case when prob > 0.75 then 'ART' end as label from p""")
def logistic_impute(spark, d):
    def mean(cond):
        return F.avg(F.when(cond, F.col("value")))
    kind = F.col("event_type")
    u = Tables(spark, d).events.groupBy("user_id").agg(
        mean(kind == "view").alias("v"), mean(kind == "signup").alias("s"),
        mean((kind == "error") & (F.col("value") > 60)).alias("e"))
    prob = S.logistic(F.lit(-2.5) + S.imputed_terms([(0.02, "v", 0.8), (-0.01, "s", -0.3), (0.03, "e", 1.9)]))
    return u.select("user_id", prob.alias("prob")).select(
        "user_id", F.round("prob", 6).alias("prob"), F.when(F.col("prob") > 0.75, "ART").alias("label"))


@check("body_mass", "MTH1 MTH6", """
select p_partkey, round(case when p_size > 3 then p_retailprice / 10 / nullif(p_size / 100.0 * p_size / 100.0, 0) end, 4) as bmi,
  round((0.5 * 713 - p_size / 0.8) - p_retailprice / 10, 4) as gradient from part""")
def body_mass(spark, d):
    part = Tables(spark, d).part
    mass = F.col("p_retailprice") / 10
    return rounded(part.select("p_partkey", F.when(F.col("p_size") > 3, S.bmi(mass, "p_size")).alias("bmi"),
                               S.aado2(F.lit(0.5), "p_size", mass).alias("gradient")))
