"""Profiling tables and modelling steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators import model as M
from wardline.operators import profile as PR

from .base import Tables, check
from .shaping import rounded

DL = "(select d.doc_id, lang, source, n_chars, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id)"


def labelled(t):
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id", "left")


@check("value_counts", "AGG15", "select c_mktsegment, count(*) as n from customer where c_mktsegment is not null group by 1")
def value_counts(spark, d):
    return PR.value_counts(Tables(spark, d).customer, "c_mktsegment")


@check("crosstab", "AGG16", """
select o_orderpriority, count(*) filter (o_orderstatus = 'F') as "F", count(*) filter (o_orderstatus = 'O') as "O",
  count(*) filter (o_orderstatus = 'P') as "P" from orders group by 1""")
def crosstab(spark, d):
    return PR.crosstab(Tables(spark, d).orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@check("crosstab_margins", "AGG17", """
with c as (select case when grouping(o_orderpriority) = 1 then 'All' else o_orderpriority end as o_orderpriority,
  case when grouping(o_orderstatus) = 1 then 'All' else o_orderstatus end as o_orderstatus, count(*) as n
  from orders group by cube (o_orderpriority, o_orderstatus))
select a.o_orderstatus, a.o_orderpriority, a.n, round(a.n / t.n, 6) as share from c a
join c t on t.o_orderpriority = 'All' and t.o_orderstatus = a.o_orderstatus""")
def crosstab_margins(spark, d):
    return rounded(PR.crosstab_share(Tables(spark, d).orders, "o_orderpriority", ["o_orderstatus"]), 6)


@check("crosstab_two_level", "AGG18", """
with k as (select l_linestatus as a, l_returnflag as b, cast(l_linenumber as varchar) as c from lineitem),
g as (select case when grouping(a) = 1 then 'All' else a end as a, case when grouping(b) = 1 then 'All' else b end as b,
  case when grouping(c) = 1 then 'All' else c end as c, count(*) as n from k group by grouping sets ((a, b, c), (b, c), (a), ()))
select x.a as l_linestatus, x.b as l_returnflag, x.c as l_linenumber, x.n, round(x.n * 100.0 / t.n, 4) as share
from g x join g t on t.a = 'All' and t.b = x.b and t.c = x.c""")
def crosstab_two_level(spark, d):
    return rounded(PR.crosstab_share(Tables(spark, d).lineitem, "l_linestatus", ["l_returnflag", "l_linenumber"], 100.0))


COLS = ["source", "n_chars", "quality", "toxic"]


@check("completion", "AGG19", " union all ".join(
    f"select lang, '{c}' as variable, round(nullif(count({c}) * 100.0 / count(*), 0), 4) as percent from {DL} group by 1" for c in COLS))
def completion(spark, d):
    return rounded(PR.completion(labelled(Tables(spark, d)), COLS, "lang"))


def _rare(c):
    return f"case when lang = 'en' then null else {c} end"


@check("completion_requiring", "AGG20", f"""
with c as ({' union all '.join(f"select lang, '{c}' as variable, round(nullif(count({c}) * 100.0 / count(*), 0), 4) as percent from (select lang, source, quality, {_rare('toxic')} as toxic from {DL}) group by 1" for c in ('source', 'quality', 'toxic'))})
select variable, lang, percent from c where variable in (select variable from c where lang = 'en' and percent is not null)""")
def completion_requiring(spark, d):
    df = labelled(Tables(spark, d)).withColumn("toxic", F.when(F.col("lang") != "en", F.col("toxic")))
    return rounded(PR.completion_requiring(df, ["source", "quality", "toxic"], "lang", "en"))


@check("availability", "AGG21", " union all ".join(
    f"select source, '{c}' as variable, cast(count({c}) = 0 as integer) as all_missing from {DL} group by 1" for c in COLS[1:]))
def availability(spark, d):
    return PR.availability(labelled(Tables(spark, d)), COLS[1:], "source")


@check("common_variables", "AGG28", f"""
with a as ({' union all '.join(f"select lang, '{c}' as variable, cast(count({c}) = 0 as integer) as m from (select lang, quality, {_rare('toxic')} as toxic from {DL}) group by 1" for c in ('quality', 'toxic'))})
select variable from a where lang in ('en', 'fr') group by 1 having sum(m) = 0 and count(*) = 2""")
def common_variables(spark, d):
    df = labelled(Tables(spark, d)).withColumn("toxic", F.when(F.col("lang") != "en", F.col("toxic")))
    return PR.common_variables(PR.availability(df, ["quality", "toxic"], "lang"), "lang", ["en", "fr"])


@check("missingness", "AGG22", " union all ".join(
    f"select '{c}' as variable, round(count(*) filter ({c} is null) * 100.0 / count(doc_id), 4) as percent_missing from {DL}" for c in COLS))
def missingness(spark, d):
    return rounded(PR.missingness(labelled(Tables(spark, d)), COLS, "doc_id"))


@check("completion_by_category", "AGG19 SRT2", f"""
with c as ({' union all '.join(f"select lang, '{c}' as variable, round(nullif(count({c}) * 100.0 / count(*), 0), 4) as percent from {DL} group by 1" for c in COLS)})
select lang, variable, percent, case when variable in ('quality', 'toxic') then 'label' else 'text' end as category from c""")
def completion_by_category(spark, d):
    table = PR.completion(labelled(Tables(spark, d)), COLS, "lang")
    category = F.when(F.col("variable").isin("quality", "toxic"), "label").otherwise("text")
    return rounded(PR.order_by_category(table.withColumn("category", category), F.col("category"), "variable"))


@check("table_one", "AGG24", """
with k as (select c_mktsegment, 'c_nationkey' as variable, cast(c_nationkey as varchar) as level from customer
  union all select c_mktsegment, 'debt', cast(case when c_acctbal < 0 then 1 else 0 end as varchar) from customer),
l as (select c_mktsegment, variable, level, count(*) as n from k where level is not null group by 1, 2, 3)
select c_mktsegment, variable, level, n, round(n * 100.0 / sum(n) over (partition by c_mktsegment, variable), 4) as percent,
  cast(null as double) as mean, cast(null as double) as sd from l
union all select c_mktsegment, 'c_acctbal', null, count(c_acctbal), null, round(avg(c_acctbal), 4), round(stddev(c_acctbal), 4)
from customer group by 1""")
def table_one(spark, d):
    cust = Tables(spark, d).customer.withColumn("debt", F.when(F.col("c_acctbal") < 0, 1).otherwise(0))
    return rounded(PR.table_one(cust, "c_mktsegment", ["c_nationkey", "debt"], ["c_acctbal"]))


@check("describe_by", "AGG29", """
select nullif(l_returnflag, 'R') as flag, count(l_extendedprice) as n, round(avg(l_extendedprice), 4) as mean, round(stddev(l_extendedprice), 4) as sd,
  round(quantile_cont(l_extendedprice, 0.05), 4) as p5, round(quantile_cont(l_extendedprice, 0.5), 4) as median,
  round(quantile_cont(l_extendedprice, 0.95), 4) as p95 from lineitem group by 1""")
def describe_by(spark, d):
    line = Tables(spark, d).lineitem.select(F.nullif("l_returnflag", F.lit("R")).alias("flag"), "l_extendedprice")
    return rounded(PR.describe_by(line, "flag", "l_extendedprice"))


DESCRIBED = [c for c in ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax").split()] + ["net", "days", "odd"]
_DESCRIBED = f"""select nullif(l_returnflag, 'R') as flag, {', '.join(DESCRIBED[:8])}, l_extendedprice * (1 - l_discount) as net,
  date_diff('day', date '1995-01-01', l_shipdate::date)::double as days,
  case when l_linenumber = 1 then l_quantity - 25 end as odd from lineitem"""


@check("describe_all", "AGG29", " union all ".join(
    f"""select flag, '{c}' as variable, count({c}) as n, round(avg({c}), 4) as mean, round(stddev({c}), 4) as sd,
  round(quantile_cont({c}::double, 0.05), 6) as p5, round(quantile_cont({c}::double, 0.5), 6) as median, round(quantile_cont({c}::double, 0.95), 6) as p95
  from ({_DESCRIBED}) group by 1""" for c in DESCRIBED))
def describe_all(spark, d):
    line = Tables(spark, d).lineitem.select(
        F.nullif("l_returnflag", F.lit("R")).alias("flag"), *DESCRIBED[:8], (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        F.date_diff("l_shipdate", F.lit("1995-01-01").cast("date")).cast("double").alias("days"),
        F.when(F.col("l_linenumber") == 1, F.col("l_quantity") - 25).alias("odd"))
    # an interpolated quantile of prices may end in a five at the fifth place, so quantiles keep six
    out = PR.describe_all(line, "flag", DESCRIBED)
    return out.select("flag", "variable", "n", *[F.round(c, 4).alias(c) for c in ("mean", "sd")], *[F.round(c, 6).alias(c) for c in ("p5", "median", "p95")])


@check("histogram", "AGG25", """
with b as (select o_orderstatus, cast(least(floor(o_totalprice / 5000), 99) as integer) as bin, count(*) as n from orders
  where o_totalprice between 0 and 500000 group by 1, 2)
select o_orderstatus, bin, cast(bin * 5000 as double) as left_edge, n,
  round(n / (sum(n) over (partition by o_orderstatus) * 5000.0), 10) as density from b""")
def histogram(spark, d):
    out = PR.histogram(Tables(spark, d).orders, "o_totalprice", 0.0, 500000.0, 100, ["o_orderstatus"])
    return out.select("o_orderstatus", "bin", F.round("left_edge", 4).alias("left_edge"), "n", F.round("density", 10).alias("density"))


CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@check("corr_pairs", "AGG26", " union all ".join(
    f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from lineitem" for i, a in enumerate(CORR) for b in CORR[i + 1:]))
def corr_pairs(spark, d):
    return rounded(PR.correlation(Tables(spark, d).lineitem, CORR), 6)


#: Sixty numbers of a line, a fifth of them unknown where the line number says so.
MANY = {f"x{i}": ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey")[i % 6] for i in range(60)}


def _many(name: str, column: str) -> str:
    i = int(name[1:])
    value = f"({column} + {i} * l_quantity + (l_orderkey % {i + 2}) * l_linenumber)"
    return f"case when l_linenumber <> {i // 12} then {value} end as {name}" if i % 5 == 0 else f"{value} as {name}"


_MANY = ", ".join(_many(n, c) for n, c in MANY.items())


@check("corr_many", "AGG26", f"with m as materialized (select {_MANY} from lineitem), c as (select " + ", ".join(
    f"corr(x{i}, x{j}) as r_{i}_{j}" for i in range(60) for j in range(i + 1, 60)) + """ from m)
select 'x' || split_part(name, '_', 2) as a, 'x' || split_part(name, '_', 3) as b, round(r, 5) as r from (unpivot c on * into name name value r)""")
def corr_many(spark, d):
    many = Tables(spark, d).lineitem.selectExpr(*[_many(n, c) for n, c in MANY.items()])
    return rounded(PR.correlation(many, list(MANY)), 5)


@check("perfect_pairs", "AGG26", """
select a, b from (select 'q' as a, 'q2' as b, corr(l_quantity, 2 * l_quantity + 1) as r from lineitem
  union all select 'q', 'l_tax', corr(l_quantity, l_tax) from lineitem
  union all select 'q2', 'l_tax', corr(2 * l_quantity + 1, l_tax) from lineitem) where r >= 1 - 1e-9""")
def perfect_pairs(spark, d):
    line = Tables(spark, d).lineitem.select(F.col("l_quantity").alias("q"), (2 * F.col("l_quantity") + 1).alias("q2"), "l_tax")
    return PR.perfect_pairs(PR.correlation(line, ["q", "q2", "l_tax"]), 1e-9)


# --- modelling ----------------------------------------------------------------------------------
@check("impute_flags", "ML2 ML1", f"""
with t as (select doc_id, n_chars, quality, toxic from {DL} where lang = 'en'),
m as (select avg(quality) as mq, mode(toxic) as mt from t)
select doc_id, round(cast(coalesce(quality, mq) as double), 6) as quality, coalesce(toxic, mt) as toxic,
  cast(quality is null as integer) as quality_missing, cast(toxic is null as integer) as toxic_missing from t, m""")
def impute_flags(spark, d):
    df = labelled(Tables(spark, d)).withColumn("quality", F.col("quality").cast("double"))
    train = M.split(df, "lang", "en", ["doc_id", "quality", "toxic"])
    fills = M.fill_values(train, ["quality"], ["toxic"])
    return rounded(M.impute(train, fills), 6)


@check("prune_flags", "ML3", f"""
with t as (select cast(quality is null as integer) as f1, cast(toxic is null as integer) as f2,
  cast(doc_id is null as integer) as f3, cast(n_chars > 500 as integer) as f4 from {DL}),
c as (select 'f1' as flag, sum(f1) as s, count(*) as n, 1 as pos from t union all select 'f2', sum(f2), count(*), 2 from t
  union all select 'f3', sum(f3), count(*), 3 from t union all select 'f4', sum(f4), count(*), 4 from t)
select flag from c where s = 0 or s = n or exists (select 1 from c x where x.s = c.s and x.pos < c.pos)""")
def prune_flags(spark, d):
    df = labelled(Tables(spark, d))
    flags = df.select(F.col("quality").isNull().cast("int").alias("f1"), F.col("toxic").isNull().cast("int").alias("f2"),
                      F.col("doc_id").isNull().cast("int").alias("f3"), (F.col("n_chars") > 500).cast("int").alias("f4"))
    dropped = M.redundant_flags(flags, ["f1", "f2", "f3", "f4"])
    names = F.explode(F.array(*[F.lit(c) for c in flags.columns]))
    return flags.agg(F.count("*").alias("n")).select(names.alias("flag")).where(F.col("flag").isin(*dropped))


@check("spline_basis", "ML6", """
with b as (select min(l_quantity) as lo, max(l_quantity) as hi from lineitem where l_returnflag = 'R'),
t as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity - lo) / (hi - lo) as t from lineitem, b)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(3 * t * (1 - t) * (1 - t), 6) as l_quantity_s1,
  round(3 * t * t * (1 - t), 6) as l_quantity_s2, round(t * t * t, 6) as l_quantity_s3 from t""")
def spline_basis(spark, d):
    line = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    bounds = M.spline_bounds(line.where("l_returnflag = 'R'"), ["l_quantity"])
    return rounded(M.with_splines(line.drop("l_returnflag"), bounds), 6)


@check("auroc", "ML8", """
with k as (select o_totalprice as s, case when o_orderstatus = 'F' then 1 else 0 end as y from orders),
r as (select y, (rank() over (order by s) + rank() over (order by s) + count(*) over (partition by s) - 1) / 2.0 as rk from k)
select cast(sum(y) as bigint) as n_pos, cast(sum(1 - y) as bigint) as n_neg,
  round((sum(y * rk) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)), 8) as auroc from r""")
def auroc(spark, d):
    orders = Tables(spark, d).orders.withColumn("y", (F.col("o_orderstatus") == "F").cast("int"))
    return rounded(M.auroc(orders, "y", "o_totalprice"), 8)


@check("auroc_ties", "ML8", """
with k as (select l_quantity as s, case when l_returnflag = 'R' then 1 else 0 end as y from lineitem),
c as (select s, sum(y) as p, sum(1 - y) as q from k group by 1),
r as (select p, q, sum(q) over (order by s) - q / 2.0 as below from c)
select cast(sum(p) as bigint) as n_pos, cast(sum(q) as bigint) as n_neg, round(sum(p * below) / (sum(p) * sum(q)), 8) as auroc from r""")
def auroc_ties(spark, d):
    line = Tables(spark, d).lineitem.withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return rounded(M.auroc(line, "y", "l_quantity"), 8)


PRED = "1 / (1 + exp(-(-1.5 + 0.00001 * o_totalprice)))"


@check("calibration", "ML9", f"""
with k as (select {PRED} as p, case when o_orderstatus = 'F' then 1.0 else 0.0 end as y from orders)
select cast(least(floor(p * 10), 9) as integer) as bin, count(*) as n, round(avg(p), 6) as mean_predicted,
  round(avg(y), 6) as fraction_positive from k group by 1""")
def calibration(spark, d):
    orders = Tables(spark, d).orders.select(F.expr(PRED).alias("p"), (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return rounded(M.calibration(orders, "y", "p"), 6)


@check("prediction_histogram", "ML10", f"""
with k as (select {PRED} as p from orders), b as (select cast(least(floor(p / 0.1), 9) as integer) as bin, count(*) as n from k group by 1)
select bin, round(bin * 0.1::double, 4) as left_edge, n, round(n / (sum(n) over () * 0.1), 6) as density from b""")
def prediction_histogram(spark, d):
    orders = Tables(spark, d).orders.select(F.expr(PRED).alias("p"))
    out = PR.histogram(orders, "p", 0.0, 1.0, 10)
    return out.select("bin", F.round("left_edge", 4).alias("left_edge"), "n", F.round("density", 6).alias("density"))


@check("glm_two_by_two", "ML4 ML5 ML11", """
with cells as (
  select l_linestatus = 'O' as a, l_quantity > 25 as b, count(*) as n, count(*) filter (l_returnflag = 'N') as k from lineitem group by all
), logits as (select a, b, ln(k / (n - k)) as z, 1 / k + 1 / (n - k) as v from cells),
signs(term, a, b, s) as (values ('(intercept)', false, false, 1), ('a', true, false, 1), ('a', false, false, -1), ('b', false, true, 1), ('b', false, false, -1),
  ('ab', true, true, 1), ('ab', true, false, -1), ('ab', false, true, -1), ('ab', false, false, 1))
select term, round(sum(s * z), 4) + 0.0 as coefficient, round(sqrt(sum(v)), 4) as std_error, round(exp(sum(s * z)), 4) as odds_ratio
from signs join logits using (a, b) group by term""")
def glm_two_by_two(spark, d):
    """A saturated model: its estimates are differences of the log odds of four cells."""
    a, b = (F.col("l_linestatus") == "O").cast("int"), (F.col("l_quantity") > 25).cast("int")
    line = Tables(spark, d).lineitem.select(
        (F.col("l_returnflag") == "N").cast("int").alias("y"), a.alias("a"), b.alias("b"), (a * b).alias("ab"))
    fitted = M.fit_logit(line, "y", ["a", "b", "ab"])
    rows = [(n, round(x, 4), round(e, 4), round(o, 4)) for n, x, e, o in M.coefficients(fitted, line)]
    return spark.createDataFrame(rows, "term string, coefficient double, std_error double, odds_ratio double")


@check("glm_score_equations", "ML5 ML6 ML7", """
select term, count(*) as n, 0.0::double as residual from orders, (values ('one'), ('s1'), ('s2'), ('s3'), ('late')) t(term) group by term""")
def glm_score_equations(spark, d):
    """At the maximum the residuals sum to zero against every term of the spline design."""
    orders = Tables(spark, d).orders.select(
        (F.col("o_orderstatus") == "F").cast("int").alias("y"), "o_totalprice", (F.year("o_orderdate") > 1997).cast("int").alias("late"))
    train = M.with_splines(orders, M.spline_bounds(orders, ["o_totalprice"]))
    terms = {"one": F.lit(1.0), "late": F.col("late"), **{f"s{k}": F.col(f"o_totalprice_s{k}") for k in (1, 2, 3)}}
    scored = M.score(M.fit_logit(train, "y", ["late", *(f"o_totalprice_s{k}" for k in (1, 2, 3))]), train)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("term"), ((F.col("y") - F.col("p")) * x).alias("r")) for n, x in terms.items()]))
    return scored.select(each.alias("e")).groupBy("e.term").agg(
        F.count("*").alias("n"), (F.round(F.sum("e.r"), 4) + 0.0).alias("residual"))


@check("glm_fit", "ML4 ML5 ML6 ML11")
def glm_fit(spark, d):
    t = Tables(spark, d)
    line = t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), "l_quantity", "l_discount", "l_tax", "l_linestatus")
    bounds = M.spline_bounds(line, ["l_quantity"])
    train = M.with_splines(line, bounds)
    fitted = M.fit_logit(train, "y", ["l_quantity_s1", "l_quantity_s2", "l_quantity_s3", "l_discount", "l_linestatus"])
    rows = [(n, round(b, 6), round(e, 6), round(o, 6)) for n, b, e, o in M.coefficients(fitted, train)]
    return spark.createDataFrame(rows, "term string, coefficient double, std_error double, odds_ratio double")


@check("glm_scores", "ML7")
def glm_scores(spark, d):
    t = Tables(spark, d)
    orders = t.orders.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"),
                             (F.col("o_totalprice") / 1e5).alias("price"), "o_orderpriority")
    fitted = M.fit_logit(orders, "y", ["price", "o_orderpriority"])
    scored = M.score(fitted, orders).select("o_orderkey", "y", "p")
    return rounded(M.calibration(scored, "y", "p"), 6)
