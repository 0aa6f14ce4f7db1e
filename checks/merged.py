"""Plans over the merged table: availability, Table 1, glucose, mortality."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.plans import merge, mortality

from .base import Tables, check
from .shaping import rounded

SOURCES = ["north", "south", "east"]
# a merged table: what each harmonised column is made of
ROW = {
    "data_source": "case o_custkey % 3 when 0 then 'north' when 1 then 'south' else 'east' end",
    "elective_surgery": "case when o_orderkey % 7 > 0 then cast(o_orderpriority = '1-URGENT' as int) end",
    "gender": "case when o_orderkey % 2 = 0 then 'F' when o_custkey % 3 = 1 then 'M' end",
    "hospital_death": "case when o_orderkey % 11 > 0 then cast(o_orderstatus = 'F' as int) end",
    "icu_death": "cast(o_orderstatus = 'P' as int)", "pregnant": "cast(null as int)", "readmission_status": "cast(o_orderkey % 5 = 0 as int)",
    "smoking_status": "case when o_custkey % 3 < 2 then substr(o_orderpriority, 1, 1) end", "teaching_hospital": "cast(1 as int)",
    "age": "cast(o_orderkey % 90 as double)", "height": "case when o_orderkey % 3 > 0 then 150.0 + o_orderkey % 40 end",
    "hospital_los_days": "o_totalprice / 10000", "icu_los_days": "o_totalprice / 40000", "pre_icu_los_days": "cast(null as double)",
    "weight": "40.0 + o_custkey % 80", "glucose_apache": "o_totalprice / 200",
}
SQL = f"merged as (select {', '.join(f'{e} as {n}' for n, e in ROW.items())} from orders)"
NAMES = [n for n in ROW if n != "data_source"]


def merged(spark, d):
    return Tables(spark, d).orders.selectExpr(*[f"{e} as {n}" for n, e in ROW.items()])


@check("availability_report", "AGG21 SRT2", f"""
with {SQL} select data_source, variable, missing as all_missing, case when variable = 'glucose_apache' then 'APACHE covariate' else 'demographic' end as category
from (select data_source, {', '.join(f"(count({n}) = 0)::integer as {n}" for n in NAMES)} from merged group by data_source)
unpivot (missing for variable in ({', '.join(NAMES)}))""")
def availability_report(spark, d):
    return merge.availability_table(merged(spark, d)).drop("unitofmeasure")


def _levels():
    for n in merge.TABLE_ONE_LEVELS:
        yield (f"select data_source, '{n}' as variable, {n}::varchar as level, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (partition by data_source), 4) as percent, "
               f"null::double as mean, null::double as sd from merged where {n} is not null group by data_source, {n}")
    for n in merge.TABLE_ONE_NUMBERS:
        yield (f"select data_source, '{n}', null, count({n}), null, round(avg({n}), 4), round(stddev({n}), 4) from merged group by data_source")


@check("merged_table_one", "AGG24", f"with {SQL} " + " union all ".join(_levels()))
def merged_table_one(spark, d):
    return rounded(merge.demographics_table(merged(spark, d)))


@check("glucose_histogram", "AGG25", f"""
with {SQL}, binned as (select data_source, least(floor(glucose_apache / 20), 99)::integer as bin from merged where glucose_apache between 0 and 2000)
select data_source, bin, bin * 20.0::double as left_edge, count(*) as n, round(count(*) / (sum(count(*)) over (partition by data_source) * 20), 8) as density
from binned group by data_source, bin""")
def glucose_histogram(spark, d):
    return rounded(merge.glucose_histogram(merged(spark, d)), 8)


# with one yes-no covariate and its missing flag the model is saturated: a risk is the share of its training cell
RISKS = f"""
{SQL}, known as (select * from merged where hospital_death is not null),
common as (select first(elective_surgery order by n desc, elective_surgery) as fill from (
  select elective_surgery, count(*) as n from known where data_source = 'north' and elective_surgery is not null group by 1)),
cells as (select data_source, hospital_death as y, coalesce(elective_surgery, fill) as x, elective_surgery is null as gap from known, common),
risk as (select x, gap, round(avg(y), 5) as p from cells where data_source = 'north' group by all),
scored as (select data_source, y, p from cells join risk using (x, gap))"""


def _judged(spark, d):
    df = mortality.prepared(merged(spark, d))
    model = mortality.fit(df.where("data_source = 'north'"), ["elective_surgery"])
    return mortality.judged(df, model, SOURCES)


@check("mortality_auroc", "ML2 ML3 ML4 ML5 ML7 ML8", f"""
with {RISKS}, per as (select data_source, p, sum(y) as pos, sum(1 - y) as neg from scored group by 1, 2),
ranked as (select *, sum(neg) over (partition by data_source order by p) - neg / 2 as below from per)
select data_source, sum(pos)::bigint as n_pos, sum(neg)::bigint as n_neg, round(sum(pos * below) / (sum(pos) * sum(neg)), 6) as auroc from ranked group by 1""")
def mortality_auroc(spark, d):
    return rounded(_judged(spark, d)[0], 6)


@check("mortality_calibration", "ML7 ML9", f"""
with {RISKS} select data_source, least(floor(p * 10), 9)::integer as bin, count(*) as n, round(avg(p), 4) as mean_predicted,
  round(avg(y), 6) as fraction_positive from scored group by 1, 2""")
def mortality_calibration(spark, d):
    curve = _judged(spark, d)[1]
    return curve.select("data_source", "bin", "n", F.round("mean_predicted", 4).alias("mean_predicted"),
                        F.round("fraction_positive", 6).alias("fraction_positive"))
