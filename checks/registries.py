"""Concept plans of the offset-time source and the flat registries, diagnosis maps, extracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators import joins as J
from wardline.operators import profile as PR
from wardline.plans import diagnosis, flat, merge, offset, timed
from wardline.plans import offset_rules as R
from wardline.plans import timed_rules as TR
from wardline.registry import header

from . import clinical as C
from . import shapes as H
from .base import Tables, check
from .clinical import ENDS, values
from .columns import MEASURES, _measures
from .shaping import rounded

# --- offset: chemistry and gases -------------------------------------------------------------
NAMES = [n for r in R.LABS for n in r[1]] + ["other"]
RESULT = """case when labname in ('albumin', 'potassium', 'creatinine', 'lactate', 'PT - INR') then l_quantity / 4
  when labname = 'sodium' then 80 + l_quantity * 3 when labname = 'Hct' then l_quantity * 1.7 else l_quantity * 6 - 10 end"""
# many repeats of one stay, test and time, half of them contradictory
RESULT = RESULT.replace("l_quantity", "(l_quantity - l_quantity % (case when l_partkey % 2 = 0 then 25 else 1 end))")
RULES = [(n, r[0], float(r[2]), float(r[3]), r[4]) for r in R.LABS for n in r[1]]
GAS_NAMES = ["paO2", "paCO2", "pH", "FiO2", "other"]
GAS_RESULT = "case labname when 'paO2' then l_quantity * 10 when 'paCO2' then l_quantity * 3 when 'pH' then 6.4 + l_quantity / 20 when 'FiO2' then case when l_linenumber % 2 = 0 then l_quantity * 2 else l_quantity / 50 end else 1 end"
GAS_RULES = [(r[1][0], r[0], float(r[2]), float(r[3]), r[4]) for r in R.GASES]
OFF_FRAMES = {"d1": "labresultoffset between -60 and 1440", "h1": "labresultoffset between -60 and 60"}


def _clean_sql(src, rules):
    """Newest revision whose readings agree and lie in range, per stay, test and time."""
    return f"""rules(labname, stem, lo, hi, closed) as ({values(rules)}),
said as (
  select patientunitstayid, labname, labresultoffset, labresultrevisedoffset, min(labresult) as low, max(labresult) as high from {src} group by all
), clean as (
  select patientunitstayid, labname, stem, labresultoffset, arg_max(low, labresultrevisedoffset) as labresult
  from said join rules using (labname) where low = high and low <= hi and (low > lo or closed and low = lo) group by all)"""


LAB_STEMS = [r[0] for r in R.LABS]


@check("offset_labs_wide", "CON5 JON9 WIN5 AGG13 AGG1 FLT1", f"""
with {H.offset_labs_sql("lab", NAMES, RESULT)}, {_clean_sql("lab", RULES)}
select patientunitstayid, labresultoffset, {', '.join(f"max(labresult) filter (stem = '{s}') as {s}" for s in LAB_STEMS)} from clean group by 1, 2""")
def offset_labs_wide(spark, d):
    return offset.labs_wide(H.offset_labs(Tables(spark, d), NAMES, RESULT))


@check("offset_labs", "CON5 AGG3 FLT4", f"""
with {H.offset_labs_sql("lab", NAMES, RESULT)}, {_clean_sql("lab", RULES)},
w as (select patientunitstayid, labresultoffset, stem, max(labresult) as v from clean group by 1, 2, 3)
select patientunitstayid, {', '.join(f"{e}(v) filter (stem = '{s}' and {c}) as {f}_{s}_{e}" for f, c in OFF_FRAMES.items() for s in LAB_STEMS for e in ENDS)}
from w where {OFF_FRAMES['d1']} group by 1""")
def offset_labs(spark, d):
    return offset.labs(H.offset_labs(Tables(spark, d), NAMES, RESULT))


@check("offset_blood_gas", "CON2 AGG14 MTH5 MTH7", f"""
with {H.offset_labs_sql("lab", GAS_NAMES, GAS_RESULT)}, {_clean_sql("lab", GAS_RULES)},
w as (select patientunitstayid, labresultoffset, max(labresult) filter (stem = 'pao2') as pao2, max(labresult) filter (stem = 'paco2') as paco2,
  max(labresult) filter (stem = 'ph') as ph, max(case when stem = 'fio2' then case when labresult >= 20 then labresult / 100.0 else labresult end end) as fio2 from clean group by 1, 2)
select patientunitstayid, {', '.join(f"round({e}({x}) filter ({c}), 6) as {f}_{s}_{e}" for f, c in OFF_FRAMES.items() for s, x in (("pao2fio2ratio", "pao2 / fio2"), ("pao2", "pao2"), ("paco2", "paco2"), ("ph", "ph")) for e in ENDS)}
from w where {OFF_FRAMES['d1']} group by 1""")
def offset_blood_gas(spark, d):
    return rounded(offset.blood_gas(H.offset_labs(Tables(spark, d), GAS_NAMES, GAS_RESULT)), 6)


# --- offset: vitals ------------------------------------------------------------------------------
PERIODIC = {"heartrate": "l_quantity * 9", "respiration": "l_quantity * 7 - 20", "sao2": "l_quantity * 2.3", "temperature": "l_quantity * 2.6",
            "systemicsystolic": "l_quantity * 7 - 3", "systemicdiastolic": "l_quantity * 5 - 3", "systemicmean": "l_quantity * 8 - 3"}
APERIODIC = {"noninvasivesystolic": "l_quantity * 7 - 10", "noninvasivediastolic": "l_quantity * 5 - 10", "noninvasivemean": "l_quantity * 8 - 10"}
VIT_FRAMES = {"d1": "o between -60 and 1440", "h1": "o between -60 and 60"}
TEMP_SQL = "case when temperature > 77 and temperature < 114.8 then (temperature - 32) / 1.8 when temperature > 25 and temperature < 46 then temperature end"


def _mon_sql(name, cols, rules, temp=False):
    src = ", ".join(f"{e} as {c}" for c, e in cols.items())
    exprs = [(s, f"case when {c} between {lo} and {hi} then {c} end") for s, c, lo, hi in rules] + ([("temp", TEMP_SQL)] if temp else [])
    aggs = ", ".join(f"round({e}({x}) filter ({cond}), 6) as {f}_{s}_{e}" for f, cond in VIT_FRAMES.items() for s, x in exprs for e in ENDS)
    return f"{name} as (select s, {aggs} from (select l_suppkey as s, {H.OFFSET} as o, {src} from lineitem) where {VIT_FRAMES['d1']} group by 1)"


@check("offset_vitals", "CON3 AGG4 MTH2 FLT4 JON2", f"""
with {_mon_sql("p", PERIODIC, R.PERIODIC, True)}, {_mon_sql("a", APERIODIC, R.APERIODIC)}
select s_suppkey as patientunitstayid, p.* exclude (s), a.* exclude (s) from supplier left join p on p.s = s_suppkey left join a on a.s = s_suppkey""")
def offset_vitals(spark, d):
    t = Tables(spark, d)

    def table(cols):
        return t.lineitem.selectExpr("l_suppkey as patientunitstayid", f"{H.OFFSET} as observationoffset", *[f"{e} as {c}" for c, e in cols.items()])
    return rounded(offset.vitals(t.supplier.selectExpr("s_suppkey as patientunitstayid"), table(PERIODIC), table(APERIODIC)), 6)


PAIRS = [p for r in R.CHARTED for p in r[1]] + [("Pain", "Score")]
CHART_TEXT = "case l_linenumber when 1 then '-' when 2 then '.' when 3 then cast(l_orderkey % 120 as varchar) || '.' when 4 then '-' || cast(l_orderkey % 9 as varchar) when 5 then 'abc' else cast(l_quantity * 4 as varchar) end"
CHARTED_RULES = [(a, b, r[0], float(r[2]), float(r[3]), r[4]) for r in R.CHARTED for a, b in r[1]]
NC_FRAMES = {"d1": "o > -60 and o < 1440", "h1": "o > -60 and o < 60"}
CHART_STEMS = [r[0] for r in R.CHARTED]


@check("offset_vitals_charted", "CON4 FLT5 FLT6 AGG4 PRJ9", f"""
with crules(a, b, stem, lo, hi, closed) as ({values(CHARTED_RULES)}), pairs(i, a, b) as ({values([(i, a, b) for i, (a, b) in enumerate(PAIRS)])}),
nc as (select l_suppkey as s, {H.OFFSET} as o, a, b, {CHART_TEXT} as txt from lineitem join pairs on i = {H.PICK} % {len(PAIRS)} where l_orderkey % 10 <> 0),
n as (select s, o, stem, case when regexp_matches(txt, '^-?[0-9]+\\.?[0-9]*$') then cast(txt as double) end as v, lo, hi, closed
  from nc left join crules using (a, b) where {NC_FRAMES['d1']}),
w as (select s, {', '.join(f"{e}(v) filter (stem = '{x}' and {c} and ((closed and v between lo and hi) or (v > lo and v < hi))) as {f}_{x}_{e}" for f, c in NC_FRAMES.items() for x in CHART_STEMS for e in ENDS)} from n group by 1)
select s as patientunitstayid, * exclude (s), {', '.join(f"coalesce({f}_mbp_invasive_{e}, {f}_mbp_noninvasive_{e}) as {f}_mbp_{e}" for f in NC_FRAMES for e in ENDS)} from w""")
def offset_vitals_charted(spark, d):
    t = Tables(spark, d)
    listed = ", ".join(f"struct('{a}' as a, '{b}' as b)" for a, b in PAIRS)
    nc = t.lineitem.selectExpr("*", f"array({listed})[cast({H.PICK} % {len(PAIRS)} as int)] as pr").selectExpr(
        "l_suppkey as patientunitstayid", f"{H.OFFSET} as nursingchartoffset", "pr.a as nursingchartcelltypevallabel", "pr.b as nursingchartcelltypevalname",
        "case when l_orderkey % 10 = 0 then 'Intake' else 'Vital Signs' end as nursingchartcelltypecat",
        CHART_TEXT.replace("varchar", "string") + " as nursingchartvalue")
    return offset.vitals_charted(nc)


# --- offset: cohort --------------------------------------------------------------------------------
PATIENT = {
    "patientunitstayid": "s_suppkey", "uniquepid": "cast(s_suppkey - s_suppkey % 3 as varchar)", "patienthealthsystemstayid": "s_suppkey % 7",
    "hospitalid": "s_suppkey % 11", "hospitaldischargeyear": "2014 + s_suppkey % 2", "hospitaldischargeoffset": "s_suppkey * 37 % 900",
    "unitdischargeoffset": "s_suppkey * 53 % 1500", "unitstaytype": "case when s_suppkey % 6 = 0 then 'stepdown/other' else 'admit' end",
    "age": "case s_suppkey % 8 when 0 then '> 89' when 1 then '' else cast(s_suppkey % 60 as varchar) end",
    "hospitaldischargestatus": "case when s_suppkey % 9 = 0 then '' when s_suppkey % 9 <> 1 then 'Alive' end",
    "unitdischargestatus": "case when s_suppkey % 10 = 0 then 'Gone' when s_suppkey % 10 < 4 then 'Expired' else 'Alive' end",
}


def _patients(t):
    return t.supplier.selectExpr(*[f"{e.replace('varchar', 'string')} as {n}" for n, e in PATIENT.items()])


@check("offset_cohort", "COH2 JON16 WIN4 WIN10 JON8", f"""
with pt as (select {', '.join(f"{e} as {n}" for n, e in PATIENT.items())} from supplier),
facts as (
  select *, age = '' or coalesce(try_cast(ltrim(age, '> ') as double), 0) >= 16 as adult,
    coalesce(hospitaldischargestatus, '') <> '' and coalesce(unitdischargestatus in ('Expired', 'Alive'), true) as known,
    coalesce(hospitaldischargestatus, '') <> '' and coalesce(unitdischargestatus in ('Expired', 'Alive'), false) as settled,
    patientunitstayid % 4 > 0 as predicted, patientunitstayid % 4 > 0 and patientunitstayid % 2 = 1 as again,
    patientunitstayid % 100 > 1 and patientunitstayid % 5 = 0 as refused
  from pt
), earliest as (
  select first(patientunitstayid order by hospitaldischargeyear, hospitaldischargeoffset desc, patienthealthsystemstayid, patientunitstayid) as patientunitstayid
  from pt where unitdischargeoffset >= 240 and unitstaytype <> 'stepdown/other' group by uniquepid
), equipped as (
  select hospitalid, hospitaldischargeyear from pt join lineitem on l_suppkey = patientunitstayid group by all
  having bool_or(l_suppkey % 5 <> 0 and l_suppkey % 11 <> 3) and bool_or(l_suppkey % 11 <> 4)
), judged as (
  select *, patientunitstayid in (select patientunitstayid from earliest) as is_first,
    (hospitalid, hospitaldischargeyear) in (select (hospitalid, hospitaldischargeyear) from equipped) as has_data
  from facts)
select patientunitstayid, if(predicted, patientunitstayid % 2, null) as readmission_apache, if(predicted, 0, null)::integer as readmission_status,
  refused::integer as readmission_apache_pred, (refused or again)::integer as readmission_apache_combined,
  (not adult)::integer as exclusion_non_adult, (not known)::integer as exclusion_missingoutcome,
  (not is_first)::integer as exclusion_short_or_secondary_stay, (not has_data)::integer as exclusion_missing_data,
  (not (adult and settled and is_first and has_data))::integer as excluded
from judged""")
def offset_cohort(spark, d):
    t = Tables(spark, d)
    lab = t.lineitem.where("l_suppkey % 11 <> 4").selectExpr("l_suppkey as patientunitstayid", "l_linenumber as labresultoffset")
    vital = t.lineitem.where("l_suppkey % 5 <> 0 and l_suppkey % 11 <> 3").selectExpr("l_suppkey as patientunitstayid", "l_linenumber as observationoffset")
    results = t.supplier.selectExpr("s_suppkey as patientunitstayid", "'IVa' as apacheversion", "s_suppkey % 100 as apachescore",
                                    "case when s_suppkey % 5 = 0 then '-1' else '0.3' end as predictedhospitalmortality")
    pred = t.supplier.where("s_suppkey % 4 > 0").selectExpr("s_suppkey as patientunitstayid", "s_suppkey % 2 as readmit")
    return offset.cohort(_patients(t), lab, vital, results, pred).drop("readmission_by_type")


# --- flat registries ---------------------------------------------------------------------------------
CODED = {
    "patientid": "o_custkey", "site_id": "o_custkey % 5", "icu_ad_dtm": "o_orderdate", "age": "case when o_orderkey % 13 <> 0 then cast(o_orderkey % 90 as double) end",
    "hosp_outcm": "o_orderkey % 11 - 1", "readmitted": "o_orderkey % 4", "apache3riskofdeath": "o_totalprice / 1000000.0 - 0.02",
    "hrlo": "case when o_orderkey % 17 <> 0 then 40.0 + o_orderkey % 30 end", "hrhi": "80.0 + o_orderkey % 70", "caretype": "o_orderkey % 3",
    "weight": "50.0 + o_orderkey % 60", "height": "140.0 + o_orderkey % 60", "indigenous": "o_orderkey % 4 - 1", "smokingstatus": "o_orderkey % 6",
    "hosp_srce": "o_orderkey % 5", "icu_srce": "o_orderkey % 7", "icu_outcm": "o_orderkey % 7", "died_hosp": "o_orderkey % 3", "elect": "o_orderkey % 3",
    "hosp_hrs": "cast(o_orderkey % 900 as double)", "creatlo": "cast(o_orderkey % 200 as double)", "hctlo": "(o_orderkey % 60) / 100.0",
    "immundis": "o_orderkey % 3", "ap3diag": "cast(100 + o_orderkey % 20 as varchar)", "ap3_subcode": "case when o_orderkey % 2 = 0 then cast(100 + o_orderkey % 20 as varchar) || '.01' end",
    "cicmlevel": "case when o_orderkey % 3 = 0 then '3/PICU' else '2' end",
    **{c: "o_orderkey % 5" for c in flat.SUB_SCORES},
}


def coded_registry(t):
    base = t.orders.selectExpr(*[f"{e.replace('varchar', 'string')} as {n}" for n, e in CODED.items()],
                               "o_orderdate + make_dt_interval(6500, 0, 0, 0) as hosp_ds_dtm")
    text = {"country", "hospitalclassification", "sex", "ap2diag"}
    wanted = [s for s, _ in flat.CODED_SCORE_INPUTS.values()] + list(flat.CODED_FLAGS.values()) + list(flat.CODED_COPIES.values())
    wanted += [f"{s}{e}" for s, _ in flat.CODED_PAIRS.values() for e in ("lo", "hi")] + ["pre_icu_hrs", "icu_hrs", "immunrx", "immunsup"]
    out = H.null_columns(base, [c for c in dict.fromkeys(wanted) if c not in text])
    return H.null_columns(out, sorted(text), "string")


def text_map(t):
    return t.part.selectExpr("cast(100 + p_partkey % 25 as string) || '.' || cast(p_partkey % 3 as string) as code",
                             "case when p_partkey % 2 = 0 then 1 else 0 end as `post-operative`").where("p_partkey % 50 < 25").distinct()


CODED_SQL = f"""reg as (select {', '.join(f"{e} as {n}" for n, e in CODED.items())}, o_orderdate + to_days(6500) as hosp_ds_dtm from orders),
fl as (select *, cast(not coalesce(age >= 16, false) as integer) as exclusion_age, cast(coalesce(hosp_outcm < 0 or hosp_outcm > 8, false) as integer) as exclusion_outcome,
  cast(coalesce(readmitted = 1, false) as integer) as exclusion_readmission, cast(not coalesce(apache3riskofdeath > 0, false) as integer) as exclusion_noprediction,
  cast(hrlo is null or hrhi is null as integer) as exclusion_nodata from reg where year(hosp_ds_dtm) between 2014 and 2015),
kept as (select *, row_number() over (partition by patientid, site_id
    order by icu_ad_dtm, {', '.join(f'{c} nulls first' for c in sorted(CODED))}) as rn from fl
  where exclusion_age + exclusion_outcome + exclusion_readmission + exclusion_noprediction + exclusion_nodata = 0)"""
EXCL = ["exclusion_age", "exclusion_outcome", "exclusion_readmission", "exclusion_noprediction", "exclusion_nodata"]


@check("coded_cohort", "COH3 FLT7 FLT8 AGG23", f"""
with {CODED_SQL}, x as (select *, greatest({', '.join(EXCL)}) as e from fl)
select 'initial' as step, count(*) as n, 100.0::double as percent from x union all select 'final', count(*) filter (e = 0), round(100.0 * count(*) filter (e = 0) / count(*), 4) from x
""" + " ".join(f"union all select '{f}', cast(sum({f}) as bigint), round(100.0 * sum({f}) / count(*), 4) from x" for f in EXCL))
def coded_cohort(spark, d):
    from wardline.operators.cohort import attrition
    return rounded(attrition(flat.coded_cohort(coded_registry(Tables(spark, d))), EXCL))


SEG = {"icu_stay_type": "case caretype when 1 then 'ICU' when 2 then 'HDU' end",
       "ethnicity": "case indigenous when 1 then 'Indigenous' when 0 then 'Australian' when -1 then 'Unknown' end",
       "smoking_status": "case smokingstatus when 1 then 'Current Smoker' when 2 then 'Ex-Smoker' when 3 then 'Never Smoked' when 4 then 'Unknown' end",
       "hospital_death": "case died_hosp when 1 then 1 when 2 then 0 end", "elective_surgery": "case elect when 1 then 1 when 2 then 0 end",
       "bmi": "round(weight / (height / 100 * height / 100), 6)", "hospital_los_days": "round(hosp_hrs / 24.0, 6)",
       "d1_creatinine_min": "round(creatlo / 88.42, 6)", "d1_hematocrit_min": "round(hctlo * 100.0, 6)", "d1_heartrate_min": "cast(hrlo as double)",
       "immunosuppression": "cast(immundis = 2 as integer)", "apache_3j_diagnosis": "coalesce(ap3_subcode, ap3diag)",
       "apsiii": "cast(" + " + ".join(flat.SUB_SCORES) + " as double)", "teaching_hospital": "cast(cast(cicmlevel = '3/PICU' as integer) as varchar)",
       "icu_admit_source": "case icu_srce when 1 then 'Operating Room / Recovery' when 2 then 'Accident & Emergency' when 3 then 'Floor' when 4 then 'Other ICU' when 5 then 'Other Hospital' when 6 then 'Other ICU' end"}


@check("coded_extract", "SCH6 SCH7 PRJ6 MTH1 MTH3 MTH11 LOG1 JON13 WIN11 DAT7", f"""
with {CODED_SQL},
posts as (select distinct cast(100 + p_partkey % 25 as varchar) as code, (p_partkey % 2 = 0)::integer as po from part where p_partkey % 50 < 25)
select concat(site_id, '_', patientid) as encounter_id, po as apache_post_operative, {', '.join(f"{e} as {n}" for n, e in SEG.items())}
from kept left join posts on code = ap3diag where rn = 1""")
def coded_extract(spark, d):
    t = Tables(spark, d)
    out = flat.coded_extract(coded_registry(t), text_map(t), "registry")
    return rounded(out.select("encounter_id", "apache_post_operative", *SEG), 6)


@check("coded_fields", "SCH7 PRJ6 MTH1 MTH3 MTH11 LOG1 DAT7", f"""
with {CODED_SQL} select {', '.join(f"{e} as {n}" for n, e in SEG.items())}, count(*) as n from reg group by all""")
def coded_fields(spark, d):
    from wardline.operators.conform import apply_field_map
    from wardline.registry import header_schema
    reg = coded_registry(Tables(spark, d)).withColumn("post-operative", F.lit(None).cast("int"))
    out = rounded(apply_field_map(reg, flat.coded_fields("registry"), header_schema(list(SEG))), 6)
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))


@check("text_registry", "PRJ13 STR4 STR5 STR6 STR8 STR10 JON12 SCH7", f"""
with m as (select p.*, case when h like '%NA%' then trim(replace(h, 'NA', '')) else w end as w2, case when h like '%NA%' then 'na' else h end as h2, x.p_size, x.p_retailprice, x.p_type
  from {MEASURES} p join part x using (p_partkey) where x.p_size % 10 > 0 and x.p_retailprice > 905 and p_partkey % 19 > 0),
dx(code, op, id) as (values ('1', 'Non-operative', 11), ('2', 'Post-operative', 21), ('2', 'Non-operative', 22), ('3', 'Post-operative', 0))
select 'r_' || p_partkey as encounter_id, case p_partkey % 5 when 1 then 'Bangladesh' when 2 then 'Nepal' when 3 then 'India' when 4 then 'Sri Lanka' end as country,
  try_cast(trim(replace(w2, 'kg', '')) as double) as weight,
  round(case when lower(h2) like '%inch%' then try_cast(trim(replace(lower(h2), 'inch', '')) as double) * 2.54
    when lower(h2) like '%cm%' then try_cast(trim(replace(lower(h2), 'cm', '')) as double) else try_cast(trim(replace(lower(h2), 'na', '')) as double) end, 4) as height,
  cast(p_type like '%L%' as integer) as apache_post_operative, nullif(cast(dx.id as varchar), '0') as apache_2_diagnosis
from m left join dx on dx.code = cast(p_size % 5 as varchar) and (dx.code <> '2' or dx.op = case when p_type like '%L%' then 'Post-operative' else 'Non-operative' end)""")
def text_registry(spark, d):
    t = Tables(spark, d)
    part = t.part
    sheet = _measures(part).join(part, "p_partkey").selectExpr(
        "p_partkey as id", "w as weight", "h as height", "a as age", "'Male' as sex", "case when p_type like '%L%' then 'surgical ward' else p_type end as admission_type",
        "case when p_size % 10 > 0 then 0 end as mortality", "cast(p_retailprice - 905 as string) as a_score",
        "case when p_partkey % 19 > 0 then 60.0 end as heart_rate_lowest", "80.0 as heart_rate_highest", "cast(p_size % 5 as string) as apachecode")
    pairs = [f"{s}_{e}" for s in [*flat.TEXT_PAIRS.values(), *flat.TEXT_PERCENT_PAIRS.values()] for e in ("lowest", "highest")]
    older = part.selectExpr("p_partkey as id", "p_partkey % 5 as site")
    codes = spark.sql("""select * from values ('1', 'a', 11, 'x', 'Non-operative'), ('2', 'b', 21, 'y', 'Post-operative'), ('2', 'b', 22, 'y', 'Non-operative'),
      ('3', 'c', 0, 'z', 'Post-operative') as m(code, name, target_id, target_name, target_operative)""")
    out = flat.text_extract(H.null_columns(sheet, pairs), older, codes, "r")
    return rounded(out.select("encounter_id", "country", "weight", "height", "apache_post_operative", "apache_2_diagnosis"))


# --- diagnosis ----------------------------------------------------------------------------------------
THREE = """select distinct cast(100 + p_size as string) as apache_3j_diagnosis, case when p_size % 2 = 0 then 'Post-operative' else 'Non-operative' end as apache_3j_operative,
  'sys' || cast(p_size % 7 as string) as apache_3j_bodysystem, cast(300 + p_size % 20 as string) as apache_2_diagnosis from part where p_size < 45"""
TWO = """select distinct cast(300 + p_size % 20 as string) as apache_2_diagnosis, case when p_size % 2 = 0 then 'Post-operative' else 'Non-operative' end as apache_2_operative,
  'two' || cast(p_size % 20 as string) as apache_2_bodysystem from part where p_size % 20 > 4"""
DX = "select distinct p_name as admitdiagnosis, cast(100 + length(p_name) * 3 as string) || '.0' || cast(length(p_name) % 4 as string) as code from part where length(p_name) % 5 > 0"


@check("diagnosis_enrichment", "CON9 STR7 JON10 JON11 PRJ11", f"""
with three as ({THREE}), two as ({TWO}), dx as ({DX})
select p_partkey, code as apache_3j_diagnosis, three.apache_2_diagnosis, cast(coalesce(three.apache_3j_operative = 'Post-operative', false) as integer) as apache_post_operative,
  apache_3j_bodysystem, apache_2_bodysystem from part left join dx on admitdiagnosis = p_name left join three on three.apache_3j_diagnosis = split_part(code, '.', 1)
left join two on two.apache_2_diagnosis = three.apache_2_diagnosis
  and cast(apache_2_operative = 'Post-operative' as integer) = cast(coalesce(three.apache_3j_operative = 'Post-operative', false) as integer)""".replace(" as string)", " as varchar)"))
def diagnosis_enrichment(spark, d):
    t = Tables(spark, d)
    t.part.createOrReplaceTempView("part")
    three, two, dx = (spark.sql(q) for q in (THREE, TWO, DX))
    coded = diagnosis.enrich(t.part.selectExpr("p_partkey", "p_name as admitdiagnosis"), dx, three)
    return diagnosis.body_systems(coded, three, two).drop("admitdiagnosis")


# --- whole pipeline --------------------------------------------------------------------------------------
def timed_extract_frame(spark, d):
    """Every concept of the absolute-time source assembled into the common header."""
    t = Tables(spark, d)
    stays = H.stays(t)
    full = stays.selectExpr("*", "'src' as dbsource", "'MICU' as first_careunit", "icustay_id % 9 as first_wardid",
                            "cast(icustay_id % 30 as double) as los")
    heart = H.observations(t, ["icustay_id"], C.HR_ITEMS, C.HR_VALUE, C.HR_TEXT)
    co = timed.cohort(stays, C.patient_rows(t), C.admission_rows(t), C.service_rows(t), heart).where("excluded = 0")
    # the extract holds included stays only, so events of the others are left out before they are shuffled
    sieve = J.Sieve(co, ["icustay_id", "hadm_id", "subject_id"])
    inside = sieve.rows(stays, "icustay_id")

    def near(events, key="icustay_id"):
        return sieve.rows(events, key)

    vit = timed.vitals(stays, near(C.vital_rows(t)))
    lab = timed.labs(inside, near(C.lab_rows(t), "hadm_id"))
    gas = timed.blood_gas_summary(stays, timed.blood_gas(inside, C.gas_lab_rows(t), near(C.gas_chart_rows(t)), True, few_stays=True))
    coma = timed.coma_scale(stays, near(H.observations(t, ["icustay_id"], C.COMA_ITEMS, C.COMA_VALUE, C.COMA_TEXT)))
    urine_rows = H.observations(t, C.STAY, C.URINE_ITEMS, "l_quantity * 9").drop("value").withColumnRenamed("valuenum", "value")
    urine = timed.urine_output(stays, near(urine_rows))
    codes = t.part.selectExpr("p_partkey - p_partkey % 2 as hadm_id", "case when p_size = 7 then '5855' else '4019' end as icd9_code")
    vent = t.part.where("p_size % 2 = 0").selectExpr("p_partkey as icustay_id", f"{H.spark_time(H.admit('p_partkey') + ' + 3')} as starttime",
                                                     f"{H.spark_time(H.admit('p_partkey') + ' + 9')} as endtime")
    aps = timed.apsiii(stays, vit, lab, gas, coma, urine, codes, vent)
    # a stay's number among those of its admission counts the stays left out too
    demo = timed.demographics(stays, near(H.observations(t, ["icustay_id"], C.DEMO_ITEMS, C.DEMO_VALUE)), near(C.note_rows(t), "subject_id"), C.service_rows(t))
    return timed.extract(full, C.patient_rows(t), C.admission_rows(t), co, demo, vit, lab, gas, aps)


CHOSEN = ["encounter_id", "patient_id", "age", "gender", "ethnicity", "hospital_admit_source", "hospital_disch_location", "hospital_los_days",
          "pre_icu_los_days", "icu_death", "elective_surgery", "d1_heartrate_max", "h1_heartrate_min", "country"]


@check("timed_extract", "CON8 JON2 JON7 PRJ5 SCH6 DAT2 DAT3", f"""
with {C.COHORT_CTE}, {H.observations_sql("chart", ["icustay_id"], C.VITAL_ITEMS, C.VITAL_VALUE)},
hrv as (select s.icustay_id, max(valuenum) as hi, min(valuenum) filter (charttime <= intime + interval 1 hour) as lo1 from stays s
  join chart c on s.icustay_id = c.icustay_id and charttime between intime - interval 2 hour and intime + interval 1 day and c.error is distinct from 1
  where itemid in (211, 220045) and valuenum > 0 and valuenum < 300 group by 1),
adm2 as (select adm.*, p.p_size, {H.duck_time(H.admit('p_partkey') + ' + 100 + p_partkey % 300')} as dischtime,
  case when p_partkey % 8 = 0 then {H.duck_time(H.admit('p_partkey') + ' + 40')} end as deathtime from adm join part p on p_partkey = hadm_id)
select cast(c.icustay_id as varchar) as encounter_id, cast(c.subject_id as varchar) as patient_id,
  round(date_diff('day', cast(p.dob as date), cast(s.intime as date)) / 365.242, 4) as age, c.gender,
  case when p_size % 6 = 0 then 'Caucasian' when p_size % 6 = 1 then 'Hispanic' when p_size % 6 = 2 then 'Asian' else 'Other/Unknown' end as ethnicity,
  case when p_size % 4 = 0 then 'Direct Admit' when p_size % 4 = 1 then 'Emergency Department' end as hospital_admit_source,
  case when p_size % 5 = 0 then 'Skilled Nursing Facility' when p_size % 5 = 1 then 'Home' when p_size % 5 = 2 then 'Death' end as hospital_disch_location,
  cast(date_diff('day', cast(a.admittime as date), cast(dischtime as date)) as double) as hospital_los_days,
  round(date_diff('microsecond', a.admittime, s.intime) / 8.64e10, 4) as pre_icu_los_days, cast(coalesce(deathtime <= s.outtime, false) as integer) as icu_death,
  cast(p_size % 3 = 0 as integer) as elective_surgery, hi as d1_heartrate_max, lo1 as h1_heartrate_min, 'USA' as country
from cohort c join stays s on s.icustay_id = c.icustay_id join adm2 a on a.hadm_id = c.hadm_id join patients p on p.subject_id = c.subject_id
left join hrv on hrv.icustay_id = c.icustay_id where excluded = 0""")
def timed_extract(spark, d):
    return timed_extract_frame(spark, d).select(*CHOSEN)


@check("merged_completion", "CON10 AGG19 AGG20 SET1 PRJ12 SRT2")
def merged_completion(spark, d):
    """Two sources stacked under the header, with body systems, profiled for completeness."""
    t = Tables(spark, d)
    t.part.createOrReplaceTempView("part")
    three, two = spark.sql(THREE), spark.sql(TWO)
    coded = flat.coded_extract(coded_registry(t), text_map(t), "carevue")
    second = flat.coded_extract(coded_registry(t).where("age > 40"), text_map(t), "other")
    whole = merge.top_code_age(merge.merge([coded, second], three, two, {"pooled": ["carevue", "metavision", "both"]}), "pooled")
    return rounded(merge.completion_table(whole).where(F.col("percent").isNotNull()))
