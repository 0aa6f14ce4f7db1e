"""Concept plans of the absolute-time source over clinical-shaped data."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.plans import timed
from wardline.plans import timed_rules as R

from . import shapes as H
from .base import Tables, check
from .shaping import rounded

ENDS = ("min", "max")
FRAME_SQL = {"d1": "charttime <= intime + interval 1 day", "h1": "charttime <= intime + interval 1 hour"}


def values(rows: list[tuple]) -> str:
    def lit(v):
        return "null" if v is None else f"'{v}'" if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v)
    return "values " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


# --- vitals ---------------------------------------------------------------------------------
VITAL_ITEMS = [i for r in R.VITALS for i in r[1]][::2] + [223761, 999]
VITAL_VALUE = "l_quantity * 4.3 - 5"
VITAL_RULES = [(r[0], i, float(r[2]), float(r[3] if r[3] is not None else 1e9), r[5]) for r in R.VITALS for i in r[1]]
WATCHED = [i for r in R.VITALS for i in r[1]]


def vital_rows(t):
    return H.observations(t, ["icustay_id"], VITAL_ITEMS, VITAL_VALUE)


def _vital_cols():
    out = []
    for frame, cond in FRAME_SQL.items():
        for stem, labels in R.VITAL_COLUMNS.items():
            inside = ", ".join(f"'{x}'" for x in labels)
            for stat, fn in (("min", "min"), ("max", "max"), ("mean", "avg")):
                out.append(f"round({fn}(v) filter (label in ({inside}) and {cond}), 8) as {frame}_{stem}_{stat}")
    return ", ".join(out)


VITALS_SQL = f"""
with {H.STAYS}, {H.observations_sql("chart", ["icustay_id"], VITAL_ITEMS, VITAL_VALUE)},
rules(label, item, lo, hi, closed) as ({values(VITAL_RULES)}),
seen as (select s.subject_id, s.hadm_id, s.icustay_id, intime, charttime, label,
    case when itemid in (223761, 678) then (valuenum - 32) / 1.8 else valuenum end as v
  from stays s join chart c on s.icustay_id = c.icustay_id and charttime between intime - interval 2 hour and intime + interval 1 day
    and error is distinct from 1
  left join rules on itemid = item and valuenum > lo and (valuenum < hi or (closed and valuenum = hi))
  where itemid in ({', '.join(map(str, WATCHED))}))
select subject_id, hadm_id, icustay_id, {_vital_cols()} from seen group by 1, 2, 3"""


@check("clinical_vitals", "CON3 AGG2 AGG4 AGG5 PRJ4 MTH2 JON3", VITALS_SQL)
def clinical_vitals(spark, d):
    t = Tables(spark, d)
    return rounded(timed.vitals(H.stays(t), vital_rows(t)), 8)


# --- chemistry ---------------------------------------------------------------------------------
LAB_ITEMS = [i for r in R.LABS for i in r[1]] + [50806]
LAB_VALUE = """case when l_orderkey % 23 = 0 then 0 when itemid = 50983 then 85 + l_quantity * 3
  when itemid in (50862, 50885, 50912, 50813, 50971) then l_quantity / 6 when itemid in (51265, 50902, 50868) then l_quantity * 250
  else l_quantity * 2.1 end"""
LAB_RULES = [(r[0], i, float(r[2] if r[2] is not None else -1e9), float(r[3])) for r in R.LABS for i in r[1]]
LAB_FRAMES = {"d1": "off between -60 and 1440", "h1": "off between -60 and 60"}


def lab_rows(t):
    return H.observations(t, ["hadm_id"], LAB_ITEMS, LAB_VALUE)


LABS_CTE = f"""
{H.STAYS}, {H.observations_sql("lab", ["hadm_id"], LAB_ITEMS, LAB_VALUE)}, lrules(label, item, lo, hi) as ({values(LAB_RULES)}),
draws as (select icustay_id, date_diff('microsecond', intime, charttime) / 6e7 as off, label,
    max(case when valuenum between lo and hi then valuenum end) as v
  from stays join lab on stays.hadm_id = lab.hadm_id and charttime >= intime - interval 1 hour and charttime <= outtime + interval 1 hour
  join lrules on itemid = item where valuenum > 0 group by 1, 2, 3)"""


@check("clinical_labs", "CON5 AGG1 AGG3 JON3 PRJ1 PRJ2 DAT2", f"""
with {LABS_CTE}
select icustay_id, {', '.join(f"{e}(v) filter (label = '{r[0]}' and {cond}) as {f}_{r[0]}_{e}" for f, cond in LAB_FRAMES.items() for r in R.LABS for e in ENDS)}
from draws where {LAB_FRAMES['d1']} group by 1""")
def clinical_labs(spark, d):
    t = Tables(spark, d)
    return timed.labs(H.stays(t), lab_rows(t))


@check("clinical_labs_wide", "CON5 AGG1", f"""
with {LABS_CTE}
select icustay_id, round(off, 4) as laboffset, {', '.join(f"max(v) filter (label = '{r[0]}') as {r[0]}" for r in R.LABS)}
from draws group by 1, 2""")
def clinical_labs_wide(spark, d):
    t = Tables(spark, d)
    return timed.labs_wide(H.stays(t), lab_rows(t)).withColumn("laboffset", F.round("laboffset", 4))


# --- blood gas -----------------------------------------------------------------------------------
GAS_ITEMS = [50800, 50821, 50821, 50821, 50818, 50820, 50816, 50801, 50811, 50817, 50803, 50810]
GAS_VALUE = """case itemid when 50821 then 12 + l_quantity * 3 when 50818 then 15 + l_quantity when 50820 then 7 + l_quantity / 60
  when 50816 then l_quantity * 2 when 50801 then l_quantity * 12 when 50811 then l_quantity / 4 when 50817 then 50 + l_quantity * 1.1
  when 50803 then l_quantity when 50810 then l_quantity * 1.6 end"""
GAS_TEXT = "case when itemid = 50800 then case when l_linenumber % 2 = 0 then 'ART' else 'VEN' end end"
NEAR_ITEMS = [646, 220277, 223835, 727, 3420, 3422, 190]
NEAR_VALUE = """case when itemid in (646, 220277) then 55 + l_quantity when itemid = 190 then l_quantity / 50
  when l_linenumber = 1 then l_quantity / 40 else l_quantity * 2.1 end"""
GAS_RULES = [(n, i, float(lo if lo is not None else -1e9), float(hi if hi is not None else 1e9)) for n, i, lo, hi in R.GASES]
TERMS = " + ".join(f"coalesce({b} * {x}, {c})" for b, x, c in R.SPECIMEN_TERMS).replace("* fio2,", "* fio2_lab,")

# what a charted item says, as a share or percent; anything else is no reading
CHARTED = """case when itemid in (646, 220277) and valuenum > 0 and valuenum <= 100 then valuenum
  when itemid in (223835, 727) and valuenum > 20 and valuenum <= 100 or itemid in (3420, 3422) and valuenum > 20 and valuenum <= 100 then valuenum / 100.0
  when itemid in (223835, 727, 190) and valuenum > 0.2 and valuenum <= 1 then valuenum end"""
IN_RANGE = "max(valuenum) filter (label = '{0}' and valuenum > 0 and valuenum between lo and hi)"


def _drawn_columns():
    for name, *_ in R.GASES:
        value = IN_RANGE.format(name)
        if name == "hematocrit":
            value += " / 100.0"
        if name == "fio2":  # percent and share come mixed, so they are brought to one scale before the maximum
            value = value.replace("max(valuenum)", "max(case when valuenum >= 20 then valuenum / 100.0 else valuenum end)")
        yield f"{value} as {'fio2_lab' if name == 'fio2' else name}"


# the latest reading at or before a draw is the greatest (time, value) pair, a missing value included
GAS_CTE = f"""
{H.STAYS}, {H.observations_sql("glab", ["subject_id"], GAS_ITEMS, GAS_VALUE, GAS_TEXT, H.SLOT_MINUTES)},
{H.observations_sql("near", ["icustay_id"], NEAR_ITEMS, NEAR_VALUE)}, grules(label, item, lo, hi) as ({values(GAS_RULES)}),
drawn as (
  select icustay_id, intime, charttime, max(glab.value) filter (itemid = 50800) as specimen, {', '.join(_drawn_columns())}
  from stays join glab using (subject_id) left join grules on item = itemid
  where charttime between intime - interval 1 hour and outtime + interval 1 day
  group by icustay_id, intime, charttime
  having count(glab.value) filter (itemid = 50800) <= 1
), charted as (
  select icustay_id, charttime as seen, itemid in (646, 220277) as saturation, max({CHARTED}) as reading
  from near where itemid in (646, 220277) or error is distinct from 1 group by all
), beside as (
  select d.icustay_id, d.charttime,
    (max({{'seen': seen, 'reading': reading}}) filter (saturation and seen >= d.charttime - interval 2 hour)).reading as spo2,
    (max({{'seen': seen, 'reading': reading}}) filter (not saturation)).reading as fio2_chart
  from drawn d left join charted c on c.icustay_id = d.icustay_id and c.seen between d.charttime - interval 4 hour and d.charttime
  where d.po2 is not null group by all
), gas as (
  select *, coalesce(fio2_lab, fio2_chart) as fio2,
    1 / (1 + exp(-({R.SPECIMEN_INTERCEPT} + {R.SPECIMEN_PO2} * po2 + {TERMS}))) as prob,
    coalesce(specimen, case when prob > 0.75 then 'ART' end) as specimen_pred,
    fio2 * 713 - pco2 / 0.8 - po2 as aado2_calc, po2 / fio2 as pao2fio2
  from drawn join beside using (icustay_id, charttime))"""


def gas_lab_rows(t):
    return H.observations(t, ["subject_id"], GAS_ITEMS, GAS_VALUE, GAS_TEXT, H.SLOT_MINUTES)


def gas_chart_rows(t):
    return H.observations(t, ["icustay_id"], NEAR_ITEMS, NEAR_VALUE)


def gas_frames(t, first_day_only=False):
    return timed.blood_gas(H.stays(t), gas_lab_rows(t), gas_chart_rows(t), first_day_only)


@check("clinical_blood_gas", "CON1 JON4 WIN9 MTH5 MTH6 MTH7 MTH8 SCO11 AGG12", f"""
with {GAS_CTE}
select icustay_id, charttime, specimen, specimen_pred, round(prob, 6) as prob, po2, pco2, ph, spo2, round(fio2, 6) as fio2, aado2,
  round(aado2_calc, 4) as aado2_calc, round(pao2fio2, 4) as pao2fio2, hemoglobin, so2, bicarbonate, round(hematocrit, 6) as hematocrit from gas""")
def clinical_blood_gas(spark, d):
    g = gas_frames(Tables(spark, d))
    return g.select("icustay_id", "charttime", "specimen", "specimen_pred", F.round("specimen_prob", 6).alias("prob"), "po2", "pco2",
                    "ph", "spo2", F.round("fio2", 6).alias("fio2"), "aado2", F.round("aado2_calc", 4).alias("aado2_calc"),
                    F.round("pao2fio2", 4).alias("pao2fio2"), "hemoglobin", "so2", "bicarbonate",
                    F.round("hematocrit", 6).alias("hematocrit"))


def _edges(edges, points, key):
    bounds = [-1e9, *map(float, edges), 1e9]
    return [(*key, bounds[i], bounds[i + 1], p) for i, p in enumerate(points)]


OXY = _edges(*R.AADO2_BANDS, ("a",)) + _edges(*R.PAO2_BANDS, ("p",))
AB = []
_low = -1e9
for _edge, _ye, _pts in R.ACID_BASE:
    AB += _edges(_ye, _pts, (_low, float(_edge or 1e9)))
    _low = float(_edge or 1e9)
GAS_STEMS = dict(R.GAS_SUMMARY)


def _gas_cols():
    out = []
    for f, cond in FRAME_SQL.items():
        for stem, c in GAS_STEMS.items():
            c = "coalesce(aado2, aado2_calc)" if c == "aado2_any" else c
            out += [f"round({e}({c}) filter ({cond}), 4) as {f}_{stem}_{e}" for e in ENDS]
    return ", ".join(out)


def _gas_pick(f, cond):
    return f"""oxy_{f} as (select * from (select *, row_number() over (partition by icustay_id order by oxy desc, po2,
    case when fio2 is not null then 0 else 1 end, charttime) as rn from scored where {cond}) where rn = 1),
ab_{f} as (select * from (select *, row_number() over (partition by icustay_id order by ab desc, pco2 desc, charttime) as rn
    from scored where {cond} and ab is not null) where rn = 1)"""


GAS_SUMMARY_SQL = f"""
with {GAS_CTE}, oband(kind, lo, hi, pts) as ({values(OXY)}), aband(x0, x1, lo, hi, pts) as ({values(AB)}),
scored as (select gas.*, oband.pts as oxy, aband.pts as ab from gas
  left join oband on kind = case when fio2 >= 0.5 and aado2 is not null then 'a' else 'p' end
    and case when fio2 >= 0.5 and aado2 is not null then aado2 else po2 end >= lo
    and case when fio2 >= 0.5 and aado2 is not null then aado2 else po2 end < hi
  left join aband on ph >= x0 and ph < x1 and pco2 >= aband.lo and pco2 < aband.hi where specimen_pred = 'ART'),
agg as (select icustay_id, {_gas_cols()} from scored group by 1), {', '.join(_gas_pick(f, c) for f, c in FRAME_SQL.items())}
select s.icustay_id, agg.* exclude (icustay_id),
  {', '.join(f"o_{f}.po2 as {f}_oxy_pao2, round(o_{f}.fio2, 6) as {f}_oxy_fio2, o_{f}.aado2 as {f}_oxy_aado2, o_{f}.oxy as {f}_oxygenation_score, a_{f}.ph as {f}_acidbase_ph, a_{f}.pco2 as {f}_acidbase_paco2, a_{f}.ab as {f}_acidbase_score" for f in FRAME_SQL)}
from stays s left join agg using (icustay_id) {' '.join(f"left join oxy_{f} o_{f} on o_{f}.icustay_id = s.icustay_id left join ab_{f} a_{f} on a_{f}.icustay_id = s.icustay_id" for f in FRAME_SQL)}"""


@check("clinical_blood_gas_summary", "CON2 SCO4 SCO5 WIN8 AGG14 SRT3", GAS_SUMMARY_SQL)
def clinical_blood_gas_summary(spark, d):
    t = Tables(spark, d)
    out = timed.blood_gas_summary(H.stays(t), gas_frames(t, first_day_only=True))
    cols = ["icustay_id"]
    for f in FRAME_SQL:
        cols += [F.round(f"{f}_{s}_{e}", 4).alias(f"{f}_{s}_{e}") for s in GAS_STEMS for e in ENDS]
        cols += [f"{f}_oxy_pao2", F.round(f"{f}_oxy_fio2", 6).alias(f"{f}_oxy_fio2"), f"{f}_oxy_aado2", f"{f}_oxygenation_score",
                 f"{f}_acidbase_ph", f"{f}_acidbase_paco2", f"{f}_acidbase_score"]
    return out.select(*cols)


# --- urine, coma ----------------------------------------------------------------------------------
URINE_ITEMS = [40055, 226559, 227488, 227489, 226560, 1]
STAY = ["subject_id", "hadm_id", "icustay_id"]


@check("clinical_urine_output", "CON6 AGG6 JON3", f"""
with {H.STAYS}, {H.observations_sql("o", STAY, URINE_ITEMS, "l_quantity * 9")}
select s.subject_id, s.hadm_id, s.icustay_id, round(sum(case when itemid = 227488 then -valuenum else valuenum end), 4) as urineoutput
from stays s join o on s.icustay_id = o.icustay_id and s.hadm_id = o.hadm_id and s.subject_id = o.subject_id
  and charttime between intime and intime + interval 1 day where itemid <> 1 group by 1, 2, 3""")
def clinical_urine_output(spark, d):
    t = Tables(spark, d)
    rows = H.observations(t, STAY, URINE_ITEMS, "l_quantity * 9")
    rows = rows.drop("value").withColumnRenamed("valuenum", "value")
    return rounded(timed.urine_output(H.stays(t), rows))


COMA_ITEMS = [184, 454, 723, 223900, 223901, 220739]
COMA_VALUE = "case when itemid in (184, 220739) then 1 + l_linenumber % 4 when itemid in (454, 223901) then 1 + l_suppkey % 6 else 1 + l_orderkey % 5 end"
COMA_TEXT = "case when l_orderkey % 7 = 0 and itemid = 723 then '1.0 ET/Trach' when l_orderkey % 7 = 0 and itemid = 223900 then 'No Response-ETT' end"


@check("clinical_coma_scale", "SCO6 JON5 WIN6 WIN7", f"""
with {H.STAYS}, {H.observations_sql("c", ["icustay_id"], COMA_ITEMS, COMA_VALUE, COMA_TEXT)},
w as (select s.icustay_id, charttime, max(case when itemid in (454, 223901) then valuenum end) as motor,
    max(case when itemid in (723, 223900) then case when value is not null then 0 else valuenum end end) as verbal,
    max(case when itemid in (184, 220739) then valuenum end) as eyes
  from stays s join c on s.icustay_id = c.icustay_id and charttime between intime and intime + interval 1 day and error is distinct from 1 group by 1, 2),
p as (select *, lag(charttime) over x as pt, lag(motor) over x as pm, lag(verbal) over x as pv, lag(eyes) over x as pe
  from w window x as (partition by icustay_id order by charttime)),
q as (select icustay_id, charttime, motor, verbal, eyes, case when pt > charttime - interval 6 hour then pm end as pm,
  case when pt > charttime - interval 6 hour then pv end as pv, case when pt > charttime - interval 6 hour then pe end as pe from p),
g as (select *, case when coalesce(verbal, pv) = 0 and (verbal = 0 or verbal is null) then 15
    when pv = 0 then coalesce(motor, 6) + coalesce(verbal, 5) + coalesce(eyes, 4)
    else coalesce(motor, pm, 6) + coalesce(verbal, pv, 5) + coalesce(eyes, pe, 4) end as gcs from q),
r as (select *, row_number() over (partition by icustay_id order by gcs, charttime) as rn from g)
select s.subject_id, s.hadm_id, s.icustay_id, cast(gcs as double) as mingcs, coalesce(motor, pm) as gcsmotor, coalesce(verbal, pv) as gcsverbal,
  coalesce(eyes, pe) as gcseyes, cast(case when gcs is null then null when verbal = 0 then 1 else 0 end as integer) as endotrachflag
from stays s left join r on s.icustay_id = r.icustay_id and rn = 1""")
def clinical_coma_scale(spark, d):
    t = Tables(spark, d)
    return timed.coma_scale(H.stays(t), H.observations(t, ["icustay_id"], COMA_ITEMS, COMA_VALUE, COMA_TEXT))


# --- demographics ----------------------------------------------------------------------------------
DEMO_ITEMS = [762, 226512, 920, 226707, 225082, 227687, 225108, 5]
DEMO_VALUE = """case when itemid in (762, 226512) then l_quantity * 9 when itemid in (920, 226707) then l_quantity * 2.2
  when itemid = 225082 then l_linenumber % 3 - 1 when l_orderkey % 2 = 0 then l_linenumber % 4 - 1 end"""
PHRASES = ["never smoked", "Tobacco: denies.", "He does not drink or smoke", "ex-smoker since 1990", "Smokes 10 cigs/day", "sleeps well", "no etoh, tobacco"]
PHRASE_CASE = "case doc_id % 11 " + " ".join(f"when {i} then ' {p}'" for i, p in enumerate(PHRASES)) + " else '' end"
SMOKE_SQL = "case " + " ".join(
    "when regexp_matches(text, '" + pattern + f"', 'i') then {code}" for pattern, code in R.SMOKING_NOTES) + " end"
NOTES = f"notes as (select (doc_id - doc_id % 2) * 3 as subject_id, text || {PHRASE_CASE} as text from documents)"
SERVICES = f"services as (select p_partkey - p_partkey % 2 as hadm_id, {H.duck_time(H.admit('p_partkey'), '(p_partkey % 40 - 10) * 60')} as transfertime, p_type as curr_service from part)"


def note_rows(t):
    return t.documents.selectExpr("(doc_id - doc_id % 2) * 3 as subject_id", f"text || {PHRASE_CASE} as text")


def service_rows(t):
    return t.part.selectExpr("p_partkey - p_partkey % 2 as hadm_id",
                             f"{H.spark_time(H.admit('p_partkey'), '(p_partkey % 40 - 10) * 60')} as transfertime",
                             "p_type as curr_service")


@check("smoking_notes", "STR2 AGG11 CON7", f"""
with {NOTES} select subject_id, min({SMOKE_SQL}) as note_smoking from notes group by 1""")
def smoking_notes(spark, d):
    return timed.smoking_from_notes(note_rows(Tables(spark, d)))


@check("clinical_demographics", "CON7 AGG10 AGG11 WIN1 WIN2", f"""
with {H.STAYS}, {H.observations_sql("c", ["icustay_id"], DEMO_ITEMS, DEMO_VALUE)}, {NOTES}, {SERVICES},
answers(item, code) as (values (227687, 0), (227687, 1), (227687, 2), (225108, 0), (225108, 1), (225108, 2)),
early as (select stays.icustay_id, itemid, valuenum from c join stays using (icustay_id) where charttime < intime + interval 1 day and coalesce(error, 0) <> 1),
body as (
  select icustay_id, avg(case when itemid in (762, 226512) and valuenum between 20 and 400 then valuenum end) as weight,
    avg(case when itemid in (920, 226707) and valuenum between 10 and 100 then valuenum end) as height,
    max(case when itemid = 225082 and valuenum >= 0 then valuenum end) as pregnant,
    max(case when itemid = 225108 and valuenum = 1 then 2 when itemid in (select item from answers) and valuenum >= 0 then valuenum end) as told
  from early group by icustay_id),
noted as (select subject_id, min({SMOKE_SQL}) as read from notes group by subject_id),
habits(code, smoking) as (values (0, 'Never Smoked'), (1, 'Ex-Smoker'), (2, 'Current Smoker'))
select s.subject_id, s.hadm_id, s.icustay_id, round(body.weight, 8) as weight, round(body.height, 8) as height, body.pregnant,
  coalesce(habits.smoking, 'Unknown') as smoking,
  (select first(curr_service order by transfertime desc, curr_service) from services v where v.hadm_id = s.hadm_id and v.transfertime < s.intime + interval 1 day) as first_service,
  cast(exists (select 1 from stays e where e.hadm_id = s.hadm_id and (e.intime, e.icustay_id) < (s.intime, s.icustay_id)) as integer) as readmission
from stays s left join body using (icustay_id) left join noted on noted.subject_id = s.subject_id
left join habits on habits.code = coalesce(case when told in (select code from answers) then told end, read)""")
def clinical_demographics(spark, d):
    t = Tables(spark, d)
    chart = H.observations(t, ["icustay_id"], DEMO_ITEMS, DEMO_VALUE)
    return rounded(timed.demographics(H.stays(t), chart, note_rows(t), service_rows(t)), 8)


# --- physiology score --------------------------------------------------------------------------------
SCALES = {"heartrate": (3.4, 20), "mbp": (2.6, 20), "temp": (0.25, 30), "resprate": (1.1, 1), "hematocrit": (0.7, 25), "wbc": (0.6, 0),
          "creatinine": (0.06, 0.1), "bun": (2.0, 3), "sodium": (1.1, 110), "albumin": (0.1, 1), "bilirubin": (0.22, 0.3), "glucose": (8.0, 25)}
_BAND_ROWS = [row for n, (e, p) in R.BANDS.items() for row in _edges(e, p, (n,))]


def _band_rows():
    renal = [("renal", *r) for r in _edges(*R.RENAL_FAILURE_CREATININE, ())]
    urine = [("urine", *r) for r in _edges(*R.URINE_BANDS, ())]
    return _BAND_ROWS + renal + urine


_WIDE = ", ".join(f"min(l_quantity * {a} + {b}) filter (k = {i}) as {n}_min, max(l_quantity * {a} + {b}) filter (k = {i}) as {n}_max"
                  for i, (n, (a, b)) in enumerate(SCALES.items()))
_LONG = " union all ".join(f"select p_partkey, '{n}' as var, {n}_min as lo, {n}_max as hi, vent, arf from wide" for n in SCALES)
_COMA = [(s, v, m, p) for s, rows in (("shut", R.COMA_EYES_CLOSED), ("open", R.COMA_EYES_OPEN)) for vs, ms, p in rows for v in vs for m in ms]
PART_STATE = """p_partkey % 3 = 0 as v3, p_partkey % 5 = 0 as v5"""


@check("clinical_physiology_score", "SCO1 SCO2 SCO3 SCO7 SCO8 SCO10 MTH9", f"""
with agg as (select l_partkey, {_WIDE} from (select *, (l_orderkey + l_linenumber) % 12 as k from lineitem) group by 1),
wide as (select p_partkey, cast(p_partkey % 3 = 0 as integer) as vent, cast(p_partkey % 5 = 0 as integer) as arf, p_retailprice * 2 - 1500 as uo,
  p_size % 6 as verbal, 1 + p_size % 4 as eyes, 1 + p_partkey % 6 as motor, nullif(p_size % 13, 3) as ab, nullif(p_size % 16, 5) as oxy, agg.*
  from part left join agg on l_partkey = p_partkey),
bands(var, lo, hi, pts) as ({values(_band_rows())}), coma(state, verbal, motor, pts) as ({values(_COMA)}),
ends as (select p_partkey, var, 1 as pos, lo as v, hi, vent, arf from ({_LONG}) union all select p_partkey, var, 2, hi, hi, vent, arf from ({_LONG})),
pts as (select e.*, case when e.var = 'resprate' and vent = 1 and v < 14 then 0 else b.pts end as pts
  from ends e left join bands b on b.var = case when e.var = 'creatinine' and arf = 1 then 'renal' else e.var end and v >= b.lo and v < b.hi),
best as (select p_partkey, var, arg_max(pts, pts * 10 + pos) as pts, arg_max(v, pts * 10 + pos) as v from pts
  where hi is not null and (var not in ('bun', 'bilirubin') or pos = 2) group by 1, 2),
tot as (select p_partkey, sum(pts) as s, {', '.join(f"round(max(v) filter (var = '{n}'), 4) as {n}" for n in SCALES)} from best group by 1)
select w.p_partkey, cast(coalesce(s, 0) + coalesce(u.pts, 0) + coalesce(ab, 0) + coalesce(oxy, 0)
    + coalesce(case when w.verbal = 0 then 0 else c.pts end, 0) as integer) as apsiii, {', '.join(SCALES)}
from wide w left join tot on tot.p_partkey = w.p_partkey left join bands u on u.var = 'urine' and uo >= u.lo and uo < u.hi
left join coma c on c.verbal = w.verbal and c.motor = w.motor and c.state = case when eyes = 1 then 'shut' else 'open' end""")
def clinical_physiology_score(spark, d):
    t = Tables(spark, d)
    k = (F.col("l_orderkey") + F.col("l_linenumber")) % 12
    aggs = []
    for i, (n, (a, b)) in enumerate(SCALES.items()):
        v = F.when(k == i, F.col("l_quantity") * a + b)
        aggs += [F.min(v).alias(f"{n}_min"), F.max(v).alias(f"{n}_max")]
    wide = t.part.join(t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(*aggs), "p_partkey", "left").selectExpr(
        "*", "cast(p_partkey % 3 = 0 as int) as vent", "cast(p_partkey % 5 = 0 as int) as arf", "p_retailprice * 2 - 1500 as urineoutput",
        "p_size % 6 as gcsverbal", "1 + p_size % 4 as gcseyes", "1 + p_partkey % 6 as gcsmotor", "cast(p_size % 6 = 0 as int) as endotrachflag",
        "nullif(p_size % 13, 3) as acidbase_score", "nullif(p_size % 16, 5) as oxygenation_score")
    scored = timed.physiology_score(wide)
    return scored.select("p_partkey", "apsiii", *[F.round(n, 4).alias(n) for n in SCALES])


# --- cohort -------------------------------------------------------------------------------------------
HR_ITEMS = [211, 220045, 3, 128, 223758]
HR_TEXT = "case when itemid in (128, 223758) and l_linenumber = 1 then 'DNR / DNI' when itemid in (128, 223758) then 'Full Code' end"
# enough history to span the exclusion rules: some stays have no heart rate, some only a short one
HR_VALUE = "case when l_partkey % 4 = 0 and l_linenumber > 1 then 0 else l_quantity - 2 end"


def patient_rows(t):
    return t.part.where("p_partkey % 6 = 0").selectExpr(
        "p_partkey as subject_id", "case when p_size % 2 = 0 then 'F' else 'M' end as gender",
        "case when p_partkey % 30 = 0 then timestamp_ntz'1750-03-01 00:00:00' else timestamp_ntz'1940-01-01 00:00:00' + make_dt_interval(cast(p_partkey * 911 % 30000 as int), 0, 0, 0) end as dob")


def admission_rows(t):
    return t.part.where("p_partkey % 2 = 0").selectExpr(
        "p_partkey as hadm_id", f"{H.spark_time(H.admit('p_partkey'), '-60 * (p_partkey % 100)')} as admittime",
        f"{H.spark_time(H.admit('p_partkey') + ' + 100 + p_partkey % 300')} as dischtime",
        f"case when p_partkey % 8 = 0 then {H.spark_time(H.admit('p_partkey') + ' + 40')} end as deathtime",
        "case when p_size % 3 = 0 then 'ELECTIVE' else 'URGENT' end as admission_type",
        "case when p_size % 4 = 0 then 'CLINIC REFERRAL/PREMATURE' when p_size % 4 = 1 then 'EMERGENCY ROOM ADMIT' else 'ELSEWHERE' end as admission_location",
        "case when p_size % 5 = 0 then 'SNF' when p_size % 5 = 1 then 'HOME' when p_size % 5 = 2 then 'DEAD/EXPIRED' end as discharge_location",
        "case when p_size % 6 = 0 then 'WHITE' when p_size % 6 = 1 then 'PORTUGUESE' when p_size % 6 = 2 then 'ASIAN - THAI' else 'OTHER' end as ethnicity",
        "cast(p_partkey % 8 = 0 as int) as hospital_expire_flag")


COHORT_CTE = f"""{H.STAYS}, {SERVICES}, {H.observations_sql("hr", ["icustay_id"], HR_ITEMS, HR_VALUE, HR_TEXT)},
patients as (select p_partkey as subject_id, case when p_size % 2 = 0 then 'F' else 'M' end as gender,
  case when p_partkey % 30 = 0 then timestamp '1750-03-01' else timestamp '1940-01-01' + to_days(cast(p_partkey * 911 % 30000 as integer)) end as dob from part where p_partkey % 6 = 0),
adm as (select p_partkey as hadm_id, {H.duck_time(H.admit('p_partkey'), '-60 * (p_partkey % 100)')} as admittime from part where p_partkey % 2 = 0),
heard as (
  select s.icustay_id,
    min(charttime) filter (beat and charttime between intime - interval 1 day + interval 1 microsecond and outtime + interval 1 day - interval 1 microsecond) as intime_hr,
    max(charttime) filter (beat and charttime between intime - interval 1 day + interval 1 microsecond and outtime + interval 1 day - interval 1 microsecond) as outtime_hr,
    min(charttime) filter (itemid in (128, 223758) and value = 'DNR / DNI') as dnrtime
  from stays s join (select *, itemid in (211, 220045) and valuenum > 0 as beat from hr where error is distinct from 1) o using (icustay_id)
  group by s.icustay_id
), person as (
  select stays.*, gender, dob, admittime, intime_hr, outtime_hr, date_diff('microsecond', intime_hr, dnrtime) / 8.64e10 as dnrtime_days,
    round(if(intime_hr > dob + interval 199 year, 91.6, date_diff('microsecond', dob, intime_hr) / 8.64e10 / 365.242), 2) as age,
    (select first(curr_service order by transfertime desc, curr_service) from services v join stays w using (hadm_id)
     where v.hadm_id = stays.hadm_id and v.transfertime < w.intime + interval 1 day) as first_service
  from stays join patients using (subject_id) join adm using (hadm_id) left join heard using (icustay_id)
), visits as (
  select subject_id, list(icustay_id order by intime_hr nulls last, icustay_id) as in_order, list(admittime) as admitted
  from person where first_service is not null group by subject_id
), cohort as (
  select person.*, list_position(in_order, icustay_id)::bigint as num, 1 + len(list_filter(admitted, lambda x: x < admittime)) as admission_rank,
    (intime_hr is null)::integer as exclusion_nodata, (num > 1)::integer as exclusion_readmission, coalesce(age < 16, false)::integer as exclusion_age,
    coalesce(outtime_hr < intime_hr + interval 4 hour, false)::integer as exclusion_shortstay,
    (intime_hr is null or greatest(exclusion_readmission, exclusion_age, exclusion_shortstay) = 1)::integer as excluded
  from person join visits using (subject_id) where first_service is not null)"""


@check("clinical_cohort", "COH1 AGG7 AGG8 WIN1 WIN2 WIN3 DAT1 DAT4 DAT5", f"""
with {COHORT_CTE}
select icustay_id, intime_hr, outtime_hr, admission_rank, num as icustay_num, gender, first_service, age, round(dnrtime_days, 6) as dnrtime_days,
  exclusion_nodata, exclusion_readmission, exclusion_age, exclusion_shortstay, excluded from cohort""")
def clinical_cohort(spark, d):
    t = Tables(spark, d)
    chart = H.observations(t, ["icustay_id"], HR_ITEMS, HR_VALUE, HR_TEXT)
    co = timed.cohort(H.stays(t), patient_rows(t), admission_rows(t), service_rows(t), chart)
    return co.select("icustay_id", "intime_hr", "outtime_hr", F.col("admission_rank").cast("long").alias("admission_rank"),
                     F.col("icustay_num").cast("long").alias("icustay_num"), "gender", "first_service", "age",
                     F.round("dnrtime_days", 6).alias("dnrtime_days"), "exclusion_nodata", "exclusion_readmission", "exclusion_age",
                     "exclusion_shortstay", "excluded")
