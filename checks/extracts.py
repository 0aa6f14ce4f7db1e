"""Full-width extracts of the flat registries: every column the plan fills."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.plans import flat, merge
from wardline.registry import header_schema

from .base import Tables, check
from .shaping import rounded

DUCK = {T.StringType(): "varchar", T.DoubleType(): "double", T.IntegerType(): "integer"}
KINDS = {f.name: DUCK[f.dataType] for f in header_schema()}


def columns_sql(fields: dict[str, str]) -> str:
    def typed(e, kind):
        return f"try_cast(trunc(try_cast({e} as double)) as integer)" if kind == "integer" else f"try_cast({e} as {kind})"

    return ", ".join(f'{typed(e, KINDS[n])} as "{n}"' for n, e in fields.items())


def lookup_sql(column: str, codes: dict) -> str:
    def text(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return f"case {column} " + " ".join(f"when {text(k)} then {text(v)}" for k, v in codes.items()) + " end"


# --- study registry: all text, one row per stay ---------------------------------------------------------
def _pick(column: str, values: list[str]) -> str:
    return f"case {column} % {len(values) + 1} " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(values)) + " else 'not listed' end"


STUDY = {
    "hosp_code": "'h' || cast(o_custkey % 9 as varchar)", "medicalrecord": "cast(o_custkey as varchar)", "admissionrecordid": "cast(o_orderkey as varchar)",
    "hospbeds": "case when o_orderkey % 5 = 0 then 'many' else cast(o_orderkey % 620 as varchar) end", "gender": _pick("o_orderkey", ["M", "F"]),
    "hospitaldestinationname": _pick("o_orderkey", list(flat.STUDY_HOSPITAL_DESTINATION)), "admissionsourcename": _pick("o_custkey", list(flat.STUDY_ADMIT_SOURCE)),
    "unitdestinationname": _pick("o_orderkey", list(flat.STUDY_UNIT_DESTINATION)), "admissiontypename": _pick("o_custkey", list(flat.STUDY_ADMIT_TYPE)),
}
# the copied columns: numbers as text, some of them no numbers
STUDY |= {c: f"case when o_orderkey % {k + 3} = 0 then 'n/a' else cast((o_orderkey + {k}) % 150 as varchar) end"
          for k, c in enumerate(dict.fromkeys(flat.STUDY_COPIES.values())) if c not in STUDY}
STUDY_OUT = {
    "data_source": "'study'", "encounter_id": "hosp_code || '_' || medicalrecord || '_' || admissionrecordid", "patient_id": "medicalrecord",
    "country": "'brazil'",
    "hospital_bed_size": "case when try_cast(hospbeds as double) >= 500 then '>= 500' when try_cast(hospbeds as double) >= 250 then '250 - 499' "
                         "when try_cast(hospbeds as double) >= 100 then '100 - 249' when try_cast(hospbeds as double) >= 0 then '<100' end",
    "gender": "case when gender in ('M', 'F') then gender end", "hospital_disch_location": lookup_sql("hospitaldestinationname", flat.STUDY_HOSPITAL_DESTINATION),
    "icu_admit_source": lookup_sql("admissionsourcename", flat.STUDY_ADMIT_SOURCE), "icu_disch_location": lookup_sql("unitdestinationname", flat.STUDY_UNIT_DESTINATION),
    "elective_surgery": lookup_sql("admissiontypename", flat.STUDY_ADMIT_TYPE), "readmission_status": "0",
} | {n: f'"{c}"' for n, c in flat.STUDY_COPIES.items()}
STUDY_OUT = {n: e for n, e in STUDY_OUT.items() if n in KINDS}


STUDY_CTE = f"""registry as (select {', '.join(f'{e} as "{n}"' for n, e in STUDY.items())} from orders),
study as (select {columns_sql(STUDY_OUT)} from registry)"""


def study_rows(spark, d):
    registry = Tables(spark, d).orders.selectExpr(*[f"{e.replace('varchar', 'string')} as `{n}`" for n, e in STUDY.items()])
    return flat.study_extract(registry, "study")


@check("study_extract", "CON8 SCH6 SCH7 PRJ6 PRJ7", f"with {STUDY_CTE} select * from study")
def study_extract(spark, d):
    return study_rows(spark, d).select(*STUDY_OUT)


# --- relational registry: visits, weights, patients ------------------------------------------------------
VISIT_KEYS = {"tipodni": "o_custkey % 3", "dni": "o_custkey", "fecing": "cast(o_orderkey as varchar)"}
VISIT = VISIT_KEYS | {
    "patologia": "o_orderkey % 4", "resultadoegresoh": "case when o_orderkey % 6 = 0 then 'Fallece' when o_orderkey % 6 < 5 then 'Vive' end", "restrat": "o_orderkey % 7",
    "fecegrh": "cast(o_orderkey % 900 + 40 as varchar)", "fecingh": "cast(o_orderkey % 31 as varchar)", "fechaing": "case when o_orderkey % 8 > 0 then cast(o_orderkey % 35 as varchar) else '?' end",
    "frecresp": "o_orderkey % 30",
}
VISIT |= {c: f"cast((o_orderkey + {k}) % 170 as double) / 2" for k, c in enumerate([*flat.RELATIONAL_COPIES.values(), *flat.RELATIONAL_AS_WRITTEN.values()])
          if c not in VISIT and c not in ("imc", "peso", "altura")}
RELATIONAL_OUT = {
    "data_source": "'rel'", "encounter_id": "concat(v.tipodni, v.dni, v.fecing)", "patient_id": "concat(v.tipodni, v.dni)", "country": "'argentina'",
    "elective_surgery": "coalesce(patologia = 3, false)::integer", "height": "nullif(altura, 0)", "hospital_death": "coalesce(resultadoegresoh = 'Fallece', false)::integer",
    "icu_death": "coalesce(restrat = 5, false)::integer", "hospital_los_days": "try_cast(fecegrh as double) - try_cast(fecingh as double)",
    "pre_icu_los_days": "try_cast(fechaing as double) - try_cast(fecingh as double)", "ventilated_apache": "(frecresp = 0)::integer",
} | dict(flat.RELATIONAL_COPIES) | dict(flat.RELATIONAL_AS_WRITTEN)
RELATIONAL_OUT = {n: e for n, e in RELATIONAL_OUT.items() if n in KINDS}


RELATIONAL_CTE = f"""v as (select {', '.join(f"{e} as {n}" for n, e in VISIT.items())} from orders),
w as (select {', '.join(f"{e} as {n}" for n, e in VISIT_KEYS.items())}, o_orderkey % 40 + 10.5 as imc from orders where o_orderkey % 3 > 0),
p as (select c_custkey % 3 as tipodni, c_custkey as dni, c_custkey % 190 as altura, c_custkey % 120 + 0.5 as peso from customer where c_custkey % 10 > 0),
relational as (select {columns_sql(RELATIONAL_OUT)} from v left join w using (tipodni, dni, fecing) left join p using (tipodni, dni))"""


def relational_rows(spark, d):
    t = Tables(spark, d)
    text = {n: e.replace("varchar", "string") for n, e in VISIT.items()}
    visits = t.orders.selectExpr(*[f"{e} as {n}" for n, e in text.items()])
    weights = t.orders.where("o_orderkey % 3 > 0").selectExpr(*[f"{text[n]} as {n}" for n in VISIT_KEYS], "o_orderkey % 40 + 10.5 as imc")
    patients = t.customer.where("c_custkey % 10 > 0").selectExpr(
        "c_custkey % 3 as dnitipo", "c_custkey as dni", "c_custkey % 190 as altura", "c_custkey % 120 + 0.5 as peso")
    return flat.relational_extract(visits, weights, patients, "rel")


@check("relational_extract", "CON8 JON10 SRC2 SCH6 SCH7 PRJ8", f"with {RELATIONAL_CTE} select * from relational")
def relational_extract(spark, d):
    return relational_rows(spark, d).select(*RELATIONAL_OUT)


# --- both sources merged ------------------------------------------------------------------------------------
PROFILED = [n for n in dict.fromkeys([*STUDY_OUT, *RELATIONAL_OUT]) if n not in merge.SKIPPED_IN_PROFILE]


@check("merged_sources", "CON10 AGG19 SET1 PRJ12", f"""
with {STUDY_CTE}, {RELATIONAL_CTE},
whole as (select * replace ('pooled' as data_source) from study union all by name select * from relational),
counted as (select data_source, {', '.join(f'round(nullif(100.0 * count("{n}") / count(*), 0), 4) as "{n}"' for n in PROFILED)} from whole group by data_source)
select data_source, variable, percent from (unpivot counted on columns(* exclude data_source) into name variable value percent)""")
def merged_sources(spark, d):
    """Two sources under one header, tags unified, body systems looked up, profiled for completeness."""
    maps = Tables(spark, d).part.selectExpr(
        "cast(p_size as string) as apache_3j_diagnosis", "'Post-operative' as apache_3j_operative", "'s' as apache_3j_bodysystem",
        "cast(p_size as string) as apache_2_diagnosis", "'Post-operative' as apache_2_operative", "'t' as apache_2_bodysystem").distinct()
    three = maps.select("apache_3j_diagnosis", "apache_3j_operative", "apache_3j_bodysystem", "apache_2_diagnosis")
    two = maps.select("apache_2_diagnosis", "apache_2_operative", "apache_2_bodysystem")
    whole = merge.merge([study_rows(spark, d), relational_rows(spark, d)], three, two, {"pooled": ["study", "carevue"]})
    table = merge.completion_table(merge.top_code_age(whole, "pooled")).where(F.col("percent").isNotNull())
    return rounded(table.select("data_source", "variable", "percent"))
