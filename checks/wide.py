"""The harmonised row of the absolute-time source at full width, the expected columns written out by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.plans import timed

from . import clinical as C
from . import shapes as H
from .base import SQL, Tables, check
from .registries import timed_extract_frame
from .shaping import rounded

FRAMES = ("d1", "h1")
VITALS = """heartrate resprate spo2 temp sysbp_invasive diasbp_invasive mbp_invasive sysbp_noninvasive diasbp_noninvasive mbp_noninvasive
  sysbp diasbp mbp pasys_invasive padias_invasive pamean_invasive""".split()
# measures of the laboratory; those that a blood gas has too are still the laboratory's
LABS = {"albumin": "albumin", "bilirubin": "bilirubin", "bun": "bun", "calcium": "calcium", "creatinine": "creatinine", "glucose": "glucose", "inr": "inr",
        "hco3": "hco3", "hematocrit": "hematocrit", "hemaglobin": "hemoglobin", "lactate": "lactate", "platelets": "platelet",
        "potassium": "potassium", "sodium": "sodium", "wbc": "wbc"}
GASES = {"arterial_ph": "ph", "arterial_po2": "pao2", "arterial_pco2": "paco2", "pao2fio2ratio": "pao2fio2"}
ROW = {
    "data_source": "'src'", "encounter_id": "cast(c.icustay_id as varchar)", "patient_id": "cast(c.subject_id as varchar)", "hospital_id": "'-1'",
    "country": "'USA'", "hospital_bed_size": "'>= 500'", "hospital_bed_size_numeric": "651.0::double", "icu_id": "cast(c.icustay_id % 9 as varchar)",
    "icu_type": "'MICU'", "icu_stay_type": "dm.first_service", "icu_los_days": "(c.icustay_id % 30)::double",
    "age": "round(date_diff('day', cast(p.dob as date), cast(s.intime as date)) / 365.242, 4)", "gender": "c.gender",
    "weight": "round(dm.weight, 4)", "height": "round(dm.height * 2.54, 4)",
    "bmi": "case when dm.height > 0 then round(dm.weight / (dm.height * 2.54 / 100) ** 2, 4) end", "pregnant": "dm.pregnant::double::varchar",
    "smoking_status": "dm.smoking", "readmission_status": "dm.readmission::integer",
    "ethnicity": "case p_size % 6 when 0 then 'Caucasian' when 1 then 'Hispanic' when 2 then 'Asian' else 'Other/Unknown' end",
    "hospital_admit_source": "case p_size % 4 when 0 then 'Direct Admit' when 1 then 'Emergency Department' end",
    "hospital_disch_location": "case p_size % 5 when 0 then 'Skilled Nursing Facility' when 1 then 'Home' when 2 then 'Death' end",
    "hospital_los_days": "date_diff('day', cast(a.admittime as date), cast(dischtime as date))::double",
    "hospital_death": "(c.hadm_id % 8 = 0)::integer", "pre_icu_los_days": "round(date_diff('microsecond', a.admittime, s.intime) / 8.64e10, 4)",
    "icu_death": "coalesce(deathtime <= s.outtime, false)::integer", "elective_surgery": "(p_size % 3 = 0)::integer",
    "arf_apache": "coalesce(l.d1_creatinine_max >= 1.5 and u.urineoutput < 410 and not dialysis, false)::integer",
    "urineoutput_apache": "round(u.urineoutput, 4)",
    **{f"{f}_{v}_{e}": f"round(v.{f}_{v}_{e}, 4)" for f in FRAMES for v in VITALS for e in ("max", "min")},
    **{f"{f}_{n}_{e}": f"round(l.{f}_{x}_{e}, 4)" for f in FRAMES for n, x in LABS.items() for e in ("max", "min")},
    **{f"{f}_{n}_{e}": f"round(g.{f}_{x}_{e}, 4)" for f in FRAMES for n, x in GASES.items() for e in ("max", "min")},
}
#: In the header, but not in this source.
ABSENT = "hospital_type icu_admit_source icu_admit_type icu_disch_location apache_2_diagnosis apache_3j_diagnosis aids cirrhosis leukemia".split()


def _part(name: str, query: str) -> str:
    return f"{name} as ({SQL[query]})"


@check("timed_extract_wide", "CON8 SCO9 CON3 CON5 CON2 CON7 SCH7", f"""
with {C.COHORT_CTE}, {_part('v', 'clinical_vitals')}, {_part('l', 'clinical_labs')}, {_part('g', 'clinical_blood_gas_summary')},
{_part('dm', 'clinical_demographics')}, {_part('u', 'clinical_urine_output')},
adm2 as (select adm.*, p.p_size, {H.duck_time(H.admit('p_partkey') + ' + 100 + p_partkey % 300')} as dischtime,
  case when p_partkey % 8 = 0 then {H.duck_time(H.admit('p_partkey') + ' + 40')} end as deathtime from adm join part p on p_partkey = hadm_id),
renal as (select p_partkey - p_partkey % 2 as hadm_id, bool_or(p_size = 7) as dialysis from part group by 1)
select {', '.join(f'{e} as {n}' for n, e in ROW.items())}, {', '.join(f"null::{'integer' if n in ('aids', 'cirrhosis', 'leukemia') else 'varchar'} as {n}" for n in ABSENT)}
from cohort c join stays s on s.icustay_id = c.icustay_id join adm2 a on a.hadm_id = c.hadm_id join patients p on p.subject_id = c.subject_id
left join v on v.icustay_id = c.icustay_id left join l on l.icustay_id = c.icustay_id left join g on g.icustay_id = c.icustay_id
left join dm on dm.icustay_id = c.icustay_id left join u on u.icustay_id = c.icustay_id left join renal on renal.hadm_id = c.hadm_id
where c.excluded = 0""")
def timed_extract_wide(spark, d):
    """Identity, stay, demographics, renal failure and all vitals, chemistry and gases of both windows."""
    return rounded(timed_extract_frame(spark, d).select(*ROW, *ABSENT))


@check("clinical_renal_failure", "SCO9 AGG9", f"""
with {_part('l', 'clinical_labs')}, {_part('u', 'clinical_urine_output')}, {H.STAYS},
renal as (select p_partkey - p_partkey % 2 as hadm_id, max(case when p_size = 7 then 1 else 0 end) as ckd from part where p_partkey % 5 > 0 group by 1)
select s.icustay_id, cast(case when d1_creatinine_max >= 1.5 and urineoutput < 410 and ckd = 0 then 1 else 0 end as integer) as arf
from stays s left join l on l.icustay_id = s.icustay_id left join u on u.icustay_id = s.icustay_id left join renal on renal.hadm_id = s.hadm_id""")
def clinical_renal_failure(spark, d):
    """High creatinine with little urine, unless on chronic dialysis; a stay without coded diagnoses counts as no."""
    t = Tables(spark, d)
    stays = H.stays(t)
    urine = H.observations(t, C.STAY, C.URINE_ITEMS, "l_quantity * 9").drop("value").withColumnRenamed("valuenum", "value")
    codes = t.part.where("p_partkey % 5 > 0").select(
        (F.col("p_partkey") - F.col("p_partkey") % 2).alias("hadm_id"), F.when(F.col("p_size") == 7, "5855").otherwise("4019").alias("icd9_code"))
    return timed.renal_failure(stays, timed.labs(stays, C.lab_rows(t)), timed.urine_output(stays, urine), codes)
