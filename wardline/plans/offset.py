"""Concepts from a source whose times are minutes from unit admission.

Tables use their published column names: patient, lab, vitalperiodic, vitalaperiodic,
nursecharting, medication, hospital and the three score tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.text import key_of
from ..operators import joins as J
from ..operators import ordered as O
from ..operators import pivot as P
from ..operators.cohort import flag_exclusions
from ..operators.conform import apply_field_map
from ..registry import header_schema
from . import offset_rules as R

STAY = "patientunitstayid"


def _frames(offset: str, closed: bool = True) -> dict[str, Column]:
    return {name: S.within(offset, lo, hi, closed, closed) for name, (lo, hi) in R.FRAMES.items()}


def _valid(rules: list[tuple]) -> Column:
    return reduce(lambda a, b: a | b, [
        F.col("labname").isin(*names) & S.within("labresult", lo, hi, lc, hc) for _, names, lo, hi, lc, hc in rules])


def _clean(lab: DataFrame, rules: list[tuple]) -> DataFrame:
    """Newest valid revision per stay, test and offset, without contradictory duplicates."""
    names = list(dict.fromkeys(n for r in rules for n in r[1]))
    return J.latest_consistent(
        lab.where(F.col("labname").isin(*names)).select(
            STAY, "labname", "labresultoffset", "labresultrevisedoffset", "labresult"),
        [STAY, "labname", "labresultoffset"], "labresultrevisedoffset", "labresult", _valid(rules))


def _widen(clean: DataFrame, rules: list[tuple]) -> DataFrame:
    stems = {r[0]: list(r[1]) for r in rules}
    aggs = [F.max(F.when(F.col("labname").isin(*names), F.col("labresult"))).alias(stem) for stem, names in stems.items()]
    return clean.groupBy(STAY, "labresultoffset").agg(*aggs)


def labs_wide(lab: DataFrame) -> DataFrame:
    """One row per stay and offset with a column per analyte."""
    return _widen(_clean(lab, R.LABS), R.LABS)


def _in_frames(lab: DataFrame) -> DataFrame:
    """Rows of the longest frame only; the cut happens at the scan, before any shuffle."""
    return lab.where(S.within("labresultoffset", *R.FRAMES["d1"]))


def labs(lab: DataFrame) -> DataFrame:
    stems = {r[0]: r[0] for r in R.LABS}
    return P.minmax(labs_wide(_in_frames(lab)), [STAY], stems, _frames("labresultoffset"))


def blood_gas_wide(lab: DataFrame) -> DataFrame:
    return _widen(_clean(lab, R.GASES), R.GASES).withColumn("fio2", S.percent_to_fraction("fio2"))


def blood_gas(lab: DataFrame) -> DataFrame:
    cols = {"pao2fio2ratio": S.pf_ratio("pao2", "fio2"), "pao2": "pao2", "paco2": "paco2", "ph": "ph"}
    return P.minmax(blood_gas_wide(_in_frames(lab)), [STAY], cols, _frames("labresultoffset"))


# --- vitals -------------------------------------------------------------------------------------
def _monitored(table: DataFrame, rules: list[tuple], with_temp: bool) -> DataFrame:
    cols = {stem: S.keep_within(col, lo, hi) for stem, col, lo, hi in rules}
    if with_temp:
        cols["temp"] = S.celsius_by_value("temperature")
    rows = table.where(S.within("observationoffset", *R.FRAMES["d1"]))
    return P.minmax(rows, [STAY], cols, _frames("observationoffset"))


def vitals(patient: DataFrame, periodic: DataFrame, aperiodic: DataFrame) -> DataFrame:
    """Monitored vitals of the first day and first hour for every stay."""
    return J.assemble(patient.select(STAY), [_monitored(periodic, R.PERIODIC, True),
                                             _monitored(aperiodic, R.APERIODIC, False)], STAY)


def vitals_charted(charting: DataFrame) -> DataFrame:
    """Vitals typed in by nurses; only plain numbers count."""
    label, name, text = "nursingchartcelltypevallabel", "nursingchartcelltypevalname", "nursingchartvalue"
    stem = None
    for out, pairs, *_ in R.CHARTED:
        cond = reduce(lambda a, b: a | b, [(F.col(label) == x) & (F.col(name) == y) for x, y in pairs])
        stem = F.when(cond, F.lit(out)) if stem is None else stem.when(cond, F.lit(out))
    lo, hi = R.FRAMES["d1"]
    rows = charting.where(
        F.col("nursingchartcelltypecat").isin(*R.CHARTED_CATEGORIES)
        & S.within("nursingchartoffset", lo, hi, False, False)
    ).select(STAY, "nursingchartoffset", stem.alias("stem"), S.numeric_text(text).alias("v"))
    cols = {out: S.keep_within(F.when(F.col("stem") == out, F.col("v")), low, high, closed, closed)
            for out, _, low, high, closed in R.CHARTED}
    wide = P.minmax(rows, [STAY], cols, _frames("nursingchartoffset", closed=False))
    pooled = [F.coalesce(f"{f}_mbp_invasive_{e}", f"{f}_mbp_noninvasive_{e}").alias(f"{f}_mbp_{e}")
              for f in R.FRAMES for e in ("min", "max")]
    return wide.select("*", *pooled)


# --- cohort ---------------------------------------------------------------------------------------
def cohort(patient: DataFrame, lab: DataFrame, periodic: DataFrame, results: DataFrame, predictors: DataFrame,
           medication: DataFrame | None = None, stay_types: DataFrame | None = None,
           require_medication: bool = False) -> DataFrame:
    """Stays with exclusion flags: adults, known outcome, first long stay, hospital-years with data."""
    group = ["hospitalid", "hospitaldischargeyear"]
    covers = {"n_vital": (periodic, "observationoffset"), "n_lab": (lab, "labresultoffset")}
    if medication is not None:
        covers["n_med"] = (medication, "drugorderoffset")
    long_stays = patient.where(
        (F.col("unitdischargeoffset") >= R.MIN_STAY_MINUTES) & (F.col("unitstaytype") != R.STEPDOWN))
    first = O.first_row(
        long_stays, ["uniquepid"],
        [O.nulls_last("hospitaldischargeyear"), O.descending("hospitaldischargeoffset"),
         O.nulls_last("patienthealthsystemstayid"), F.col(STAY)], [STAY]
    ).select(STAY, F.lit(1).alias("is_first"))
    iva = results.where(F.col("apacheversion") == R.SCORE_VERSION).groupBy(STAY).agg(
        F.max("apachescore").alias("apachescore"),
        F.min(S.to_number("predictedhospitalmortality")).alias("predicted"))
    numbered = O.sequence(patient, [STAY], [F.col("hospitaldischargeoffset").desc_nulls_first()],
                          -O.number_cell("hospitaldischargeoffset", 1440), "copy_no")
    base = J.assemble(numbered, [first, iva, predictors.select(STAY, "readmit", F.lit(1).alias("in_pred"))], STAY)
    for out, (table, counted) in covers.items():
        base = base.join(J.coverage(patient, table, STAY, group, counted, out), group, "left")
    if stay_types is not None:
        base = base.join(stay_types.select(STAY, F.col("type").cast("string").alias("stay_type")), STAY, "left")
        by_type = (~S.is_true(F.col("stay_type").isin(*R.FIRST_STAY_TYPES))).cast("int")
    else:
        by_type = F.lit(None).cast("int")
    age = S.to_number("age")
    open_age = F.col("age").isin(R.OLDEST_AGE, "")
    no_status = F.coalesce("hospitaldischargestatus", F.lit("")) == ""
    has_data = (F.col("n_vital") > 0) & (F.col("n_lab") > 0)
    if require_medication:
        has_data = has_data & (F.col("n_med") > 0)
    pred_readmit = S.is_true((F.col("apachescore") > 1) & (F.col("predicted") == -1))
    rules = {
        "exclusion_non_adult": ~open_age & (age < R.MIN_AGE),
        "exclusion_missingoutcome": no_status | ~F.col("unitdischargestatus").isin(*R.OUTCOMES),
        "exclusion_short_or_secondary_stay": F.col("is_first").isNull(),
        "exclusion_missing_data": ~S.is_true(has_data),
    }
    flagged = flag_exclusions(base, rules, "any_flag")
    known = S.is_true(open_age | (age >= R.MIN_AGE)) & S.is_true(F.col("unitdischargestatus").isin(*R.OUTCOMES))
    return flagged.select(
        STAY, F.col("readmit").alias("readmission_apache"), by_type.alias("readmission_by_type"),
        F.when(F.col("in_pred").isNotNull(), (F.col("copy_no") > 1).cast("int")).alias("readmission_status"),
        pred_readmit.cast("int").alias("readmission_apache_pred"),
        (pred_readmit | S.is_true(F.col("readmit") == 1)).cast("int").alias("readmission_apache_combined"),
        *rules, (~((F.col("any_flag") == 0) & known)).cast("int").alias("excluded"),
    )


# --- extract ----------------------------------------------------------------------------------------
def extract(source: str, patient: DataFrame, hospital: DataFrame, inputs: DataFrame, predictors: DataFrame,
            results: DataFrame, included: DataFrame, lab_summary: DataFrame, gas_summary: DataFrame,
            monitored: DataFrame, charted: DataFrame, diagnosis: DataFrame | None = None) -> DataFrame:
    """The harmonised row per included stay. ``diagnosis`` comes from ``diagnosis.enrich``."""
    ids = J.in_cohort(patient, included, [STAY])
    weight = S.keep_within("admissionweight", 25)
    height = S.metres_or_cm("admissionheight")
    stays = ids.select("*", weight.alias("kg"), height.alias("cm"))
    beds = hospital.select("hospitalid", "teachingstatus", "numbedscategory")
    score = results.where(F.col("apacheversion") == R.SCORE_VERSION).select(
        STAY, "acutephysiologyscore", F.col("apachescore").alias("total_score"),
        "predictedicumortality", "predictedhospitalmortality")
    raw = inputs.selectExpr(STAY, *[f"{c} as in_{c}" for c in [*dict.fromkeys(R.SCORE_INPUTS.values()), "fio2"]])
    pred = predictors.select(STAY, F.col("age").alias("pred_age"), "electivesurgery", "oobventday1", "admitdiagnosis",
                             *[F.col(c).alias(f"co_{c}") for c in R.COMORBIDITIES.values()])
    parts = [raw, pred, score, _prefixed(lab_summary, "lab_"), _prefixed(gas_summary, "gas_"),
             _prefixed(monitored, "m_"), _prefixed(charted, "c_")]
    wide = J.assemble(stays.join(beds, "hospitalid", "left"), parts, STAY)
    if diagnosis is not None:
        wide = wide.join(diagnosis, STAY, "left")
    have = set(wide.columns)
    names = {
        "data_source": F.lit(source), "encounter_id": key_of(F.lit(f"{source}_"), STAY),
        "patient_id": key_of(F.lit(f"{source}_"), "uniquepid"), "country": F.lit(R.COUNTRY),
        "hospital_id": "hospitalid", "teaching_hospital": "teachingstatus",
        "hospital_bed_size": "numbedscategory", "icu_id": "wardid", "icu_type": "unittype",
        "icu_stay_type": "unitstaytype", "age": "pred_age",
        "gender": S.map_codes("gender", R.GENDER), "weight": "kg", "height": "cm",
        "bmi": S.bmi("kg", "cm"), "ethnicity": "ethnicity",
        "hospital_admit_source": "hospitaladmitsource",
        "hospital_disch_location": "hospitaldischargelocation",
        "hospital_los_days": S.minutes_to_days("hospitaldischargeoffset"),
        "hospital_death": S.map_codes("hospitaldischargestatus", R.DIED),
        "icu_admit_source": S.recode("unitadmitsource", R.UNIT_ADMIT_SOURCE),
        "icu_disch_location": "unitdischargelocation",
        "pre_icu_los_days": -S.minutes_to_days("hospitaladmitoffset"),
        "icu_los_days": S.minutes_to_days("unitdischargeoffset"),
        "icu_death": S.map_codes("unitdischargestatus", R.DIED),
        "elective_surgery": S.is_true(F.col("electivesurgery") == 1).cast("int"),
        # one row per stay, so a stay is never its own repeat
        "readmission_status": F.lit(0),
        **{out: f"co_{c}" for out, c in R.COMORBIDITIES.items()},
        **{out: S.sentinel_null(f"in_{c}") for out, c in R.SCORE_INPUTS.items()},
        "fio2_apache": S.sentinel_null("in_fio2") / 100.0,
        "ventilated_apache": S.sentinel_null("oobventday1"),
        "apsiii": "acutephysiologyscore", "apache_3j_score": "total_score",
        "apache_4a_icu_death_prob": S.to_number("predictedicumortality"),
        "apache_4a_hospital_death_prob": S.to_number("predictedhospitalmortality"),
    }
    gas_names = {"arterial_ph": "ph", "arterial_po2": "pao2", "arterial_pco2": "paco2"}
    for frame in R.FRAMES:
        for end in ("min", "max"):
            for bp in ("sysbp", "diasbp", "mbp"):
                # pooled pressure: charted cuff, charted line, monitored cuff, monitored line
                names[f"{frame}_{bp}_{end}"] = F.coalesce(*[
                    F.col(f"{who}_{frame}_{bp}_{how}_{end}") for who in ("c", "m") for how in ("noninvasive", "invasive")])
    for field in header_schema().names:
        if field in names or field[:3] not in ("d1_", "h1_"):
            continue
        frame, rest = field[:2], field[3:]
        stem, end = rest.rsplit("_", 1)
        if f"c_{field}" in have and f"m_{field}" in have:
            names[field] = F.coalesce(f"c_{field}", f"m_{field}")
        elif f"lab_{field}" in have:
            names[field] = f"lab_{field}"
        elif f"gas_{frame}_{gas_names.get(stem, stem)}_{end}" in have:
            names[field] = f"gas_{frame}_{gas_names.get(stem, stem)}_{end}"
    if diagnosis is not None:
        for c in ("apache_3j_diagnosis", "apache_2_diagnosis", "apache_post_operative"):
            names[c] = c
    return apply_field_map(wide, names, header_schema())


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.selectExpr(STAY, *[f"{c} as {prefix}{c}" for c in df.columns if c != STAY])
