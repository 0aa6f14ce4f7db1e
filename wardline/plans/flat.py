"""Flat registries: one wide row per stay that is filtered, recoded and mapped onto the header.

Four layouts are covered: coded fields with paired low/high values (``coded``), text fields with
units (``text``), a study sheet of first-hour values (``study``) and a small relational registry
(``relational``). Column names are the lower-cased names of the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import text as X
from ..operators import joins as J
from ..operators import ordered as O
from ..operators.cohort import flag_exclusions, keep_first
from ..operators.conform import apply_field_map
from ..registry import header_schema
from .diagnosis import operative_status

# --- fixed values -------------------------------------------------------------------------
YES_NO = {1: 1, 2: 0}
MIN_AGE = 16
YEARS = (2014, 2015)
HOSPITAL_OUTCOME_CODES = (0, 8)

# coded layout
CARE_TYPE = {1: "ICU", 2: "HDU"}
HOSPITAL_SOURCE = {
    1: "Home", 2: "Other Acute Hospital", 3: "Chronic Care Hospital (including nursing homes)",
    4: "Other hospital ICU",
}
HOSPITAL_OUTCOME = {
    2: "Died in Hospital", 3: "Discharged home", 4: "Transferred to Chronic Care/Rehabilitation Hospital",
    5: "Transferred to Other Hospital ICU", 6: "Transferred to Other Acute Care Hospital",
}
UNIT_OUTCOME = {
    2: "Died in ICU", 3: "Survived ICU", 5: "Transferred to another ICU", 6: "Transferred to another hospital",
}
UNIT_SOURCE = {
    1: "Operating Room / Recovery", 2: "Accident & Emergency", 3: "Floor", 4: "Other ICU", 5: "Other Hospital",
    6: "Other ICU",
}
INDIGENOUS = {1: "Indigenous", 0: "Australian", -1: "Unknown"}
SMOKING = {1: "Current Smoker", 2: "Ex-Smoker", 3: "Never Smoked", 4: "Unknown"}
TEACHING_LEVEL = "3/PICU"
SUB_SCORES = (
    "albuminscore", "bilirubinscore", "creatininescore", "glucosescore", "haematocritscore", "heartratescore",
    "meanarterialpressurescore", "sodiumscore", "neurologicalscore", "oxygenationscore", "phscore",
    "respiratoryratescore", "temperaturescore", "ureascore", "urineoutputscore", "whitecellcountscore",
)
# header stem -> source stem of a lo/hi pair, and the unit change
CODED_PAIRS = {
    "heartrate": ("hr", None), "resprate": ("rr", None), "temp": ("temp", None), "sysbp": ("systolic", None),
    "diasbp": ("diastolic", None), "mbp": ("map", None), "creatinine": ("creat", "umol_creatinine_to_mg_dl"),
    "glucose": ("gluc", "mmol_glucose_to_mg_dl"), "hco3": ("hco3", None), "hematocrit": ("hct", "fraction_to_percent"),
    "hemaglobin": ("hmgn", None), "platelets": ("plat", None), "potassium": ("k", None), "sodium": ("na", None),
    "wbc": ("wcc", None),
}
CODED_SCORE_INPUTS = {
    "albumin_apache": ("albumin_anz", "g_l_to_g_dl"), "bilirubin_apache": ("bili_anz", "umol_bilirubin_to_mg_dl"),
    "creatinine_apache": ("creat_anz", "umol_creatinine_to_mg_dl"),
    "glucose_apache": ("glucose_anz", "mmol_glucose_to_mg_dl"), "hematocrit_apache": ("hct_anz", "fraction_to_percent"),
    "heart_rate_apache": ("hr_anz", None), "map_apache": ("map_anz", None), "sodium_apache": ("na_anz", None),
    "fio2_apache": ("fio2_anz", None), "paco2_apache": ("paco2_anz", None), "pao2_apache": ("pao2_anz", None),
    "ph_apache": ("ph_anz", None), "paco2_for_ph_apache": ("ap3co2p", None), "resprate_apache": ("rr_anz", None),
    "temp_apache": ("temp_anz", None), "bun_apache": ("urea_anz", "mmol_urea_to_mg_dl"),
    "urineoutput_apache": ("urineop", None), "wbc_apache": ("wcc_anz", None), "gcs_eyes_apache": ("gcseye", None),
    "gcs_motor_apache": ("gcsmotor", None), "gcs_verbal_apache": ("gcsverb", None),
}
CODED_COPIES = {
    "country": "country", "hospital_id": "site_id", "hospital_type": "hospitalclassification", "icu_id": "site_id",
    "age": "age", "gender": "sex", "weight": "weight", "height": "height", "apache_2_diagnosis": "ap2diag",
    "apache_3j_score": "apache3score", "apache_3j_hospital_death_prob": "apache3riskofdeath",
}
CODED_FLAGS = {
    "pregnant": "preg_stat", "hospital_death": "died_hosp", "icu_death": "died_icu", "elective_surgery": "elect",
    "readmission_status": "readmitted", "diabetes_mellitus": "iddm", "cirrhosis": "cirrhos",
    "hepatic_failure": "hepfail", "lymphoma": "lymphoma", "leukemia": "leukaem",
    "solid_tumor_with_metastasis": "metast", "aids": "aids", "arf_apache": "arf", "intubated_apache": "intubated",
    "ventilated_apache": "ventilated",
}
IMMUNE_FIELDS = ("immundis", "immunrx", "immunsup")

# text layout
SITE_COUNTRY = {3: "India", 4: "Sri Lanka", 1: "Bangladesh", 2: "Nepal"}
TEXT_GENDER = {"Male": "M", "Female": "F", "male": "M", "female": "F"}
OPERATIVE_WORD, POST_OPERATIVE, NON_OPERATIVE = "surgical", "Post-operative", "Non-operative"
TEXT_PAIRS = {
    "heartrate": "heart_rate", "resprate": "resp_rate", "temp": "temp", "sysbp": "sys_bp", "mbp": "map",
    "bun": "bun", "creatinine": "creatinine", "hemaglobin": "hb", "potassium": "pottasium", "sodium": "sodium",
    "wbc": "wbc", "arterial_ph": "ph", "arterial_po2": "pao2",
}
TEXT_PERCENT_PAIRS = {"spo2": "saturate", "hematocrit": "pcv"}
TEXT_COPIES = {
    "icu_id": "icu_id", "icu_los_days": "lengthofstay", "icu_death": "mortality", "diabetes_mellitus": "diabetes",
    "aids": "aids", "ventilated_apache": "mechanical_first_24h", "apache_2_diagnosis": "target_id",
}

# study layout
BED_EDGES = [0, 100, 250, 500]
BED_LABELS = [None, "<100", "100 - 249", "250 - 499", ">= 500"]
STUDY_COUNTRY = "brazil"
STUDY_HOSPITAL_DESTINATION = {
    "Death": "Died in Hospital", "Home-care": "Discharged home",
    "Residence": "Transferred to Chronic Care/Rehabilitation Hospital",
    "Hospice / Casa de apoio": "Transferred to Other Hospital ICU",
    "Other hospital": "Transferred to Other Acute Care Hospital",
    "Other / Unkown": "Transferred to Other Acute Care Hospital",
}
STUDY_UNIT_DESTINATION = {
    "WardFloor": "Survived ICU", "OtherICUSameHosp": "Transferred to another ICU", "Death": "Died in ICU",
    "Residence": "Survived ICU", "IntermediateUnit": "Transferred to another ICU",
    "Other hospital": "Transferred to another hospital", "Home-care": "Survived ICU", "Other / Unkown": "Survived ICU",
    "Hospice / Casa de apoio": "Survived ICU",
}
STUDY_ADMIT_SOURCE = {
    "Emergency": "Accident & Emergency", "Operating room": "OT/Recovery", "Ward / Floor": "Ward",
    "Transfer from other hospital": "Other Hospital", "Intervention room": "Intervention room",
    "Other ICU at your hosp": "Other ICU, same Hospital", "Intermediate care unit": "Intermediate care unit",
    "Other unkown": "Other unkown", "Home-care": "Home-care",
}
STUDY_ADMIT_TYPE = {"Medical": 0, "Scheduled Surgery": 1, "Urgent Surgery": 0}
STUDY_GENDER = {"M": "M", "F": "F"}
STUDY_COPIES = {
    "hospital_id": "hosp_code", "hospital_bed_size_numeric": "hospbeds", "icu_id": "icu_code", "icu_type": "icu_type",
    "age": "age", "weight": "weight", "height": "height", "bmi": "bmi", "hospital_los_days": "hospitallengthstay",
    "hospital_death": "hospdeath", "pre_icu_los_days": "lengthhospitalstaypriorunitadmission",
    "icu_los_days": "unitlengthstay", "icu_death": "icudeath", "h1_heartrate_max": "highest heart rate1h",
    "h1_resprate_max": "highest respiratory rate1h", "h1_temp_max": "highest temperature1h",
    "h1_sysbp_min": "lowest systolic blood pressure1h", "h1_diasbp_min": "lowest diastolic blood pressure1h",
    "h1_mbp_min": "lowest mean arterial pressure1h", "h1_bilirubin_max": "highest bilirubin1h",
    "h1_creatinine_max": "highest creatinine1h", "h1_lactate_max": "highest arterial lactate1h",
    "h1_platelets_min": "lowest platelets count1h", "h1_wbc_max": "highest leukocyte count1h",
    "h1_arterial_ph_min": "lowest ph1h", "h1_arterial_ph_max": "highest ph1h",
    "h1_arterial_po2_min": "lowest pa o21h", "h1_arterial_po2_max": "highest pa o21h",
    "h1_arterial_pco2_min": "lowest pa co21h", "h1_arterial_pco2_max": "highest pa co21h",
    "h1_pao2fio2ratio_min": "lowest pa o2fi o21h", "h1_pao2fio2ratio_max": "highest pa o2fi o21h",
    "ventilated_apache": "mechvent_24h",
}

# relational layout
RELATIONAL_COUNTRY, RELATIONAL_DIED, RELATIONAL_UNIT_DIED, RELATIONAL_SURGICAL = "argentina", "Fallece", 5, 3
RELATIONAL_COPIES = {
    "age": "edad", "bmi": "imc", "gender": "sexo", "hospital_disch_location": "resultadoegresoh",
    "icu_admit_source": "procedencia", "icu_admit_type": "patologia", "icu_disch_location": "restrat",
    "icu_los_days": "dias", "readmission_status": "reingreso", "weight": "peso", "arf_apache": "ira",
    "creatinine_apache": "creatin", "fio2_apache": "valfio2", "heart_rate_apache": "freccard",
    "hematocrit_apache": "hematroc", "map_apache": "tensart", "paco2_apache": "pco2", "pao2_apache": "pao2",
    "ph_apache": "phart", "resprate_apache": "frecresp", "temp_apache": "temperatura", "wbc_apache": "leucoc",
}
# as the source writes them, nitrogen and sodium sit in each other's field
RELATIONAL_AS_WRITTEN = {"bun_apache": "na", "sodium_apache": "k"}
# ------------------------------------------------------------------------------------------


# --- coded layout ---------------------------------------------------------------------------
def coded_cohort(df: DataFrame) -> DataFrame:
    """Flagged stays of the chosen discharge years; a null age, risk or heart rate excludes."""
    years = df.where(S.year_between("hosp_ds_dtm", *YEARS))
    lo, hi = HOSPITAL_OUTCOME_CODES
    return flag_exclusions(years, {
        "exclusion_age": ~S.is_true(F.col("age") >= MIN_AGE),
        "exclusion_outcome": (F.col("hosp_outcm") < lo) | (F.col("hosp_outcm") > hi),
        "exclusion_readmission": F.col("readmitted") == 1,
        "exclusion_noprediction": ~S.is_true(F.col("apache3riskofdeath") > 0),
        "exclusion_nodata": F.col("hrlo").isNull() | F.col("hrhi").isNull(),
    })


def coded_first_stays(flagged: DataFrame) -> DataFrame:
    """First included stay per patient and site; stays of one time rank by all their fields."""
    kept = flagged.where(F.col("excluded") == 0)
    whole = F.struct(*[F.col(f"`{c}`") for c in sorted(kept.columns)])
    return keep_first(kept, ["patientid", "site_id"], [O.nulls_last("icu_ad_dtm"), whole])


def coded_fields(source: str, immune_code: int = 2) -> dict[str, Column | str | None]:
    """Field map of the coded layout. ``immune_code`` is the answer read as immunosuppressed."""
    fields: dict[str, Column | str | None] = {
        "data_source": F.lit(source),
        "encounter_id": X.key_of("site_id", F.lit("_"), "patientid"),
        "patient_id": X.key_of("patientid"),
        "teaching_hospital": S.is_true(F.col("cicmlevel") == TEACHING_LEVEL).cast("int"),
        "icu_stay_type": S.map_codes(F.col("caretype").cast("int"), CARE_TYPE),
        "bmi": S.bmi("weight", "height"),
        "ethnicity": S.map_codes(F.col("indigenous").cast("int"), INDIGENOUS),
        "smoking_status": S.map_codes(F.col("smokingstatus").cast("int"), SMOKING),
        "hospital_admit_source": S.map_codes(F.col("hosp_srce").cast("int"), HOSPITAL_SOURCE),
        "hospital_disch_location": S.map_codes(F.col("hosp_outcm").cast("int"), HOSPITAL_OUTCOME),
        "icu_admit_source": S.map_codes(F.col("icu_srce").cast("int"), UNIT_SOURCE),
        "icu_disch_location": S.map_codes(F.col("icu_outcm").cast("int"), UNIT_OUTCOME),
        "hospital_los_days": S.hours_to_days("hosp_hrs"),
        "pre_icu_los_days": S.hours_to_days("pre_icu_hrs"),
        "icu_los_days": S.hours_to_days("icu_hrs"),
        "immunosuppression": S.any_equal(list(IMMUNE_FIELDS), immune_code),
        "apache_post_operative": F.col("`post-operative`"),
        "apache_3j_diagnosis": F.coalesce("ap3_subcode", "ap3diag"),
        "apsiii": S.sum_all(list(SUB_SCORES)),
        **CODED_COPIES,
        **{out: S.map_codes(F.col(c).cast("int"), YES_NO) for out, c in CODED_FLAGS.items()},
    }
    for stem, (src, unit) in CODED_PAIRS.items():
        for end, side in (("min", "lo"), ("max", "hi")):
            fields[f"d1_{stem}_{end}"] = S.convert(f"{src}{side}", unit) if unit else f"{src}{side}"
    for out, (src, unit) in CODED_SCORE_INPUTS.items():
        fields[out] = S.convert(src, unit) if unit else src
    return fields


def coded_extract(df: DataFrame, text_map: DataFrame, source: str, immune_code: int = 2) -> DataFrame:
    """Cohort, first stays, operative status and header of a coded registry."""
    stays = operative_status(coded_first_stays(coded_cohort(df)), text_map)
    return apply_field_map(stays, coded_fields(source, immune_code), header_schema())


# --- text layout ------------------------------------------------------------------------------
def text_reconcile(df: DataFrame, older: DataFrame) -> DataFrame:
    """How many rows of the new version agree with the old one on age and systolic pressure."""
    cols = ["age", "sys_bp_highest"]
    a, b = [t.select("id", *[S.to_number(c).alias(c) for c in cols]) for t in (df, older)]
    return J.reconcile(a, b, "id", cols)


def text_prepare(df: DataFrame, older: DataFrame) -> DataFrame:
    """Site from the older version, operative status, misplaced weights moved back."""
    with_site = df.join(older.select("id", "site"), "id", "left")
    weight, height = X.rescue_misplaced("weight", "height")
    operative = X.contains_flag("admission_type", OPERATIVE_WORD, POST_OPERATIVE, NON_OPERATIVE)
    return with_site.withColumns({"weight": weight, "height": height, "operative": operative})


def text_cohort(df: DataFrame) -> DataFrame:
    return flag_exclusions(df, {
        "exclusion_outcome": F.col("mortality").isNull(),
        "exclusion_readmission": F.lit(False),
        "exclusion_noprediction": ~S.is_true(S.to_number("a_score") > 0),
        "exclusion_nodata": F.col("heart_rate_lowest").isNull() | F.col("heart_rate_highest").isNull(),
    })


def text_fields(source: str) -> dict[str, Column | str | None]:
    kg, cm = X.parse_weight("weight"), X.parse_height("height")
    key = X.key_of(F.lit(f"{source}_"), "id")
    fields: dict[str, Column | str | None] = {
        "data_source": F.lit(source), "encounter_id": key, "patient_id": key,
        "country": S.map_codes(F.col("site").cast("int"), SITE_COUNTRY), "age": X.parse_age("age"),
        "gender": S.map_codes("sex", TEXT_GENDER), "weight": kg, "height": cm, "bmi": S.bmi(kg, cm),
        "apache_post_operative": (F.col("operative") == POST_OPERATIVE).cast("int"),
        **TEXT_COPIES,
        "apache_2_diagnosis": X.code_text("target_id"),
    }
    for end, side in (("min", "lowest"), ("max", "highest")):
        for stem, src in TEXT_PAIRS.items():
            fields[f"d1_{stem}_{end}"] = f"{src}_{side}"
        for stem, src in TEXT_PERCENT_PAIRS.items():
            fields[f"d1_{stem}_{end}"] = S.percent_or_null(S.to_number(f"{src}_{side}"))
    return fields


def text_extract(df: DataFrame, older: DataFrame, code_map: DataFrame, source: str) -> DataFrame:
    """Cohort, repaired text, two-step diagnosis lookup and header of a text registry.

    ``code_map`` has code, name, target_id, target_name and target_operative; a row with a null is ignored.
    """
    kept = text_cohort(text_prepare(df, older)).where(F.col("excluded") == 0)
    dx = code_map.select("code", "name", "target_id", "target_name", "target_operative")
    coded = J.two_step_lookup(kept, dx, ("apachecode", "code"), ("operative", "target_operative"), ["target_id"])
    return apply_field_map(coded, text_fields(source), header_schema())


# --- study layout --------------------------------------------------------------------------------
def study_fields(source: str) -> dict[str, Column | str | None]:
    return {
        "data_source": F.lit(source),
        "encounter_id": X.key_of("hosp_code", F.lit("_"), "medicalrecord", F.lit("_"), "admissionrecordid"),
        "patient_id": X.key_of("medicalrecord"), "country": F.lit(STUDY_COUNTRY),
        "hospital_bed_size": S.band(S.to_number("hospbeds"), BED_EDGES, BED_LABELS),
        "gender": S.map_codes("gender", STUDY_GENDER),
        "hospital_disch_location": S.map_codes("hospitaldestinationname", STUDY_HOSPITAL_DESTINATION),
        "icu_admit_source": S.map_codes("admissionsourcename", STUDY_ADMIT_SOURCE),
        "icu_disch_location": S.map_codes("unitdestinationname", STUDY_UNIT_DESTINATION),
        "elective_surgery": S.map_codes("admissiontypename", STUDY_ADMIT_TYPE),
        # the study took no readmissions
        "readmission_status": F.lit(0), **STUDY_COPIES,
    }


def study_extract(df: DataFrame, source: str) -> DataFrame:
    return apply_field_map(df, study_fields(source), header_schema())


# --- relational layout -----------------------------------------------------------------------------
def relational_extract(visits: DataFrame, weights: DataFrame, patients: DataFrame, source: str,
                       swap_back: bool = False) -> DataFrame:
    """Visits with their weight record and patient row, mapped onto the header.

    The source joins a further table without using it; that join only multiplies rows and is left
    out. ``swap_back`` reads sodium from the sodium field instead of the field the source uses.
    """
    keys = ["tipodni", "dni", "fecing"]
    joined = visits.join(weights.select(*keys, "imc"), keys, "left").join(
        patients.select(F.col("dnitipo").alias("tipodni"), "dni", "altura", "peso"), ["tipodni", "dni"], "left")
    minerals = {"sodium_apache": "na"} if swap_back else RELATIONAL_AS_WRITTEN
    fields: dict[str, Column | str | None] = {
        "data_source": F.lit(source), "encounter_id": X.key_of(*keys), "patient_id": X.key_of("tipodni", "dni"),
        "country": F.lit(RELATIONAL_COUNTRY),
        "elective_surgery": S.is_true(F.col("patologia") == RELATIONAL_SURGICAL).cast("int"),
        "height": S.sentinel_null("altura", 0),
        "hospital_death": S.is_true(F.col("resultadoegresoh") == RELATIONAL_DIED).cast("int"),
        "icu_death": S.is_true(F.col("restrat") == RELATIONAL_UNIT_DIED).cast("int"),
        "hospital_los_days": S.to_number("fecegrh") - S.to_number("fecingh"),
        "pre_icu_los_days": S.to_number("fechaing") - S.to_number("fecingh"),
        "ventilated_apache": (F.col("frecresp") == 0).cast("int"),
        **RELATIONAL_COPIES, **minerals,
    }
    return apply_field_map(joined, fields, header_schema())
