"""The variable registry: names, categories, units and types of the harmonised row.

Measures come in families, so their names are built by rule: window x measure x max/min.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------------------
CATEGORY_ORDER = {
    "identifier": 1,
    "demographic": 2,
    "APACHE covariate": 3,
    "vitals": 4,
    "labs": 5,
    "labs blood gas": 6,
    "APACHE prediction": 10,
}
WINDOWS = ("d1", "h1")

MMHG = "Millimetres of mercury"
VITALS = {
    "heartrate": "Beats per minute",
    "resprate": "Breaths per minute",
    "spo2": "Percentage",
    "temp": "Degrees Celsius",
    **{f"{bp}{how}": MMHG for bp in ("sysbp", "diasbp", "mbp") for how in ("_invasive", "_noninvasive", "")},
    **{f"{pa}_invasive": MMHG for pa in ("pasys", "padias", "pamean")},
}
LABS = {
    "albumin": "g/L",
    "bilirubin": "micromol/L",
    "bun": "mmol/L",
    "calcium": "mmol/L",
    "creatinine": "micromol/L",
    "glucose": "mmol/L",
    "inr": "micromol/L",
    "hco3": "mmol/L",
    "hematocrit": "Fraction",
    "hemaglobin": "g/dL",
    "lactate": "mmol/L",
    "platelets": "10^9/L",
    "potassium": "mmol/L",
    "sodium": "mmol/L",
    "wbc": "10^9/L",
}
GASES = {"arterial_ph": None, "arterial_po2": MMHG, "arterial_pco2": MMHG, "pao2fio2ratio": "Fraction"}

# name: (type, unit)
IDENTIFIERS = {
    "data_source": ("string", None),
    "encounter_id": ("integer", None),
    "patient_id": ("integer", None),
    "hospital_id": ("integer", None),
}
DEMOGRAPHICS = {
    "age": ("numeric", "Years"),
    "bmi": ("string", "kilograms/metres^2"),
    "country": ("string", None),
    "elective_surgery": ("binary", None),
    "ethnicity": ("string", None),
    "gender": ("string", None),
    "height": ("numeric", "centimetres"),
    "hospital_admit_source": ("string", None),
    "hospital_bed_size": ("string", None),
    "hospital_bed_size_numeric": ("string", None),
    "hospital_death": ("binary", None),
    "hospital_disch_location": ("string", None),
    "hospital_los_days": ("numeric", "Days"),
    "hospital_type": ("string", None),
    "icu_admit_source": ("string", None),
    "icu_admit_type": ("string", None),
    "icu_death": ("binary", None),
    "icu_disch_location": ("string", None),
    "icu_id": ("integer", None),
    "icu_los_days": ("numeric", "Days"),
    "icu_stay_type": ("string", None),
    "icu_type": ("string", None),
    "pre_icu_los_days": ("numeric", "Days"),
    "pregnant": ("binary", None),
    "readmission_status": ("binary", None),
    "smoking_status": ("string", None),
    "teaching_hospital": ("binary", None),
    "weight": ("numeric", "kilograms"),
}
APACHE_COVARIATES = {
    "albumin_apache": ("numeric", "g/L"),
    "apache_2_bodysystem": ("string", None),
    "apache_2_diagnosis": ("string", None),
    "apache_3j_bodysystem": ("string", None),
    "apache_3j_diagnosis": ("string", None),
    "apache_post_operative": ("binary", None),
    "arf_apache": ("binary", None),
    "bilirubin_apache": ("numeric", "micromol/L"),
    "bun_apache": ("numeric", "mmol/L"),
    "creatinine_apache": ("numeric", "micromol/L"),
    "fio2_apache": ("numeric", "Fraction"),
    "gcs_eyes_apache": ("integer", None),
    "gcs_motor_apache": ("integer", None),
    "gcs_unable_apache": ("binary", None),
    "gcs_verbal_apache": ("integer", None),
    "glucose_apache": ("numeric", "mmol/L"),
    "heart_rate_apache": ("numeric", "Beats per minute"),
    "hematocrit_apache": ("numeric", "Fraction"),
    "intubated_apache": ("binary", None),
    "map_apache": ("numeric", MMHG),
    "paco2_apache": ("numeric", MMHG),
    "paco2_for_ph_apache": ("numeric", MMHG),
    "pao2_apache": ("numeric", MMHG),
    "ph_apache": ("numeric", None),
    "resprate_apache": ("numeric", "Breaths per minute"),
    "sodium_apache": ("numeric", "mmol/L"),
    "temp_apache": ("numeric", "Degrees Celsius"),
    "urineoutput_apache": ("numeric", "Millilitres"),
    "ventilated_apache": ("binary", None),
    "wbc_apache": ("numeric", "10^9/L"),
}
PREDICTIONS = {
    "apache_3j_hospital_death_prob": ("numeric", None),
    "apache_3j_score": ("integer", None),
    "apache_4a_hospital_death_prob": ("numeric", None),
    "apache_4a_icu_death_prob": ("numeric", None),
    "apsiii": ("integer", None),
}
COMORBIDITIES = {
    name: ("binary", None)
    for name in ("aids", "cirrhosis", "diabetes_mellitus", "hepatic_failure", "immunosuppression",
                 "leukemia", "lymphoma", "solid_tumor_with_metastasis")
}
# added by the merge, so not part of the per-source header
MERGE_COLUMNS = ("apache_3j_bodysystem", "apache_2_bodysystem")
# columns that hold text whatever the registry calls them
TEXT_IDS = ("encounter_id", "patient_id", "hospital_id", "icu_id", "teaching_hospital", "pregnant")
# ------------------------------------------------------------------------------------------

REGISTRY_SCHEMA = T.StructType([
    T.StructField("varname", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("dataType", T.StringType()),
    T.StructField("example", T.StringType()),
    T.StructField("unitofmeasure", T.StringType()),
    T.StructField("permissibleRange", T.StructType([
        T.StructField("coded", T.ArrayType(T.StringType())),
        T.StructField("low", T.StringType()),
        T.StructField("high", T.StringType()),
        T.StructField("note", T.StringType()),
    ])),
    T.StructField("snomed", T.StringType()),
    T.StructField("imputation", T.StringType()),
    T.StructField("prediction", T.StringType()),
    T.StructField("outcome", T.StringType()),
])


def _family(names: dict[str, str | None], category: str) -> list[tuple]:
    return [
        (f"{w}_{name}_{end}", category, "numeric", unit)
        for w in WINDOWS for name, unit in names.items() for end in ("max", "min")
    ]


def variables() -> list[tuple[str, str, str, str | None]]:
    """(name, category, type, unit) of every variable."""
    def single(group, category):
        return [(n, category, kind, unit) for n, (kind, unit) in group.items()]

    return [
        *single(IDENTIFIERS, "identifier"),
        *single(DEMOGRAPHICS, "demographic"),
        *single(APACHE_COVARIATES, "APACHE covariate"),
        *_family(VITALS, "vitals"),
        *_family(LABS, "labs"),
        *_family(GASES, "labs blood gas"),
        *single(PREDICTIONS, "APACHE prediction"),
        *single(COMORBIDITIES, "APACHE comorbidity"),
    ]


def registry_frame(spark: SparkSession) -> DataFrame:
    rows = [(n, c, kind, unit) for n, c, kind, unit in variables()]
    return spark.createDataFrame(rows, "varname string, category string, dataType string, unitofmeasure string")


def category_rank(category: str = "category") -> Column:
    """Printing rank of a category; unlisted categories have none and sort last."""
    return F.create_map(*[F.lit(x) for kv in CATEGORY_ORDER.items() for x in kv])[F.col(category)]


def definitions(registry: DataFrame) -> DataFrame:
    """Registry in printing order: by category rank, then by name."""
    return registry.orderBy(category_rank().asc_nulls_last(), "varname")


def header_of(defs: DataFrame) -> DataFrame:
    return defs.where(F.col("varname").isNotNull()).select(F.lower("varname").alias("varname"))


def header() -> list[str]:
    """Ordered names of the per-source row."""
    rows = [(CATEGORY_ORDER.get(c, 99), n) for n, c, _, _ in variables() if n not in MERGE_COLUMNS]
    return [n for _, n in sorted(rows)]


def _spark_type(name: str, kind: str) -> T.DataType:
    if name == "bmi" or name == "hospital_bed_size_numeric":
        return T.DoubleType()
    if kind == "string" or name in TEXT_IDS:
        return T.StringType()
    return {"numeric": T.DoubleType(), "integer": T.DoubleType(), "binary": T.IntegerType()}[kind]


def header_schema(names: list[str] | None = None) -> T.StructType:
    """Typed schema of the per-source row, with category and unit as column metadata."""
    info = {n: (c, kind, unit) for n, c, kind, unit in variables()}
    fields = []
    for name in names or header():
        category, kind, unit = info.get(name, (None, "string", None))
        fields.append(T.StructField(name, _spark_type(name, kind), True,
                                    {"category": category or "", "unit": unit or ""}))
    return T.StructType(fields)


def numeric_columns() -> list[str]:
    """Columns filled by their mean when a model imputes; all others use the commonest value."""
    return [n for n, _, kind, _ in variables() if kind == "numeric" or n == "bmi"]
