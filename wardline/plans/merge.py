"""Stacking the sources, and the profile of the merged table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import profile as PR
from ..operators.conform import overwrite_where, stack, unify_tags
from ..registry import category_rank, registry_frame, variables
from .diagnosis import body_systems

# --- fixed values -------------------------------------------------------------------------
TOP_CODED_AGE = 91.4
IMPOSSIBLE_AGE = 150
GLUCOSE_LIMIT = 2000
GLUCOSE_BINS = 100
TABLE_ONE_LEVELS = ("elective_surgery", "gender", "hospital_death", "icu_death", "pregnant", "readmission_status", "smoking_status",
                    "teaching_hospital")
TABLE_ONE_NUMBERS = ("age", "height", "hospital_los_days", "icu_los_days", "pre_icu_los_days", "weight")
SKIPPED_IN_PROFILE = ("data_source", "hospital_bed_size_numeric", "icu_admit_type")
# ------------------------------------------------------------------------------------------


def merge(extracts: list[DataFrame], three_to_two: DataFrame, two: DataFrame,
          tags: dict[str, list[str]] | None = None) -> DataFrame:
    """All sources in one table, with unified source tags and both body systems."""
    out = stack(extracts)
    for new, old in (tags or {}).items():
        out = unify_tags(out, "data_source", old, new)
    return body_systems(out, three_to_two, two)


def top_code_age(df: DataFrame, source: str, age: float = TOP_CODED_AGE) -> DataFrame:
    cond = (F.col("age") > IMPOSSIBLE_AGE) & (F.col("data_source") == source)
    return overwrite_where(df, "age", cond, age)


def completion_table(df: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Completeness per variable and source with category and unit, in printing order."""
    names = [n for n, *_ in variables() if n in df.columns and n not in SKIPPED_IN_PROFILE]
    table = PR.completion(df, names, "data_source")
    reg = registry if registry is not None else registry_frame(df.sparkSession)
    return (
        table.join(reg.select(F.col("varname").alias("variable"), "category", "unitofmeasure"), "variable")
        .orderBy(category_rank().asc_nulls_last(), "variable", "data_source")
    )


def availability_table(df: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Which variables a source lacks altogether, with category and unit, in printing order."""
    names = [n for n, *_ in variables() if n in df.columns and n not in SKIPPED_IN_PROFILE]
    table = PR.availability(df, names, "data_source")
    reg = registry if registry is not None else registry_frame(df.sparkSession)
    return (
        table.join(reg.select(F.col("varname").alias("variable"), "category", "unitofmeasure"), "variable")
        .orderBy(category_rank().asc_nulls_last(), "variable", "data_source")
    )


def demographics_table(df: DataFrame) -> DataFrame:
    """Table 1 of the merged sources."""
    return PR.table_one(df, "data_source", list(TABLE_ONE_LEVELS), list(TABLE_ONE_NUMBERS))


def glucose_histogram(df: DataFrame) -> DataFrame:
    """Distribution of the scored glucose by source, impossible values left out."""
    return PR.histogram(df, "glucose_apache", 0.0, float(GLUCOSE_LIMIT), GLUCOSE_BINS, ["data_source"])
