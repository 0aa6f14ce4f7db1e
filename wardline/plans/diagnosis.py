"""Diagnosis codes: from admission text to score codes, operative status and body system.

Maps are small tables; see ``sources.readers.read_map``. ``three_to_two`` has one row per main
code with apache_3j_operative, apache_3j_diagnosis, apache_3j_bodysystem and apache_2_diagnosis.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import is_true
from ..functions.text import main_code
from ..operators.joins import code_bridge, lookup

POST_OPERATIVE = "Post-operative"


def enrich(df: DataFrame, text_map: DataFrame, three_to_two: DataFrame, text: str = "admitdiagnosis") -> DataFrame:
    """Add apache_3j_diagnosis, apache_2_diagnosis and apache_post_operative to a stay table."""
    coded = lookup(df, text_map, {text: text}, {"code": "apache_3j_diagnosis"})
    main = coded.withColumn("__main", main_code("apache_3j_diagnosis"))
    full = lookup(main, three_to_two, {"__main": "apache_3j_diagnosis"},
                  {"apache_3j_operative": "__op", "apache_2_diagnosis": "apache_2_diagnosis"})
    flag = is_true(F.col("__op") == POST_OPERATIVE).cast("int").alias("apache_post_operative")
    return full.select(*coded.columns, "apache_2_diagnosis", flag)


def operative_status(df: DataFrame, text_map: DataFrame, code: str = "ap3diag") -> DataFrame:
    """Post-operative flag by main code, for sources that already record the code."""
    bridge = code_bridge(text_map, "code", "post-operative")
    return lookup(df, bridge, {code: "code"}, {"post-operative": "post-operative"})


def body_systems(df: DataFrame, three_to_two: DataFrame, two: DataFrame) -> DataFrame:
    """Add the body system of both score generations to the merged table."""
    main = df.withColumn("__main", main_code("apache_3j_diagnosis"))
    with3 = lookup(main, three_to_two, {"__main": "apache_3j_diagnosis"},
                   {"apache_3j_bodysystem": "apache_3j_bodysystem"}).drop("__main")
    defs = two.select("apache_2_diagnosis", "apache_2_bodysystem",
                      is_true(F.col("apache_2_operative") == POST_OPERATIVE).cast("int").alias("op"))
    return lookup(with3, defs, {"apache_2_diagnosis": "apache_2_diagnosis", "apache_post_operative": "op"},
                  {"apache_2_bodysystem": "apache_2_bodysystem"})
