"""Clinical-shaped tables derived from the driver tables, in Spark and as SQL text.

Stays come from ``part`` (minute-offset stays from ``supplier``) and observations from every row
of ``lineitem``, so the work grows with the data. All formulas are plain integer and float
arithmetic that both engines evaluate alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Tables

BASE = "2020-01-01 00:00:00"
MIX = "(l_orderkey * 7 + l_suppkey * 13 + l_linenumber * 29)"
PICK = "(l_orderkey + l_suppkey * 3 + l_linenumber * 5)"
FREE_MINUTES = f"({MIX} % 1980 - 180)"
SLOT_MINUTES = "(((l_orderkey * 7 + l_suppkey * 13) % 11) * 150 - 60)"
ERROR = "case when l_orderkey % 17 = 0 then 1 when l_orderkey % 3 = 0 then 0 end"


def spark_time(hours: str, minutes: str = "0") -> str:
    return f"timestamp_ntz'{BASE}' + make_dt_interval(0, cast({hours} as int), cast({minutes} as int), 0)"


def duck_time(hours: str, minutes: str = "0") -> str:
    return f"timestamp '{BASE}' + to_hours(cast({hours} as integer)) + to_minutes(cast({minutes} as bigint))"


def admit(key: str) -> str:
    return f"(({key} * 37) % 5000)"


# --- absolute-time stays ----------------------------------------------------------------------
def stays(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "p_partkey as icustay_id", "p_partkey - p_partkey % 2 as hadm_id", "p_partkey - p_partkey % 6 as subject_id",
        f"{spark_time(admit('p_partkey'))} as intime",
        f"{spark_time(admit('p_partkey') + ' + 2 + p_partkey % 60')} as outtime")


STAYS = f"""stays as (select p_partkey as icustay_id, p_partkey - p_partkey % 2 as hadm_id,
  p_partkey - p_partkey % 6 as subject_id, {duck_time(admit('p_partkey'))} as intime,
  {duck_time(admit('p_partkey') + ' + 2 + p_partkey % 60')} as outtime from part)"""

KEYS = {"icustay_id": "l_partkey", "hadm_id": "l_partkey - l_partkey % 2", "subject_id": "l_partkey - l_partkey % 6"}


def observations(t: Tables, keys: list[str], items: list, valuenum: str, value: str = "cast(null as string)",
                 minutes: str = FREE_MINUTES) -> DataFrame:
    """Event rows keyed by the wanted ids; ``valuenum`` and ``value`` may use ``itemid``."""
    listed = ", ".join(str(i) for i in items)
    base = t.lineitem.selectExpr(
        "*", *[f"{KEYS[k]} as {k}" for k in keys], f"array({listed})[cast({PICK} % {len(items)} as int)] as itemid",
        f"{spark_time(admit('l_partkey'), minutes)} as charttime")
    return base.selectExpr(*keys, "itemid", "charttime", f"cast({valuenum} as double) as valuenum", f"{value} as value",
                           f"{ERROR} as error")


def observations_sql(name: str, keys: list[str], items: list, valuenum: str, value: str = "cast(null as varchar)",
                     minutes: str = FREE_MINUTES) -> str:
    listed = ", ".join(str(i) for i in items)
    ids = ", ".join(f"{KEYS[k]} as {k}" for k in keys)
    return f"""{name} as (select {', '.join(keys)}, itemid, charttime, cast({valuenum} as double) as valuenum, {value} as value,
  {ERROR} as error from (select *, {ids}, list_extract([{listed}], cast({PICK} % {len(items)} as integer) + 1) as itemid,
  {duck_time(admit('l_partkey'), minutes)} as charttime from lineitem))"""


# --- offset-time ---------------------------------------------------------------------------------
LAB_SLOT = "(((l_orderkey * 7 + l_partkey * 13) % 25) * 72 - 120)"
OFFSET = "((l_orderkey * 7 + l_partkey * 13 + l_linenumber * 31) % 1700 - 120)"


def offset_labs(t: Tables, names: list[str], result: str) -> DataFrame:
    listed = ", ".join(f"'{n}'" for n in names)
    base = t.lineitem.selectExpr("*", f"array({listed})[cast({PICK} % {len(names)} as int)] as labname")
    return base.selectExpr("l_suppkey as patientunitstayid", "labname", f"{LAB_SLOT} as labresultoffset",
                           f"case when l_orderkey % 29 <> 0 then {LAB_SLOT} + (l_linenumber % 3) * 10 end as labresultrevisedoffset",
                           f"cast({result} as double) as labresult")


def offset_labs_sql(name: str, names: list[str], result: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"""{name} as (select l_suppkey as patientunitstayid, labname, {LAB_SLOT} as labresultoffset,
  case when l_orderkey % 29 <> 0 then {LAB_SLOT} + (l_linenumber % 3) * 10 end as labresultrevisedoffset,
  cast({result} as double) as labresult from (select *, list_extract([{listed}], cast({PICK} % {len(names)} as integer) + 1) as labname from lineitem))"""


def null_columns(df: DataFrame, names: list[str], kind: str = "double") -> DataFrame:
    """Add typed null columns for source fields a shape does not fill."""
    extra = [F.lit(None).cast(kind).alias(n) for n in names if n not in df.columns]
    return df.select("*", *extra)
