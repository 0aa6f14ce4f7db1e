"""Cohort flags and attrition."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import is_true
from .ordered import first_row


def flag_exclusions(df: DataFrame, rules: dict[str, Column], out: str = "excluded") -> DataFrame:
    """A 0/1 column per exclusion (unknown counts as not excluded) and one for any of them."""
    flags = {name: is_true(cond).cast("int") for name, cond in rules.items()}
    any_flag = reduce(or_, [is_true(c) for c in rules.values()]).cast("int")
    return df.select("*", *[c.alias(n) for n, c in flags.items()], any_flag.alias(out))


def attrition(df: DataFrame, flags: list[str]) -> DataFrame:
    """Rows and percent removed per flag, plus the initial and final size, in one pass."""
    n = F.count(F.lit(1))
    excluded = reduce(or_, [F.col(f) == 1 for f in flags])
    aggs = [n.alias("initial")]
    aggs += [F.sum(f).cast("long").alias(f) for f in flags]
    aggs += [F.sum((~excluded).cast("long")).alias("final")]
    wide = df.agg(*aggs)
    names = ["initial", *flags, "final"]
    pairs = ", ".join(f"'{c}', `{c}`, 100.0D * `{c}` / initial" for c in names)
    return wide.selectExpr(f"stack({len(names)}, {pairs}) as (step, n, percent)")


def first_stay(df: DataFrame, patient: list[str], order: list[Column], take: list[str]) -> DataFrame:
    """The first stay per patient."""
    return first_row(df, patient, order, take)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Every column of the first row per key."""
    rest = [c for c in df.columns if c not in keys]
    return first_row(df, keys, order, rest).select(*df.columns)
