"""Schema conformance: column names, the common header, stacking of sources."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM_MARKS = ("﻿", "ï»¿")


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def fix_first_column(df: DataFrame, name: str) -> DataFrame:
    """Repair a first column name that a byte-order mark was glued to."""
    first = df.columns[0]
    if name not in first:
        warnings.warn(f"first column is {first!r}, expected {name!r}", stacklevel=2)
        return df
    return df.withColumnRenamed(first, name)


def tag_source(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("data_source", F.lit(source))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns in its order; columns the frame lacks are typed nulls."""
    have = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema if f.name not in have]
    if missing:
        warnings.warn(f"not available in this source: {', '.join(missing)}", stacklevel=2)
    return df.selectExpr(*[_cast(have.get(f.name), f) for f in schema])


def _cast(source: str | None, field: T.StructField) -> str:
    value = "null" if source is None else f"`{source}`"
    return f"try_cast({value} as {field.dataType.simpleString()}) as `{field.name}`"


def apply_field_map(df: DataFrame, fields: dict, schema: T.StructType) -> DataFrame:
    """One select that builds the header from ``{target: None | column name | Column}``.

    A target that is absent from the map, mapped to ``None`` or mapped to a column the source
    lacks becomes a typed null.
    """
    computed, picked, unmapped, have = [], {}, [], set(df.columns)
    for field in schema:
        source = fields.get(field.name)
        if isinstance(source, Column):
            picked[field.name] = f"__{field.name}"
            computed.append(source.alias(f"__{field.name}"))
        elif source is not None and source.lower() in have:
            picked[field.name] = source.lower()
        elif source is not None or field.name not in fields:
            unmapped.append(field.name)
    if unmapped:
        warnings.warn(f"not found in this source: {', '.join(unmapped)}", stacklevel=2)
    return df.select("*", *computed).selectExpr(*[_cast(picked.get(f.name), f) for f in schema])


def stack(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; a column missing from a frame is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def overwrite_where(df: DataFrame, column: str, cond: Column, value) -> DataFrame:
    return df.withColumn(column, F.when(cond, F.lit(value)).otherwise(F.col(column)))


def unify_tags(df: DataFrame, column: str, old: list[str], new: str) -> DataFrame:
    return overwrite_where(df, column, F.col(column).isin(*old), new)


def restrict_names(registry: DataFrame, header: DataFrame, name: str) -> DataFrame:
    return registry.join(header.select(name), name, "left_semi")
