"""Registry of checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardline.sources.readers import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
COVERS: dict[str, str] = {}


def check(name: str, covers: str, sql: str | None = None):
    """Register a query under ``name`` with the operator ids it covers and its SQL counterpart."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        COVERS[name] = covers
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


class Tables:
    """Attribute access to the Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self._spark, f"{self._folder}/{name}.parquet")
