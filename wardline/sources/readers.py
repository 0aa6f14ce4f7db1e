"""Readers. Every schema is explicit or all-text; nothing is inferred from the data."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import to_number
from ..operators.conform import fix_first_column, lower_columns
from ..registry import REGISTRY_SCHEMA, header_schema
from .folders import Files
from .ranged import GzipMembers
from .writers import MANIFEST, VERSIONS


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or a Parquet path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that ``writers.publish`` wrote; it stays the same however often the table is replaced."""
    files = Files(spark, path)
    manifest = json.loads(files.read(f"{path}/{MANIFEST}"))
    folder = f"{path}/{VERSIONS}/{manifest['version']}"
    there = files.sizes(folder)
    if any(there.get(n) != size for n, size in manifest["files"].items()):
        raise ValueError(f"files of version {manifest['version']} are missing or cut")
    return spark.read.schema(T.StructType.fromJson(manifest["schema"])).parquet(folder)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
              partitions: int, **options) -> DataFrame:
    """A database table in parallel key ranges; ``table`` may be a parenthesised query."""
    return (
        spark.read.format("jdbc").options(url=url, dbtable=table, **options)
        .option("partitionColumn", column).option("lowerBound", lower).option("upperBound", upper)
        .option("numPartitions", partitions).load()
    )


def read_csv_text(spark: SparkSession, path: str, first_column: str | None = None,
                  sep: str = ",", partitions: int | None = None, multi_line: bool = False) -> DataFrame:
    """A CSV with a header, every column as text and lower-cased names.

    Gzip files arrive as one split each; ``partitions`` spreads them again. ``multi_line`` reads quoted line
    breaks as part of a value, at the price of one task per file.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
    df = reader.option("multiLine", multi_line).csv(path)
    df = lower_columns(df)
    if first_column:
        df = fix_first_column(df, first_column)
    return df.repartition(partitions) if partitions else df


def read_members(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """A gzip file written with an index, one task per member; only the columns of ``schema`` are parsed."""
    spark.dataSource.register(GzipMembers)
    pushed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    reader = spark.read.format(GzipMembers.name()).option("pushdown", pushed)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_registry_csv(spark: SparkSession, path: str, numeric: list[str] | None = None,
                      first_column: str | None = None, partitions: int | None = None, multi_line: bool = False) -> DataFrame:
    """A flat registry: text columns, with the listed ones turned into numbers (bad text is null)."""
    df = read_csv_text(spark, path, first_column, partitions=partitions, multi_line=multi_line)
    wanted = set(numeric or [])
    return df.select(*[to_number(f"`{c}`").alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns])


def read_map(spark: SparkSession, path: str, numbers: list[str] | None = None) -> DataFrame:
    """A code map; codes stay text so that '101.01' keeps its shape."""
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    wanted = set(numbers or [])
    return df.select(*[to_number(f"`{c}`").alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns])


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """A headerless two-column code dictionary."""
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("description", T.StringType())])
    return spark.read.schema(schema).option("quote", '"').csv(path)


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Ordered column names, one per line (a few hundred names)."""
    return [r.value for r in spark.read.text(path, wholetext=False).coalesce(1).collect() if r.value]


def read_extract(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """A harmonised extract written by ``write_csv``; diagnosis codes stay text."""
    return spark.read.schema(header_schema(names)).option("header", True).csv(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The variable registry from YAML (where a YAML parser is installed) or JSON."""
    text = "\n".join(r.value for r in spark.read.text(path).coalesce(1).collect())
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as exc:
            raise ImportError("reading a YAML registry needs PyYAML; convert it to JSON instead") from exc
        records = yaml.safe_load(text)
    else:
        records = json.loads(text)
    return spark.createDataFrame([_record(n, r) for n, r in records.items()], REGISTRY_SCHEMA)


def _record(name: str, rec: dict) -> tuple:
    def text(v):
        if isinstance(v, bool):
            return "Yes" if v else "No"
        return None if v in (None, "None") else str(v)

    rng = rec.get("permissibleRange") or {}
    coded = rng.get("coded")
    coded = [str(c) for c in coded] if isinstance(coded, list) else None
    span = (coded, text(rng.get("low")), text(rng.get("high")), text(rng.get("note")))
    return (name, rec.get("category"), text(rec.get("description")), rec.get("dataType"), text(rec.get("example")),
            text(rec.get("unitofmeasure")), span, text(rec.get("snomed")), text(rec.get("imputation")),
            text(rec.get("prediction")), text(rec.get("outcome")))
