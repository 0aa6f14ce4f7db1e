"""Reading one gzip export in ranges, as a Spark data source.

A gzip file is one split to Spark, so one task reads all of it. ``writers.write_single_csv`` puts its file together from
members that were compressed apart, and keeps an index of them beside it: where each begins, how long it is, how many rows it
has and between which values of the first order column they lie. This source plans one partition per member; a task opens the file at
its member and reads no other byte. Comparisons with the first order column are pushed down and leave out the members
that cannot hold a match; Spark still applies every filter. Only the columns of the schema are parsed.

    spark.dataSource.register(GzipMembers)
    spark.read.format("gzip_members").schema("o_orderkey long, o_orderstatus string").load(path)

Filters are pushed with the option ``pushdown``, which needs ``spark.sql.python.filterPushdown.enabled``
(``readers.read_members`` sets the one where it finds the other). Paths are opened by ``pyarrow.fs`` on the executors.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

# Executors get the source by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

INDEX = ".index.json"


def _open(path: str):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(name)


def read_index(path: str) -> dict:
    with _open(path + INDEX) as f:
        return json.loads(f.read())


@dataclass
class Member(InputPartition):
    offset: int
    length: int


class GzipMembers(DataSource):
    """``path`` of a file with an index; ``line_breaks`` allows them inside quoted values, ``pushdown`` takes filters."""

    @classmethod
    def name(cls) -> str:
        return "gzip_members"

    def schema(self) -> T.StructType:
        """All columns of the file as text, where the reader names no schema."""
        return T.StructType([T.StructField(c, T.StringType()) for c in read_index(self.options["path"])["columns"]])

    def reader(self, schema: T.StructType) -> MemberReader:
        chosen = FilteringReader if self._set("pushdown") else MemberReader  # Spark wants no filters taken where pushing is off
        return chosen(self.options["path"], schema, self._set("line_breaks"))

    def _set(self, option: str) -> bool:
        return str(self.options.get(option, "false")).lower() == "true"


class MemberReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, line_breaks: bool):
        self.path, self.schema, self.line_breaks, self.index = path, schema, line_breaks, read_index(path)
        unknown = [f.name for f in schema if f.name not in self.index["columns"]]
        if unknown:
            raise ValueError(f"not in the file: {', '.join(unknown)}")
        self.low = self.high = None  # bounds of the first order column, both included

    def partitions(self) -> list[Member]:
        def wanted(m: dict) -> bool:
            if m["low"] is None:  # no known value of the column: no comparison is true
                return self.low is None and self.high is None
            return (self.low is None or m["high"] >= self.low) and (self.high is None or m["low"] <= self.high)

        return [Member(m["offset"], m["length"]) for m in self.index["members"] if m["rows"] and wanted(m)]

    def read(self, partition: Member) -> Iterator:
        import pyarrow as pa
        from pyarrow import csv

        kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
        wanted = {f.name: kinds[f.dataType.simpleString()] for f in self.schema}
        with _open(self.path) as f:
            stream = pa.CompressedInputStream(f.get_stream(partition.offset, partition.length), "gzip")
            yield from csv.open_csv(
                stream, read_options=csv.ReadOptions(column_names=self.index["columns"], use_threads=False),
                parse_options=csv.ParseOptions(newlines_in_values=self.line_breaks),
                convert_options=csv.ConvertOptions(include_columns=list(wanted), column_types=wanted, null_values=[""], strings_can_be_null=True,
                                                   quoted_strings_can_be_null=False))


class FilteringReader(MemberReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Narrow the members; every filter is left to Spark as well."""
        for f in filters:
            kind = next((x.dataType for x in self.schema if x.name == self.index["ordered_by"]), None)
            if not isinstance(kind, T.NumericType) or getattr(f, "attribute", None) != (self.index["ordered_by"],):
                yield f
                continue
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.low = f.value if self.low is None else max(self.low, f.value)
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                self.high = f.value if self.high is None else min(self.high, f.value)
            if isinstance(f, In) and f.value:
                self.low = min(f.value) if self.low is None else max(self.low, min(f.value))
                self.high = max(f.value) if self.high is None else min(self.high, max(f.value))
            yield f
