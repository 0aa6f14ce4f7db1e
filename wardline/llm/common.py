"""Helpers the operators share: written intermediate tables, Arrow slicing, one row of several equal ones."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.folders import Files

#: Text bytes that Python holds as objects at once; a longer single text is still handled whole.
CHUNK_BYTES = 1 << 20
#: The setting by which Spark removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The characters that separate words and that exact dedup deletes.
BLANKS = " \t\n\x0b\x0c\r"
#: The folder of the innermost ``scratch`` block.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; a temporary one only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="wardline-shared-")
    spark.sparkContext.setCheckpointDir(f"file://{folder}")
    return f"file://{folder}"


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session has ended
        Files(spark, path).remove(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables written inside the block go when it ends. What it yields writes a table that stays, as ``written`` does outside.

    No frame that is used after the block may read a table of the block.
    """
    outer = _SCRATCH.get()
    folder = f"{outer or shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
    token = _SCRATCH.set(folder)
    try:
        yield lambda df, name: _written(df, name, outer)
    finally:
        _SCRATCH.reset(token)
        _remove(spark, folder)


class _Reader:
    """Held by the frames that read a table."""


def drop_with(frames: list[DataFrame], table: DataFrame) -> None:
    """Remove the files of ``table``, as ``written`` returned it, once none of ``frames``, the last to read it, is referenced any more."""
    path = getattr(table, "written_to", None)
    if path is None:
        return
    reader = _Reader()
    weakref.finalize(reader, _remove, table.sparkSession, path).atexit = False
    for frame in frames:
        frame.reader = reader


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet to the shared folder and read again.

    This cuts the lineage and outlives lost executors. The files stay until the folder is cleaned, since
    the frames built on them are lazy, or until the end of the ``scratch`` block around. The shuffle files of the step go as soon
    as it is written: nothing reads them again, and else they stay until the driver happens to collect its garbage.
    """
    return _written(df, name, _SCRATCH.get())


def _written(df: DataFrame, name: str, folder: str | None) -> DataFrame:
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def text_of(column: str | Column = "text") -> Column:
    """A text column as string, null as empty."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that the bytes of ``column`` stay near ``size`` (one row at least)."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        lengths = pa.compute.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def one_of_equal(rows: DataFrame, repeats: str, key: list[str]) -> DataFrame:
    """Rows with ``repeats`` > 1 reduced to one per ``key``; the others pass without a shuffle."""
    once, more = rows.where(F.col(repeats) == 1), rows.where(F.col(repeats) > 1)
    return once.unionByName(more.dropDuplicates(key))
