"""Writers."""

from __future__ import annotations

import gzip
import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .folders import Files
from .ranged import INDEX

#: Names inside a published table: the manifest that readers follow, and the folder of versions.
MANIFEST, VERSIONS = "_manifest.json", "versions"


def publish(df: DataFrame, path: str, keep: int = 2) -> str:
    """Replace the table at ``path`` by ``df`` in one step, and return the name of the new version.

    The rows are written as a version of their own. When all of them are there, a manifest that names the version, its
    files with their sizes and its schema takes the place of the old manifest by a rename. Readers follow the manifest, so they
    see the old table or the new one, never a part; a write that fails leaves the old one, and ``df`` may read the table it
    replaces. The newest ``keep`` versions stay for readers that are still at work, older ones go.
    """
    spark = df.sparkSession
    files, version = Files(spark, path), uuid.uuid4().hex
    folder = f"{path}/{VERSIONS}/{version}"
    earlier = json.loads(files.read(f"{path}/{MANIFEST}")) if files.exists(f"{path}/{MANIFEST}") else {"history": []}
    try:
        df.write.mode("errorifexists").parquet(folder)
    except Exception:
        files.remove(folder)
        raise
    history = [version, *earlier["history"]][:max(1, keep)]
    parts = {n: size for n, size in files.sizes(folder).items() if n.endswith(".parquet")}
    manifest = {"version": version, "history": history, "files": parts, "schema": df.schema.jsonValue()}
    staged = f"{path}/_staged-{version}"
    files.write(staged, json.dumps(manifest).encode())
    files.swap(staged, f"{path}/{MANIFEST}")
    for old in set(earlier["history"]) - set(history):
        files.remove(f"{path}/{VERSIONS}/{old}")
    return version


def write_single_csv(df: DataFrame, path: str, order: list[str], partitions: int | None = None, index: bool = False) -> None:
    """One gzip CSV file at ``path`` with a header and the rows in ``order``.

    The rows are dealt by range and sorted in parallel, and every part is compressed where it lies. A gzip file may
    consist of several members, so the file is the header's member and the parts' after it: their bytes are put together as a stream,
    no task holds the rows, and whatever reads gzip reads them all. ``index`` also writes where each part lies and between which
    values of the first order column, for ``ranged.GzipMembers``; it costs a second reading of the parts.
    """
    spark = df.sparkSession
    files, staged = Files(spark, path), f"{path}.parts-{uuid.uuid4().hex}"
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{c}`") for c in order]
    ranged = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    try:
        ranged.write.option("header", False).option("compression", "gzip").option("escape", chr(34)).csv(staged)
        header = ",".join('"' + c.replace('"', '""') + '"' if set(c) & set(',"\n') else c for c in df.columns) + "\n"
        files.write(f"{staged}/_header.gz", gzip.compress(header.encode()))
        names = [f"{staged}/{n}" for n in files.list(staged) if n.startswith("part-")]
        if index:
            files.write(f"{staged}/_index", json.dumps(_member_index(df, staged, order[0], files)).encode())
        files.append_streams([f"{staged}/_header.gz", *names], f"{staged}/_whole.gz")
        files.swap(f"{staged}/_whole.gz", path)
        if index:
            files.swap(f"{staged}/_index", path + INDEX)
    finally:
        files.remove(staged)


def _member_index(df: DataFrame, staged: str, first: str, files: Files) -> dict:
    """Offset, length, rows and bounds of the first order column (if it is a number) of every part, in their order."""
    number = isinstance(df.schema[first].dataType, T.NumericType)
    read = df.sparkSession.read.schema(df.schema).option("escape", '"').csv(staged)
    bound = [(F.col(f"`{first}`") if number else F.lit(None)).cast("double" if number else "string")] * 2
    found = {r.name: r for r in read.groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(bound[0]).alias("low"), F.max(bound[1]).alias("high")).collect()}
    sizes, offset, members = files.sizes(staged), files.sizes(staged)["_header.gz"], []
    for name in sorted(n for n in sizes if n.startswith("part-")):
        r = found.get(name)
        members.append({"offset": offset, "length": sizes[name], "rows": r.rows if r else 0, "low": r.low if r else None, "high": r.high if r else None})
        offset += sizes[name]
    return {"columns": df.columns, "ordered_by": first, "members": members}


def replace_table(df: DataFrame, name: str) -> None:
    """Create or replace a catalog table from a frame."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def write_parquet(df: DataFrame, path: str, sort_by: list[str] | None = None) -> None:
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    out.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, gzip: bool = True) -> None:
    """CSV with a header in parallel part files."""
    df.write.mode("overwrite").option("header", True).option(
        "compression", "gzip" if gzip else "none").csv(path)


def write_by_category(table: DataFrame, path: str, category: str = "category") -> None:
    """One CSV folder per category of a completion table."""
    table.write.mode("overwrite").option("header", True).partitionBy(category).csv(path)


def reuse(df: DataFrame, checkpoint_dir: str | None = None) -> DataFrame:
    """Compute a frame now, once, and go on from its checkpoint.

    The folder comes from ``spark.checkpoint.dir``; ``checkpoint_dir`` is used only where the session names
    none, and without either this is an error. The checkpoint outlives executors if the folder is shared.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set and no folder was given")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
