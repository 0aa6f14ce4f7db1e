"""Replacing tables, one gzip file, digest trees: whole results, and what is left when something fails."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from wardline.operators import joins as J
from wardline.sources import ranged
from wardline.sources import readers as RD
from wardline.sources import writers as WR
from wardline.sources.folders import Files, scratch_folder

from helpers import table


# --- publish --------------------------------------------------------------------------------
def test_a_published_table_may_read_itself(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    for n in range(4):
        old = RD.read_published(spark, path) if n else spark.createDataFrame([(0, "a")], "x int, s string")
        WR.publish(old.select((F.col("x") + 1).alias("x"), "s"), path)
    assert table(RD.read_published(spark, path)) == [(4, "a")]
    assert len(list((tmp_path / "t" / "versions").iterdir())) == 2  # the newest two


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    WR.publish(spark.range(100), path)
    before = (tmp_path / "t" / "_manifest.json").read_bytes()
    bad = spark.range(0, 100, numPartitions=4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        WR.publish(bad, path)  # three of four tasks write their part before the last one fails
    assert (tmp_path / "t" / "_manifest.json").read_bytes() == before
    assert RD.read_published(spark, path).count() == 100
    assert len(list((tmp_path / "t" / "versions").iterdir())) == 1
    assert not [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("_staged")]


def test_a_reader_keeps_the_version_it_opened(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    WR.publish(spark.range(3), path)
    reader = RD.read_published(spark, path)
    WR.publish(spark.range(7).withColumn("y", F.lit("new")), path)
    assert reader.count() == 3
    now = RD.read_published(spark, path)
    assert now.columns == ["id", "y"] and now.count() == 7


def test_a_version_with_missing_files_is_an_error(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    WR.publish(spark.range(0, 100, numPartitions=3), path)
    files = Files(spark, path)
    version = json.loads(files.read(f"{path}/_manifest.json"))["version"]
    part = next(n for n in files.list(f"{path}/versions/{version}") if n.endswith(".parquet"))
    files.remove(f"{path}/versions/{version}/{part}")
    with pytest.raises(ValueError, match="missing"):
        RD.read_published(spark, path)


def test_an_empty_table_is_published_with_its_columns(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    WR.publish(spark.range(5).where("id < 0"), path)
    assert RD.read_published(spark, path).columns == ["id"] and RD.read_published(spark, path).count() == 0


# --- one gzip file --------------------------------------------------------------------------
def test_single_file_is_ordered_and_has_one_header(spark, tmp_path):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 37 % 5000).alias("k"), F.concat(F.lit('q"'), F.col("id"), F.lit(", x")).alias("a,b"),
                                                      F.when(F.col("id") % 3 > 0, "").alias("e"))
    target = tmp_path / "one.csv.gz"
    WR.write_single_csv(df, f"file://{target}", ["k"], partitions=5)
    lines = gzip.open(target, "rt").read().split("\n")
    assert lines[0] == 'k,"a,b",e' and lines[-1] == "" and len(lines) == 5002
    assert [int(x.split(",")[0]) for x in lines[1:-1]] == list(range(5000))
    back = RD.read_csv_text(spark, f"file://{target}")
    assert back.columns == ["k", "a,b", "e"]
    assert back.count() == 5000
    assert {(r.k, r["a,b"]) for r in back.collect()} == {(str(r.k), r["a,b"]) for r in df.collect()}
    assert [p.name for p in tmp_path.iterdir()] == ["one.csv.gz"] or sorted(p.name for p in tmp_path.iterdir()) == [".one.csv.gz.crc", "one.csv.gz"]


def test_single_file_of_no_rows_is_its_header(spark, tmp_path):
    WR.write_single_csv(spark.range(3).where("id < 0"), f"file://{tmp_path}/e.csv.gz", ["id"])
    assert gzip.open(tmp_path / "e.csv.gz", "rt").read() == "id\n"


def test_single_file_replaces_an_older_one(spark, tmp_path):
    for n in (5, 3):
        WR.write_single_csv(spark.range(n), f"file://{tmp_path}/r.csv.gz", ["id"], partitions=2)
    assert RD.read_csv_text(spark, f"file://{tmp_path}/r.csv.gz").count() == 3


def test_scratch_folders_are_new_each_time(spark):
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")


# --- digest tree ----------------------------------------------------------------------------
@pytest.mark.parametrize("levels", [1, 2, 3])
def test_reconcile_with_changes_gaps_and_nulls(spark, levels):
    a = [(i, i % 7, None if i % 11 == 0 else f"s{i % 5}") for i in range(2000)] + [(None, 1, "x"), (None, None, None)]
    b = [(i, (i % 7) + (i == 1234), None if i in (5, 11) else t) for i, _, t in a[:2000] if i not in (77, 1999)] + [(None, 1, "x"), (9999, 1, "y")]
    schema = "k long, n long, t string"
    left, right = spark.createDataFrame(a, schema).repartition(4), spark.createDataFrame(b, schema).repartition(3)
    by_key = {r[0]: r for r in b if r[0] is not None}
    want = {c: sum((by_key.get(r[0]) or (None,) * 3)[i] == r[i] if r[0] is not None else r[i] is None for r in a) for i, c in ((1, "n"), (2, "t"))}
    got = {r.variable: (r.n_rows, r.n_match) for r in J.reconcile(left, right, "k", ["n", "t"], levels).collect()}
    assert got == {c: (len(a), m) for c, m in want.items()}
    wrong = {(r.k, r.t_a, r.t_b) for r in J.mismatches(left, right, "k", "t", levels).collect()}
    assert wrong == {(r[0], r[2], (by_key.get(r[0]) or (None,) * 3)[2]) for r in a if r[2] != (by_key.get(r[0]) or (None,) * 3)[2]}


def test_equal_ranges_are_not_joined(spark):
    a = spark.range(50_000).select("id", (F.col("id") * 3).alias("v"))
    b = a.withColumn("v", F.when(F.col("id").isin(17, 40_000), -1).otherwise(F.col("v")))
    found = J.differing_ranges(a, b, "id", ["v"], 2).collect()
    assert len(found) == 2 and sum(r.rows_a for r in found) < 10
    near, far, _ = J._differing_rows(a, b, "id", ["v"], 2)
    assert near.count() == far.count() == sum(r.rows_a for r in found)
    assert J.differing_ranges(a, a, "id", ["v"]).count() == 0
    assert {r.n_match for r in J.reconcile(a, a, "id", ["v"]).collect()} == {50_000}


def test_reconcile_of_empty_tables(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    none = a.where("false")
    assert [tuple(r) for r in J.reconcile(none, a, "k", ["v"]).collect()] == [(0, "v", 0)]
    assert [tuple(r) for r in J.reconcile(a, none, "k", ["v"]).collect()] == [(1, "v", 0)]


# --- ranges of one file ---------------------------------------------------------------------
def test_members_are_read_apart(spark, tmp_path):
    path = f"file://{tmp_path}/m.csv.gz"
    df = spark.range(0, 4000, numPartitions=3).select((F.col("id") * 3).alias("k"), F.concat(F.lit('a "b", '), F.col("id")).alias("t"),
                                                      F.when(F.col("id") % 4 > 0, F.col("id") / 8).alias("x"), F.lit("").alias("e"))
    WR.write_single_csv(df, path, ["k"], 8, index=True)
    index = ranged.read_index(path)
    assert sum(m["rows"] for m in index["members"]) == 4000 and len([m for m in index["members"] if m["rows"]]) >= 6
    got = RD.read_members(spark, path, "k long, x double, t string")
    assert got.rdd.getNumPartitions() == len([m for m in index["members"] if m["rows"]])
    assert {(r.k, r.x, r.t) for r in got.collect()} == {(r.k, r.x, r.t) for r in df.collect()} and got.count() == 4000
    whole = RD.read_members(spark, path)
    assert whole.columns == ["k", "t", "x", "e"] and whole.count() == 4000 and whole.first().e == ""
    assert RD.read_csv_text(spark, path).count() == 4000  # and it is still one gzip file


@pytest.mark.parametrize("where", ["k = 300", "k > 5000 and k <= 5100", "k in (3, 9)", "k < 0", "k >= 11997 and x is not null"])
def test_members_without_a_match_are_left_out(spark, tmp_path, where):
    path = f"file://{tmp_path}/m.csv.gz"
    df = spark.range(0, 4000).select((F.col("id") * 3).alias("k"), (F.col("id") / 8).alias("x"))
    WR.write_single_csv(df, path, ["k"], 8, index=True)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = RD.read_members(spark, path, "k long, x double").where(where)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.where(where).collect()))
        assert got.rdd.getNumPartitions() <= 3
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_members_name_unknown_columns(spark, tmp_path):
    path = f"file://{tmp_path}/m.csv.gz"
    WR.write_single_csv(spark.range(5), path, ["id"], 2, index=True)
    with pytest.raises(Exception, match="not in the file: other"):
        RD.read_members(spark, path, "id long, other string").count()
