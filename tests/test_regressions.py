"""Wrong answers of earlier rounds stay mended."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the checks
from checks import base
from wardline.functions import scalars as S
from wardline.operators import ordered as O
from wardline.operators import profile as PR
from wardline.plans import flat
from wardline.sources import writers

DATA = "/root/testdata/sf0.001"


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.sql("select timestamp_ntz'2024-03-10 01:00:00' a, timestamp_ntz'2024-03-10 04:00:00' b, timestamp_ntz'1969-12-31 23:59:59.5' c").select(
            S.elapsed("a", "b", "hours").alias("h"), S.seconds("c").alias("s"), S.micros("c").alias("m"),
            (O.time_cell("b", 3600) - O.time_cell("a", 3600)).alias("cells")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (3.0, -1, -500_000, 3)


def test_null_group_keeps_its_quantiles(rows):
    df = rows("g string, x double", [(None, 1.0), (None, 3.0), ("a", 5.0)])
    got = {r.g: (r.n, r.p5, r.median, r.p95) for r in PR.describe_by(df, "g", "x").collect()}
    assert got[None] == pytest.approx((2, 1.1, 2.0, 2.9)) and got["a"] == (1, 5.0, 5.0, 5.0)


def test_descending_tells_big_ids_apart(rows):
    df = rows("k long, a long", [(1, 9007199254740992), (1, 9007199254740993)])
    assert O.first_row(df, ["k"], [O.descending("a")], ["a"]).first().a == 9007199254740993


def test_first_stay_of_one_time_is_defined(spark):
    data = [(1, 1, "2014-01-01", "2014-01-09", x, 0) for x in (3, 1, 2)]
    df = spark.createDataFrame(data, "patientid int, site_id int, icu_ad_dtm string, hosp_ds_dtm string, x int, excluded int")
    for part in (df, df.orderBy("x"), df.orderBy(F.desc("x"))):
        assert [r.x for r in flat.coded_first_stays(part).collect()] == [1]


def test_reuse_needs_a_folder(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    with pytest.raises(ValueError, match="checkpoint"):
        writers.reuse(spark.range(1))


def test_correlation_skips_unknown_pairs(rows):
    df = rows("a double, b double, c double", [(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.5, 0.0), (None, 1.0, 5.0)])
    got = {(r.a, r.b): r.r for r in PR.correlation(df, ["a", "b", "c"]).collect()}
    want = df.toPandas().corr()
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert all(abs(got[x, y] - want.loc[x, y]) < 1e-9 for x, y in got)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_building_a_plan_starts_no_job(spark, monkeypatch):
    """Apart from the modelling queries, which fit while they build, and the sinks, which write files."""
    names = [n for n in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()]
    loaded = {n: spark.read.parquet(f"{DATA}/{n}.parquet") for n in names}
    monkeypatch.setattr(base.Tables, "__getattr__", lambda self, name: loaded[name])
    eager = []
    for name, fn in base.QUERIES.items():
        if "ML" in base.COVERS[name] or fn.__module__ == "checks.transfer":
            continue
        spark.sparkContext.setJobGroup(f"build {name}", name)
        fn(spark, DATA)
        if spark.sparkContext.statusTracker().getJobIdsForGroup(f"build {name}"):
            eager.append(name)
    spark.sparkContext.setJobGroup("other", "other")
    assert not eager


def test_quoted_line_breaks_stay_in_one_value(spark, tmp_path):
    from wardline.sources.readers import read_registry_csv

    (tmp_path / "r.csv").write_text('id,Note,x\n1,"two\nlines",3\n2,one,4\n')
    got = read_registry_csv(spark, str(tmp_path / "r.csv"), numeric=["x"], multi_line=True).orderBy("id").collect()
    assert [(r.id, r.note, r.x) for r in got] == [("1", "two\nlines", 3.0), ("2", "one", 4.0)]


def test_a_sieve_keeps_every_wanted_row(spark, rows):
    from wardline.operators import joins as J

    many = spark.range(20_000).selectExpr("case when id % 9 > 0 then id % 5000 end as k", "id as v")
    wanted = spark.range(0, 5000, 50).selectExpr("case when id > 0 then id end as k")
    for bits in (16, 20):
        some = J.sieved(many, "k", wanted, bits)
        assert sorted(some.join(wanted, "k").collect()) == sorted(many.join(wanted, "k").collect())
        assert some.count() < 1000 and some.where("k is null").isEmpty()
    assert J.sieved(many, "k", wanted.limit(0), 16).isEmpty()
    with pytest.raises(ValueError):
        J.sieved(many, "k", wanted.selectExpr("cast(k as int) as k"))
