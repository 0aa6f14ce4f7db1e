"""Cells found from the data, sweeps over spans and prefix totals, against brute force on hot, tied and null keys."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardline.operators import balanced as B
from wardline.operators import ordered as O
from wardline.operators import windows as W

HOUR = 3600


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    n = 3000
    key = np.where(rng.random(n) < 0.5, 1, rng.integers(2, 30, n)).astype(object)
    key[rng.random(n) < 0.03] = None
    x = rng.integers(0, 50, n).astype(object)
    x[(key == 1) & (rng.random(n) < 0.7)] = None  # most of the hot key has no order value
    return pd.DataFrame({"id": range(n), "key": key, "x": x, "w": rng.integers(0, 9, n)})


@pytest.fixture(scope="module")
def frame(spark, data):
    recs = [tuple(None if v is None else int(v) for v in r) for r in data.itertuples(index=False)]
    return spark.createDataFrame(recs, "id long, key long, x long, w long").repartition(5)


def ordered(data, *by):
    filled = data.assign(k=[-1 if v is None else v for v in data["key"]], o=[-1 if v is None else v for v in data["x"]])
    return filled.sort_values(["k", "o", *by])


@pytest.mark.parametrize("most,parts", [(10**6, 64), (100, 64), (40, 8), (1, 4096)])
def test_numbers_equal_plain_count(frame, data, most, parts):
    out = B.sequence(frame, ["key"], [F.col("x"), F.col("id")], most=most, parts=parts).toPandas().set_index("id")["seq"].sort_index()
    g = ordered(data, "id")
    want = pd.Series((g.groupby("k").cumcount() + 1).to_numpy(), index=g["id"]).sort_index()
    assert (out == want).all()


@pytest.mark.parametrize("most", [10**6, 20])
def test_ranks_with_ties_and_nulls(frame, data, most):
    out = B.sequence(frame, ["key"], [F.col("x")], "r", ties=True, most=most).toPandas().set_index("id")["r"].sort_index()
    g = ordered(data)
    want = pd.Series(g.groupby("k")["o"].rank(method="min").astype(int).to_numpy(), index=g["id"]).sort_index()
    assert (out == want).all()


def test_running_sums_over_coarse_cells(frame, data):
    out = B.running(frame, ["key"], [F.col("x"), F.col("id")], {"c": F.col("w"), "n": F.lit(1)},
                    F.coalesce(F.floor(F.col("x") / 10), F.lit(-1)), most=60, parts=16).toPandas().set_index("id").sort_index()
    g = ordered(data, "id")
    assert (out["c"] == pd.Series(g.groupby("k")["w"].cumsum().to_numpy(), index=g["id"]).sort_index()).all()
    assert (out["n"] == pd.Series((g.groupby("k").cumcount() + 1).to_numpy(), index=g["id"]).sort_index()).all()


@pytest.mark.parametrize("value", [None, 7])
def test_a_key_without_order_is_numbered_by_many_tasks(spark, value):
    n, most = 20000, 1000
    df = spark.range(n).select("id", F.lit(1).alias("key"), F.lit(value).cast("long").alias("x"))
    order = [F.col("x"), F.col("id")]
    sizes = [r["count"] for r in B.with_cells(df, ["key"], order, most=most).groupBy("__cell", "__part").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * most and len(sizes) >= n // most
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        out = B.sequence(df, ["key"], order, most=most)
        tasks = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
        assert out.where("seq <> id + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) >= 10 and max(r.n for r in tasks) <= n / 4


def test_rows_that_tie_in_full_keep_distinct_numbers(spark):
    df = spark.createDataFrame([(1, 5)] * 50 + [(1, None)] * 30, "key int, x int")
    got = sorted(r.seq for r in B.sequence(df, ["key"], [F.col("x")], most=10, parts=8).collect())
    assert got == list(range(1, 81))


@pytest.mark.parametrize("size", [0, 1, 2, 7, 8, 63])
def test_bound_index_is_the_number_of_lower_bounds(spark, size):
    bounds = sorted(range(10, 10 + 3 * size, 3))
    df = spark.range(0, 250).select("id", F.lit(bounds).cast("array<long>").alias("b") if size else F.array().cast("array<long>").alias("b"))
    for r in df.select("id", B.bound_index("b", F.col("id"), 64).alias("n")).collect():
        assert r.n == sum(b < r.id for b in bounds)


# --- spans ----------------------------------------------------------------------------------
def spans(rng, n, tag, span=40):
    out = []
    for i in range(n):
        lo = int(rng.integers(0, 200))
        out.append((None if rng.random() < 0.02 else int(rng.integers(0, 3)), f"{tag}{i % (n - 5)}", None if rng.random() < 0.02 else lo,
                    None if rng.random() < 0.02 else lo + int(rng.integers(-3, span))))
    return out + out[:5]


@pytest.mark.parametrize("most", [10**6, 15])
def test_span_pairs_equal_brute_force(spark, most):
    rng = np.random.default_rng(3)
    left, right = spans(rng, 120, "l"), spans(rng, 90, "r", 10)
    a, b = spark.createDataFrame(left, "k int, l string, a0 int, a1 int"), spark.createDataFrame(right, "k int, r string, b0 int, b1 int")
    got = W.span_overlap(a, b, ["k"], ("a0", "a1"), ("b0", "b1"), most)
    assert got.columns == ["k", "l", "a0", "a1", "r", "b0", "b1"]
    ok = lambda s: None not in (s[0], s[2], s[3]) and s[2] <= s[3]
    want = [(x[0], *x[1:], *y[1:]) for x in left if ok(x) for y in right if ok(y) and x[0] == y[0] and x[2] <= y[3] and y[2] <= x[3]]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 100


def test_a_key_with_many_spans_forms_only_its_pairs(spark):
    n = 100_000
    a = spark.range(n).select(F.lit(1).alias("k"), (F.col("id") * 10).alias("a0"), (F.col("id") * 10 + 4).alias("a1"))
    b = spark.range(n).select(F.lit(1).alias("k"), (F.col("id") * 10 + 4).alias("b0"), (F.col("id") * 10 + 9).alias("b1"))
    got = W.span_overlap(a, b, ["k"], ("a0", "a1"), ("b0", "b1"), most=5000)
    assert got.where("b0 = a1").count() == n == got.count()  # a plain join would form ten thousand million


def test_empty_sides_have_no_pairs(spark):
    a = spark.createDataFrame([(1, 0, 5)], "k int, a0 int, a1 int")
    b = a.toDF("k", "b0", "b1")
    assert W.span_overlap(a.where("false"), b, ["k"], ("a0", "a1"), ("b0", "b1")).count() == 0
    assert W.span_overlap(a, b.where("false"), ["k"], ("a0", "a1"), ("b0", "b1")).count() == 0


def test_overlap_flag_with_many_stays_per_key(spark):
    rng = np.random.default_rng(5)
    found = [(k, a, b) for k, _, a, b in spans(rng, 60, "s", 6)]
    stays = [(i, None if rng.random() < 0.05 else int(rng.integers(0, 4)), None if rng.random() < 0.05 else int(rng.integers(-5, 210))) for i in range(200)]
    out = W.overlap_flag(spark.createDataFrame(stays, "id int, k int, at int"), spark.createDataFrame(found, "k int, s int, e int"),
                         "k", "at", "s", "e", F.lit(2), "open", most=20)
    assert out.columns == ["id", "k", "at", "open"]
    for r in out.collect():
        want = any(None not in (k, s, e, r.at) and k == r.k and s - 2 <= r.at <= e for k, s, e in found)
        assert r.open == int(want)


# --- totals before --------------------------------------------------------------------------
@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("width", [HOUR, 7 * 86400])
def test_totals_before_equal_brute_force(rows, closed, width):
    rng = np.random.default_rng(8)
    start = pd.Timestamp("2021-03-01")
    when = lambda: None if rng.random() < 0.05 else str(start + pd.Timedelta(hours=int(rng.integers(0, 300))))
    key = lambda: None if rng.random() < 0.05 else int(rng.integers(0, 4))
    left = [(i, key(), when()) for i in range(120)]
    events = [(key(), when(), None if rng.random() < 0.2 else float(rng.integers(0, 9)), i) for i in range(150)]
    out = O.totals_before(rows("id int, k int, at timestamp", left), ["k"], "at", rows("k int, t timestamp, v double, n int", events), "t",
                          {"total": F.col("v"), "seen": F.lit(1)}, {"most": F.col("v"), "last": F.struct("t", "n")}, closed, width)
    got = {r.id: r for r in out.collect()}
    assert len(got) == len(left)
    for i, k, at in left:
        own = [e for e in events if None not in (k, at, e[0], e[1]) and e[0] == k
               and (pd.Timestamp(e[1]) <= pd.Timestamp(at) if closed else pd.Timestamp(e[1]) < pd.Timestamp(at))]
        values = [e[2] for e in own if e[2] is not None]
        r = got[i]
        assert r.total == (sum(values) if values else None) and r.seen == (len(own) or None) and r.most == (max(values) if values else None)
        assert (r.last and r.last.n) == (max(own, key=lambda e: (pd.Timestamp(e[1]), e[3]))[3] if own else None)
