"""Quantiles by selection, block correlation and evaluation by group against numpy and pandas."""

import math
import random
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardline.operators import model as M
from wardline.operators import profile as PR
from wardline.operators import selection as S


def test_sortable_longs_are_the_bit_patterns(spark):
    rng = random.Random(3)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, -math.inf, 1.0, -1.0]
    values += [s * m * 2.0 ** e for e in range(-1074, 1024) for m in (1.0, 1.5) for s in (1, -1)]
    values += [math.nextafter(2.0 ** e, d) for e in range(-1021, 1024) for d in (0, math.inf)]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(5000)]
    values = [v for v in values if v == v]
    df = S.with_sortable(spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "x double"), "x", "k")
    for r in df.collect():
        if r.x is None:
            assert r.k is None
        elif r.x != r.x:
            assert r.k == (2047 << 52) + 1
        else:
            bits = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
            assert r.k == (-bits if r.x < 0 else bits)


@pytest.mark.parametrize("few_groups", [True, False])
def test_quantiles_of_many_columns(spark, few_groups):
    rng = np.random.default_rng(4)
    n = 2000
    data = pd.DataFrame({"g": rng.choice(["a", "b", None], n, p=[0.7, 0.28, 0.02]), "u": rng.normal(size=n) * 1e-3, "v": np.exp(rng.normal(size=n) * 30),
                         "w": rng.integers(-3, 4, n).astype(float), "c": 5.0})
    data.loc[rng.random(n) < 0.3, "v"] = np.nan
    data.loc[data.g == "b", "c"] = np.nan
    columns = ["u", "v", "w", "c"]
    recs = [tuple(None if (isinstance(x, float) and x != x) else x for x in r) for r in data.itertuples(index=False)]
    df = spark.createDataFrame(recs, "g string, u double, v double, w double, c double").repartition(4)
    probs = {"p0": 0.0, "p5": 0.05, "median": 0.5, "p99": 0.99, "p100": 1.0}
    got = {(r.g, r.variable): r for r in S.quantiles(df, ["g"], columns, probs, few_groups).collect()}
    for g in ("a", "b", None):
        mine = data[data.g.isna()] if g is None else data[data.g == g]
        for c in columns:
            known = mine[c].dropna()
            assert ((g, c) in got) == bool(len(known))
            if len(known):
                assert np.allclose([got[g, c][p] for p in probs], known.quantile(list(probs.values())), rtol=1e-13, atol=0)


def test_describe_all_lists_groups_without_known_values(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("a", 3.0, None), ("b", None, None)], "g string, x double, y int")
    got = {(r.g, r.variable): (r.n, r["mean"], r.median) for r in PR.describe_all(df, "g", ["x", "y"]).collect()}
    assert got == {("a", "x"): (2, 2.0, 2.0), ("a", "y"): (1, 2.0, 2.0), ("b", "x"): (0, None, None), ("b", "y"): (0, None, None)}
    assert PR.describe_all(df.where("false"), "g", ["x", "y"]).count() == 0


def test_selection_sorts_and_shuffles_no_distinct_values(spark):
    text = PR.describe_all(spark.range(100).selectExpr("id % 3 as g", "cast(id as double) as x"), "g", ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__x" not in text and "Sort [__x" not in text


# --- correlation ----------------------------------------------------------------------------
def test_blocks_equal_pandas(spark):
    rng = np.random.default_rng(6)
    n, wide = 400, 41
    data = pd.DataFrame(rng.normal(size=(n, wide)) @ rng.normal(size=(wide, wide)) + 1e6 * rng.random(wide), columns=[f"x{i}" for i in range(wide)])
    for c in data.columns[::3]:
        data.loc[rng.random(n) < 0.4, c] = np.nan
    data["x7"] = 3.25  # constant
    data.loc[data.index[200:], "x1"] = np.nan
    data.loc[data.index[:200], "x2"] = np.nan  # never known together with x1
    recs = [tuple(None if v != v else v for v in r) for r in data.itertuples(index=False)]
    df = spark.createDataFrame(recs, ", ".join(f"x{i} double" for i in range(wide))).repartition(3)
    want = data.corr(min_periods=1)
    got = {(r.a, r.b): r.r for r in PR.correlation(df, list(data.columns)).collect()}
    assert ("x1", "x2") not in got and len(got) == wide * (wide - 1) // 2 - 1
    for (a, b), r in got.items():
        assert r is None if "x7" in (a, b) else abs(r - want.loc[a, b]) < 1e-9


def test_a_number_that_is_none_spoils_only_the_pairs_that_meet_it(spark):
    wide = PR.DIRECT_COLUMNS + 1
    rows = [tuple(float((i * (j + 3)) % 7) for j in range(wide)) for i in range(20)] + [(math.nan, None) + (1.0,) * (wide - 2)]
    df = spark.createDataFrame(rows, ", ".join(f"x{i} double" for i in range(wide)))
    got = {(r.a, r.b): r.r for r in PR.correlation(df, df.columns).collect()}
    assert got["x0", "x1"] == got["x0", "x1"] and got["x0", "x2"] != got["x0", "x2"] and got["x1", "x2"] == got["x1", "x2"]


def test_a_task_sends_one_row_per_pair_of_blocks(spark):
    wide = 70
    df = spark.range(0, 1000, numPartitions=3).select(*[(F.col("id") * (i + 1) % 97).cast("double").alias(f"x{i}") for i in range(wide)])
    text = PR.correlation(df, df.columns)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(i" in text and "hashpartitioning(a" not in text
    assert PR.correlation(df, df.columns).count() == wide * (wide - 1) // 2


# --- evaluation -----------------------------------------------------------------------------
def test_evaluation_by_group_equals_one_group_at_a_time(spark):
    rng = np.random.default_rng(2)
    rows = [(str(rng.choice(["a", "b", "c"])), int(rng.integers(0, 2)), round(float(rng.random()), 2)) for _ in range(600)] + [("d", 1, 0.5)]
    df = spark.createDataFrame(rows, "s string, y int, p double")
    areas = {r.s: (r.n_pos, r.n_neg, r.auroc) for r in M.auroc(df, "y", "p", cells=7, by=("s",)).collect()}
    curves = {(r.s, r.bin): (r.n, round(r.mean_predicted, 9), r.fraction_positive) for r in M.calibration(df, "y", "p", by=("s",)).collect()}
    for s in "abcd":
        one = df.where(F.col("s") == s)
        r = M.auroc(one, "y", "p").first()
        assert areas[s] == (r.n_pos, r.n_neg, r.auroc)
        assert {(s, c.bin): (c.n, round(c.mean_predicted, 9), c.fraction_positive) for c in M.calibration(one, "y", "p").collect()} == {
            k: v for k, v in curves.items() if k[0] == s}
