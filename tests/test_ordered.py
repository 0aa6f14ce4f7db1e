"""Cell-based ordered operators against brute force, on data with one hot key and null keys."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardline.operators import model as M
from wardline.operators import ordered as O

HOUR = 3600


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    n = 1500
    key = np.where(rng.random(n) < 0.4, 1, rng.integers(2, 60, n)).astype(object)
    key[rng.random(n) < 0.03] = None
    secs = rng.integers(0, 5 * 86400, n)
    # ties on the hour and exact distances of six hours
    secs[::5] = secs[::5] // HOUR * HOUR
    return pd.DataFrame({"id": range(n), "key": key, "ts": pd.Timestamp("2021-03-01") + pd.to_timedelta(secs, "s"),
                         "v": rng.integers(0, 40, n).astype(float), "y": rng.integers(0, 2, n)})


@pytest.fixture(scope="module")
def frame(spark, data):
    recs = [(int(r.id), None if r.key is None else int(r.key), str(r.ts), float(r.v), int(r.y)) for r in data.itertuples()]
    return spark.createDataFrame(recs, "id long, key long, ts string, v double, y int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def groups(data):
    return data.assign(k=data["key"].map(lambda x: -1 if x is None else x)).sort_values(["k", "ts", "id"])


@pytest.mark.parametrize("width", [600, 6 * HOUR, 30 * 86400])
def test_sequence_matches_plain_count(frame, data, width):
    out = O.sequence(frame, ["key"], [F.col("ts"), F.col("id")], O.time_cell("ts", width)).toPandas().set_index("id")["seq"]
    want = groups(data).groupby("k").cumcount() + 1
    want.index = groups(data)["id"]
    assert (out.sort_index() == want.sort_index()).all()


def test_rank_gives_ties_the_same_number(frame, data):
    out = O.sequence(frame, ["key"], [F.col("ts")], O.time_cell("ts", HOUR), "r", ties=True).toPandas().set_index("id")["r"]
    want = groups(data).groupby("k")["ts"].rank(method="min").astype(int)
    want.index = groups(data)["id"]
    assert (out.sort_index() == want.sort_index()).all()


def test_running_total_and_group_total(frame, data):
    out = O.running_total(frame, ["key"], [F.col("ts"), F.col("id")], F.col("v"), O.time_cell("ts", HOUR), "c", "t")
    out = out.toPandas().set_index("id")
    g = groups(data)
    want = g.groupby("k")["v"].cumsum()
    want.index = g["id"]
    total = g.groupby("k")["v"].transform("sum")
    total.index = g["id"]
    assert np.allclose(out["c"].sort_index(), want.sort_index())
    assert np.allclose(out["t"].sort_index(), total.sort_index())


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("width", [900, None])
def test_previous_within(frame, data, closed, width):
    out = O.previous_within(frame, ["key"], "ts", ["v"], 6 * HOUR, ["id"], width, closed).toPandas().set_index("id")["prev_v"]
    g = groups(data)
    gap = (g["ts"] - g.groupby("k")["ts"].shift()).dt.total_seconds()
    near = gap <= 6 * HOUR if closed else gap < 6 * HOUR
    want = g.groupby("k")["v"].shift().where(near)
    want.index = g["id"]
    pd.testing.assert_series_equal(out.sort_index(), want.sort_index(), check_names=False)


@pytest.mark.parametrize("width", [700, None])
def test_asof_with_two_sides(spark, frame, data, width):
    left = frame.where("id % 3 = 0").select("id", "key", "ts")
    a = frame.where("id % 3 = 1").groupBy("key", F.col("ts").alias("t")).agg(F.max("v").alias("x"))
    b = frame.where("id % 3 = 2").groupBy("key", F.col("ts").alias("t")).agg(F.max("v").alias("x"))
    out = O.asof_backward(left, ["key"], "ts", [O.Carried(a, "t", 2 * HOUR, {"x": "near_a"}),
                                                O.Carried(b, "t", 4 * HOUR, {"x": "near_b"})], width).toPandas().set_index("id")
    assert len(out) == left.count()

    def brute(row, part, reach):
        p = part[(part["k"] == row.k) & (part["ts"] <= row.ts) & (part["ts"] >= row.ts - pd.Timedelta(seconds=reach))]
        return None if p.empty else p[p["ts"] == p["ts"].max()]["v"].max()

    g = groups(data)
    for row in g[g["id"] % 3 == 0].itertuples():
        for col, rest, reach in (("near_a", 1, 2 * HOUR), ("near_b", 2, 4 * HOUR)):
            want, got = brute(row, g[g["id"] % 3 == rest], reach), out.loc[row.id, col]
            assert (want is None and pd.isna(got)) or want == got


def test_asof_includes_both_ends(rows):
    left = rows("k int, ts timestamp", [(1, "2020-01-01 10:00:00"), (1, "2020-01-01 12:00:00"), (1, "2020-01-01 12:00:01")])
    right = rows("k int, t timestamp, x double", [(1, "2020-01-01 10:00:00", 5.0), (1, "2020-01-01 10:00:00.5", None)])
    right = right.where("x is not null")
    out = O.asof_backward(left, ["k"], "ts", [O.Carried(right, "t", 2 * HOUR, {"x": "x"})]).orderBy("ts").collect()
    assert [r.x for r in out] == [5.0, 5.0, None]


def test_latest_row_wins_even_when_its_value_is_null(rows):
    left = rows("k int, ts timestamp", [(1, "2020-01-01 10:00:00")])
    right = rows("k int, t timestamp, x double", [(1, "2020-01-01 09:00:00", 5.0), (1, "2020-01-01 09:30:00", None)])
    assert O.asof_backward(left, ["k"], "ts", [O.Carried(right, "t", 2 * HOUR, {"x": "x"})]).first().x is None


def test_first_row_null_order(rows):
    df = rows("k int, a double, b int", [(1, None, 1), (1, 3.0, 2), (1, 9.0, 3)])
    assert O.first_row(df, ["k"], [O.nulls_last("a")], ["b"]).first().b == 2
    assert O.first_row(df, ["k"], [O.nulls_first("a")], ["b"]).first().b == 1
    assert O.first_row(df, ["k"], [O.descending("a")], ["b"]).first().b == 1


@pytest.mark.parametrize("cells", [2, 7, 64])
def test_exact_quantiles(frame, data, cells):
    out = O.exact_quantiles(frame, ["key"], "v", {"p5": 0.05, "m": 0.5, "p95": 0.95}, cells).toPandas()
    for row in out.itertuples():
        mine = data[data["key"].isna()] if pd.isna(row.key) else data[data["key"] == row.key]
        assert np.allclose([row.p5, row.m, row.p95], mine["v"].quantile([0.05, 0.5, 0.95]))


def test_auroc_counts_ties_half(frame, data):
    got = M.auroc(frame, "y", "v", cells=5).first().auroc
    pos, neg = data[data.y == 1]["v"].to_numpy(), data[data.y == 0]["v"].to_numpy()
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert got == pytest.approx(wins / len(pos) / len(neg))
