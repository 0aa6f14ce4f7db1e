"""The plans are the ones wanted: pruned scans, no nested-loop or cartesian joins."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the checks
from checks.base import QUERIES
from wardline.operators import ordered as O
from wardline.operators import pivot as P
from wardline.operators.windows import events_in_window

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"glm_fit", "glm_scores"}))
def test_no_nested_loops_or_python(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    for bad in ("NestedLoop", "Cartesian", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in text, bad


def test_scan_reads_two_columns_and_pushes_the_filter(spark):
    ev = spark.read.parquet(f"{DATA}/events.parquet")
    text = plan(ev.where(F.col("event_type").isin("view", "click")).groupBy("event_type").agg(F.max("value")))
    assert "In(event_type, [click,view])" in text and "ReadSchema: struct<event_type:string,value:double>" in text


def test_window_join_is_an_equi_join_on_key_and_cell(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ev = spark.read.parquet(f"{DATA}/events.parquet")
        anchor = ev.groupBy("user_id").agg(F.min("ts").alias("t0"))
        out = events_in_window(anchor, ev, ["user_id"], "ts", F.col("t0"), F.col("t0") + F.expr("interval 1 day"))
        text = plan(out)
        join = next(line for line in text.splitlines() if "SortMergeJoin" in line)
        assert "user_id" in join and "__cell" in join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_asof_shuffles_the_left_side_once(spark):
    ev = spark.read.parquet(f"{DATA}/events.parquet")
    left = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = ev.where("event_type = 'view'").select("user_id", F.col("ts").alias("t"), "value")
    text = plan(O.asof_backward(left, ["user_id"], "ts", [O.Carried(right, "t", 7200, {"value": "v"})]))
    assert text.count("EqualTo(event_type,purchase)") == 1 and "Join" not in text


def broadcasts(df):
    """What the plan broadcasts, apart from constant rule tables: the lines below each exchange."""
    lines = plan(df).splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "BroadcastExchange" in line]
    return [line for line in below if "LocalTableScan [itemid" not in line]


def test_stays_with_their_cells_are_not_broadcast(spark):
    part = spark.read.parquet(f"{DATA}/part.parquet")
    stays = part.selectExpr("p_partkey as k", "timestamp_ntz'2020-01-01 00:00:00' as t0")
    events = spark.read.parquet(f"{DATA}/lineitem.parquet").selectExpr("l_partkey as k", "cast(l_shipdate as timestamp_ntz) as ts")
    assert broadcasts(events_in_window(stays, events, ["k"], "ts", F.col("t0"), F.col("t0") + F.expr("interval 1 day"))) == []


@pytest.mark.parametrize("name", ["clinical_blood_gas", "clinical_renal_failure", "clinical_urine_output"])
def test_no_table_of_stays_is_broadcast(spark, name):
    assert broadcasts(QUERIES[name](spark, DATA)) == []


@pytest.mark.parametrize("name", ["timed_extract", "timed_extract_wide"])
def test_the_extract_broadcasts_rules_and_hot_cells_only(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    lines = text.splitlines()
    below = [" ".join(lines[i + 1:i + 3]) for i, line in enumerate(lines) if "BroadcastExchange" in line]
    assert all("LocalTableScan [itemid" in b or "filter(__all" in b or "__n" in b for b in below), below


def test_keys_are_spread_where_they_are_dealt(spark):
    ev = spark.read.parquet(f"{DATA}/events.parquet")
    for wide in (P.long_to_wide(ev, ["user_id"], "event_type", "value", ["view", "click"]),
                 P.summarise(ev, ["user_id"], "event_type", "value", {"v": ["view"]}, ["min", "mean"])):
        lines = plan(wide).splitlines()
        last = next(i for i, line in enumerate(lines) if "pivotfirst" in line)
        first = next(i for i, line in enumerate(lines) if "partial_pivotfirst" in line)
        assert last < first and not any("Exchange" in line for line in lines[last:first])


def test_the_extract_leaves_events_out_before_they_are_shuffled(spark):
    """Scans of events but the cohort's own meet the bits of the included stays first; subqueries show the cohort's again."""
    text = QUERIES["timed_extract_wide"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Filter" in line and "l_partkey" in line and "getbit" in line for line in text.splitlines()) >= 9


def test_a_window_join_for_few_stays_finds_the_same_events(spark):
    stays = spark.range(0, 400, 40).selectExpr(
        "if(id = 80, null, id) as k", "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id % 7 as int)) as t0")
    stays = stays.unionByName(stays.where("k < 100"))
    events = spark.range(8000).selectExpr("if(id % 11 = 0, null, id % 400) as k", "id as v",
                                          "if(id % 13 = 0, null, timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, cast(id % 240 as int))) as ts")
    window = (stays, events, ["k"], "ts", F.col("t0"), F.col("t0") + F.expr("interval 1 day"))
    some, every = events_in_window(*window, few_stays=True), events_in_window(*window)
    assert sorted(some.collect()) == sorted(every.collect()) != []
    assert "getbit" in plan(some) and "getbit" not in plan(every)
    with pytest.raises(ValueError):
        events_in_window(stays.withColumn("k", F.col("k").cast("int")), *window[1:], few_stays=True)
