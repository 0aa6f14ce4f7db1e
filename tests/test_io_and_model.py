"""Readers, writers, registry, conformance, profiling and modelling."""

import json
import math
import warnings

import pytest
from pyspark.sql import functions as F

from wardline import registry as REG
from wardline.operators import conform as CF
from wardline.operators import model as M
from wardline.operators import profile as PR
from wardline.plans import merge
from wardline.sources import readers as RD
from wardline.sources import writers as WR

from helpers import table


def test_header_size_and_order(spark):
    names = REG.header()
    assert len(names) == 213 and len(set(names)) == 213 and len(REG.variables()) == 215
    assert names[:4] == ["data_source", "encounter_id", "hospital_id", "patient_id"]
    assert names[-1] == "solid_tumor_with_metastasis" and names.index("d1_albumin_max") > names.index("h1_temp_min")
    listed = [r.varname for r in REG.header_of(REG.definitions(REG.registry_frame(spark))).collect()]
    assert [n for n in listed if n not in REG.MERGE_COLUMNS] == names
    field = REG.header_schema()["d1_wbc_max"]
    assert field.metadata == {"category": "labs", "unit": "10^9/L"}


def test_csv_round_trip_keeps_codes(spark, tmp_path):
    schema = REG.header_schema()
    df = CF.apply_field_map(spark.createDataFrame([("101.01", 2.5)], "a string, b double"), {
        "apache_3j_diagnosis": "a", "d1_wbc_max": "b", "data_source": F.lit("s")}, schema)
    WR.write_csv(df, str(tmp_path / "x"))
    assert all(f.name.endswith(".csv.gz") for f in (tmp_path / "x").iterdir() if f.name.startswith("part"))
    r = RD.read_extract(spark, str(tmp_path / "x")).first()
    assert (r.apache_3j_diagnosis, r.d1_wbc_max, r.data_source, r.age) == ("101.01", 2.5, "s", None)


def test_text_csv_bom_and_coercion(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes(b"\xef\xbb\xbfSITE_ID,Age,Note\n1,x,\"a, b\"\n2,30,c\n")
    df = RD.read_registry_csv(spark, str(tmp_path / "r.csv"), ["age"], "site_id", partitions=2)
    assert df.columns == ["site_id", "age", "note"] and df.rdd.getNumPartitions() == 2
    assert table(df) == [("1", None, "a, b"), ("2", 30.0, "c")]
    bad = spark.createDataFrame([(1,)], "x int").toDF("ï»¿site_id")
    assert CF.fix_first_column(bad, "site_id").columns == ["site_id"]
    with pytest.warns(UserWarning):
        CF.fix_first_column(spark.createDataFrame([(1,)], "other int"), "site_id")


def test_maps_dictionary_and_header_files(spark, tmp_path):
    (tmp_path / "m.csv").write_text('"code","x","coef"\n101.10,"a",1.5\n')
    assert table(RD.read_map(spark, str(tmp_path / "m.csv"), ["coef"])) == [("101.10", "a", 1.5)]
    (tmp_path / "d.csv").write_text('101.01,"Shock; cardiogenic"\n101.02,"Poisoning, other"\n')
    assert table(RD.read_dictionary(spark, str(tmp_path / "d.csv")))[1] == ("101.02", "Poisoning, other")
    (tmp_path / "h.csv").write_text("b\na\n")
    assert RD.read_header(spark, str(tmp_path / "h.csv")) == ["b", "a"]


REC = {"data_source": {"category": "identifier", "dataType": "string", "permissibleRange": {"coded": ["x", "y"], "low": "None", "high": None}, "outcome": False},
       "age": {"category": "demographic", "dataType": "numeric", "unitofmeasure": "Years", "imputation": True,
               "permissibleRange": {"coded": "None", "low": 0, "high": 120}}}


def test_registry_files(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps(REC))
    out = {r.varname: r for r in RD.read_registry(spark, str(tmp_path / "r.json")).collect()}
    assert out["data_source"].permissibleRange.coded == ["x", "y"] and out["age"].permissibleRange.high == "120"
    assert (out["age"].imputation, out["data_source"].outcome, out["data_source"].permissibleRange.low) == ("Yes", "No", None)
    yaml = pytest.importorskip("yaml")
    (tmp_path / "r.yaml").write_text(yaml.safe_dump(REC))
    assert table(RD.read_registry(spark, str(tmp_path / "r.yaml")), "varname", "unitofmeasure") == [("age", "Years"), ("data_source", None)]


def test_tables_parquet_and_category_folders(spark, tmp_path):
    df = spark.createDataFrame([("labs", "a", 1.0), ("vitals", "b", 2.0)], "category string, v string, p double")
    WR.write_parquet(df, str(tmp_path / "p"), ["v"])
    assert RD.read_table(spark, str(tmp_path / "p")).count() == 2
    WR.write_by_category(df, str(tmp_path / "c"))
    assert {p.name for p in (tmp_path / "c").iterdir() if p.is_dir()} == {"category=labs", "category=vitals"}


def test_replace_table(spark, tmp_path):
    spark.sql(f"create database if not exists kept location '{tmp_path}'")
    for n in (3, 5):
        WR.replace_table(spark.range(n), "kept.stays")
    assert RD.read_table(spark, "kept.stays").count() == 5
    spark.sql("drop table kept.stays")


def test_reuse_cuts_the_lineage(spark, tmp_path):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    kept = WR.reuse(df, str(tmp_path / "ck"))
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString() and kept.count() == 10


def test_conform_and_field_map_warn_and_fill(rows):
    schema = REG.header_schema(["age", "gender", "weight", "height"])
    with pytest.warns(UserWarning, match="weight, height"):
        out = CF.conform(rows("GENDER string, Age string, extra int", [("F", "4x", 1), ("M", "40", 2)]), schema)
    assert out.columns == ["age", "gender", "weight", "height"] and table(out) == [(40.0, "M", None, None), (None, "F", None, None)]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        r = CF.apply_field_map(rows("kg double", [(7.0,)]), {"age": None, "gender": "absent", "weight": "kg", "height": F.col("kg") * 2}, schema).first()
    assert tuple(r) == (None, None, 7.0, 14.0)


def test_merge_and_profile(rows):
    three = rows("apache_3j_operative string, apache_3j_diagnosis string, apache_3j_bodysystem string, apache_2_diagnosis string", [("Non-operative", "101", "Heart", "115")])
    two = rows("apache_2_diagnosis string, apache_2_bodysystem string, apache_2_operative string", [("115", "Heart A", "Non-operative")])
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        a = CF.conform(rows("data_source string, age double, apache_3j_diagnosis string, apache_2_diagnosis string, apache_post_operative int",
                            [("carevue", 300.0, "101.01", "115", 0), ("metavision", 50.0, None, None, None)]), REG.header_schema())
        b = CF.conform(rows("data_source string, gender string", [("reg", "F")]), REG.header_schema())
    whole = merge.top_code_age(merge.merge([a, b], three, two, {"pooled": ["carevue", "metavision", "both"]}), "pooled")
    assert len(whole.columns) == 215
    assert table(whole, "data_source", "age", "apache_3j_bodysystem", "apache_2_bodysystem") == [
        ("pooled", 50.0, None, None), ("pooled", 91.4, "Heart", "Heart A"), ("reg", None, None, None)]
    comp = {(r.variable, r.data_source): r.percent for r in merge.completion_table(whole).collect()}
    assert comp[("age", "pooled")] == 100.0 and comp[("apache_3j_diagnosis", "pooled")] == 50.0 and comp[("gender", "pooled")] is None
    avail = merge.availability_table(whole)
    assert {r.variable for r in PR.common_variables(avail, "data_source", ["pooled", "reg"]).collect()} == set()


def test_crosstab_margins_add_up(rows):
    df = rows("a string, b string", [("x", "p"), ("x", "q"), ("y", "p"), (None, "p"), ("y", None)])
    got = {(r.a, r.b): (r.n, r.share) for r in PR.crosstab_share(df, "a", ["b"], 100.0).collect()}
    assert got[("All", "All")] == (3, 100.0) and got[("x", "p")] == (1, 50.0) and got[("x", "All")][0] == 2 and ("y", "q") not in got


def test_histogram_last_bin_is_closed(rows):
    df = rows("x double", [(0.0,), (1.99,), (2.0,), (200.0,), (200.5,), (None,)])
    got = {r.bin: (r.n, r.density) for r in PR.histogram(df, "x", 0.0, 200.0, 100).collect()}
    assert got == {0: (2, 0.25), 1: (1, 0.125), 99: (1, 0.125)}


def test_impute_and_prune(rows):
    df = rows("y int, a double, b double, c string, d double", [(0, 1.0, 5.0, "m", 1.0), (1, None, None, None, 2.0), (1, 4.0, 6.0, "f", None), (0, None, 7.0, "f", 4.0)])
    fills = M.fill_values(df, ["a", "b", "d"], ["c"])
    assert fills == {"a": 2.5, "b": 6.0, "c": "f", "d": pytest.approx(7 / 3)}
    out = M.impute(df, fills)
    assert table(out, "a", "a_missing", "c", "c_missing")[0] == (1.0, 0, "m", 0) and out.where("c_missing = 1").first().c == "f"
    flags = [c for c in out.columns if c.endswith("_missing")]
    # b, c and d are each missing once: only the first of them is kept
    assert M.redundant_flags(out, flags) == [f for f in flags if f not in ("a_missing", flags[[f != "a_missing" for f in flags].index(True)])]


def test_spline_columns(rows):
    df = rows("x double", [(0.0,), (5.0,), (10.0,)])
    out = M.with_splines(df, M.spline_bounds(df, ["x"])).collect()
    assert [tuple(r) for r in out] == [(0.0, 0.0, 0.0), (0.375, 0.375, 0.125), (0.0, 0.0, 1.0)]


def test_logit_on_two_by_two_table(rows):
    # odds 1:3 without and 3:1 with exposure, so the odds ratio is nine
    df = rows("y int, x double", [(1, 0.0)] * 10 + [(0, 0.0)] * 30 + [(1, 1.0)] * 30 + [(0, 1.0)] * 10 + [(1, None)])
    fitted = M.fit_logit(df, "y", ["x"])
    coef = {t: (b, e, o) for t, b, e, o in M.coefficients(fitted, df)}
    assert coef["x"][0] == pytest.approx(math.log(9), abs=1e-5) and coef["x"][2] == pytest.approx(9, abs=1e-3)
    assert coef["x"][1] == pytest.approx(math.sqrt(1 / 10 + 1 / 30 + 1 / 30 + 1 / 10), abs=1e-4)
    assert M.score(fitted, df).where("x = 1").first().p == pytest.approx(0.75, abs=1e-6)


def test_calibration_drops_empty_bins(rows):
    df = rows("y int, p double", [(0, 0.05), (1, 0.05), (1, 1.0), (None, 0.5)])
    assert table(M.calibration(df, "y", "p"), "bin", "n", "mean_predicted", "fraction_positive") == [(0, 2, 0.05, 0.5), (9, 1, 1.0, 1.0)]
