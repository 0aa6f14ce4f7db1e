"""Flat registries: cohort rules with nulls, unit text, field maps."""

import pytest
from pyspark.sql import functions as F

from wardline.functions import scalars as S
from wardline.functions import text as X
from wardline.operators import joins as J
from wardline.plans import flat
from wardline.registry import header

from helpers import table


def test_coded_cohort_null_rules(rows):
    base = dict(hosp_ds_dtm="2014-06-01 00:00:00", age=50.0, hosp_outcm=3, readmitted=2, apache3riskofdeath=0.1, hrlo=50.0, hrhi=90.0)
    cases = {"ok": {}, "age15": {"age": 15.0}, "age16": {"age": 16.0}, "agenull": {"age": None}, "early": {"hosp_ds_dtm": "2013-12-31 23:59:59"},
             "first": {"hosp_ds_dtm": "2014-01-01 00:00:00"}, "last": {"hosp_ds_dtm": "2015-12-31 23:59:59"}, "late": {"hosp_ds_dtm": "2016-01-01 00:00:00"},
             "outnull": {"hosp_outcm": None}, "out9": {"hosp_outcm": 9}, "readm": {"readmitted": 1}, "readmnull": {"readmitted": None},
             "risk0": {"apache3riskofdeath": 0.0}, "risknull": {"apache3riskofdeath": None}, "hr": {"hrlo": None}}
    df = rows("id string, hosp_ds_dtm timestamp, age double, hosp_outcm int, readmitted int, apache3riskofdeath double, hrlo double, hrhi double",
              [(k, *(base | v).values()) for k, v in cases.items()])
    out = {r.id: r.excluded for r in flat.coded_cohort(df).collect()}
    assert {k for k, v in out.items() if v == 0} == {"ok", "age16", "first", "last", "outnull", "readmnull"}
    assert "early" not in out and "late" not in out


def test_first_stay_per_patient_and_site(rows):
    df = rows("patientid int, site_id int, icu_ad_dtm timestamp, n int, excluded int", [
        (1, 1, "2014-02-01 00:00:00", 1, 0), (1, 1, "2014-01-01 00:00:00", 2, 0), (1, 2, "2014-03-01 00:00:00", 3, 0), (1, 2, "2014-01-01 00:00:00", 4, 1),
        (2, 1, None, 5, 0), (2, 1, "2014-09-01 00:00:00", 6, 0)])
    assert table(flat.coded_first_stays(df), "n") == [(2,), (3,), (6,)]


@pytest.mark.parametrize("fn,text,value", [
    (X.parse_weight, "62 kg", 62.0), (X.parse_weight, "62", 62.0), (X.parse_weight, "heavy", None), (X.parse_weight, None, None),
    (X.parse_height, "5.5 Inch", 13.97), (X.parse_height, "170cm", 170.0), (X.parse_height, "na 160", 160.0), (X.parse_height, "na", None),
    (X.parse_age, "6 months", 0.5), (X.parse_age, "40 yrs", 40.0), (X.parse_age, "40 years", 40.0), (X.parse_age, "151", None), (X.parse_age, "150", 150.0)])
def test_unit_text(spark, fn, text, value):
    got = spark.createDataFrame([(text,)], "x string").select(fn("x").alias("y")).first().y
    assert got == (None if value is None else pytest.approx(value))


@pytest.mark.parametrize("beds,label", [(-1, None), (99, "<100"), (100, "100 - 249"), (249, "100 - 249"), (250, "250 - 499"), (498, "250 - 499"),
                                        (499, "250 - 499"), (500, ">= 500"), (None, None)])
def test_bed_bands(spark, beds, label):
    df = spark.createDataFrame([(beds,)], "b int")
    assert df.select(S.band("b", flat.BED_EDGES, flat.BED_LABELS).alias("x")).first().x == label
    assert df.select(S.band(F.col("b"), flat.BED_EDGES, flat.BED_LABELS).alias("x")).first().x == label


def test_text_registry(rows):
    sides = [f"{s}_{e}" for s in [*flat.TEXT_PAIRS.values(), *flat.TEXT_PERCENT_PAIRS.values()] for e in ("lowest", "highest")]
    pair = {n: None for n in sides} | {"heart_rate_lowest": 60.0, "heart_rate_highest": 90.0, "saturate_lowest": 101.0, "saturate_highest": 99.0}
    schema = "id int, age string, weight string, height string, sex string, admission_type string, mortality int, a_score string, apachecode string, " + ", ".join(f"{n} double" for n in sides)
    df = rows(schema, [(1, "40 yrs", "x", "NA 62", "male", "surgical ward", 0, "12", "2", *pair.values()), (2, "30", "70 kg", "160", ".", None, 1, "5", "1", *pair.values()),
                       (3, "30", "70", "160", "Male", "medical", None, "5", "1", *pair.values()), (4, "30", "70", "160", "Male", "medical", 0, "0", "1", *pair.values())])
    older = rows("id int, age string, sys_bp_highest string, site int", [(1, "40", "1", 3), (2, "30", None, 4), (3, "31", "2", 1)])
    codes = rows("code string, name string, target_id int, target_name string, target_operative string", [
        ("1", "a", 0, "x", "Non-operative"), ("2", "b", 21, "y", "Post-operative"), ("2", "b", 22, "y", "Non-operative"), ("2", None, 23, "y", "Non-operative")])
    out = flat.text_extract(df, older, codes, "src")
    assert out.columns == header()
    r = {x.encounter_id: x for x in out.collect()}
    assert set(r) == {"src_1", "src_2"}
    a, b = r["src_1"], r["src_2"]
    assert (a.age, a.weight, a.height, a.gender, a.country, a.apache_2_diagnosis, a.apache_post_operative) == (40.0, 62.0, None, "M", "India", "21", 1)
    assert (b.gender, b.apache_2_diagnosis, b.apache_post_operative, b.d1_spo2_min, b.d1_spo2_max, b.icu_death) == (None, None, 0, None, 99.0, 1)
    check = {x.variable: x.n_match for x in flat.text_reconcile(df.withColumn("sys_bp_highest", F.lit("1")), older).collect()}
    assert check == {"age": 1, "sys_bp_highest": 1}


def test_study_sheet(rows):
    names = ["hosp_code", "medicalrecord", "admissionrecordid", "hospbeds", "gender", "hospitaldestinationname", "admissionsourcename", "unitdestinationname",
             "admissiontypename", "lowest pa o2fi o21h", "highest heart rate1h"]
    sheet = rows("a string, b string, c string, d string, e string, f string, g string, h string, i string, j string, k string", [
        ("h1", "m1", "r1", "499", "I", "Death", "Ward / Floor", "WardFloor", "Scheduled Surgery", "210.5", "130")]).toDF(*names)
    r = flat.study_extract(sheet, "src").first()
    assert (r.encounter_id, r.hospital_bed_size, r.gender, r.hospital_disch_location) == ("h1_m1_r1", "250 - 499", None, "Died in Hospital")
    assert (r.icu_admit_source, r.elective_surgery, r.h1_pao2fio2ratio_min, r.h1_heartrate_max, r.readmission_status) == ("Ward", 1, 210.5, 130.0, 0)


def test_relational_registry(rows):
    visits = rows("""tipodni string, dni string, fecing string, edad int, sexo string, patologia int, resultadoegresoh string, restrat int, procedencia string, dias int,
        reingreso int, ira int, na double, k double, creatin double, valfio2 double, freccard double, hematroc double, tensart double, pco2 double, pao2 double,
        phart double, frecresp double, temperatura double, leucoc double, fecegrh double, fecingh double, fechaing double""", [
        ("D", "1", "20100101", 50, "M", 3, "Fallece", 5, "X", 4, 0, 1, 140.0, 4.0, *[1.0] * 8, 0.0, 37.0, 9.0, 20.0, 10.0, 12.0)])
    weights = rows("tipodni string, dni string, fecing string, imc double", [("D", "1", "20100101", 24.0)])
    patients = rows("dnitipo string, dni string, altura double, peso double", [("D", "1", 0.0, 80.0)])
    r = flat.relational_extract(visits, weights, patients, "src").first()
    assert (r.encounter_id, r.patient_id, r.height, r.weight, r.bmi) == ("D120100101", "D1", None, 80.0, 24.0)
    assert (r.elective_surgery, r.hospital_death, r.icu_death, r.hospital_los_days, r.pre_icu_los_days, r.ventilated_apache) == (1, 1, 1, 10.0, 2.0, 1)
    assert (r.sodium_apache, r.bun_apache) == (4.0, 140.0)
    fixed = flat.relational_extract(visits, weights, patients, "src", swap_back=True).first()
    assert (fixed.sodium_apache, fixed.bun_apache) == (140.0, None)


def test_keep_consistent_and_null_keys(rows):
    df = rows("k int, v double, n int", [(1, 5.0, 1), (1, 5.0, 2), (2, 5.0, 3), (2, 6.0, 4), (3, None, 5), (None, 1.0, 6), (4, 5.0, 7), (4, None, 8)])
    assert table(J.keep_consistent(df, ["k"], "v"), "n") == [(1,), (2,), (5,), (7,), (8,)]


def test_division_and_missing_codes_are_null(rows):
    df = rows("w double, h double, c int", [(70.0, 0.0, 9), (None, 170.0, None)])
    out = df.select(S.bmi("w", "h").alias("b"), S.map_codes("c", {1: "a"}).alias("m"), S.any_equal(["c"], 9).alias("e")).collect()
    assert [tuple(r) for r in out] == [(None, None, 1), (None, None, 0)]
