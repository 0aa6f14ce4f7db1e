"""Minute-offset concepts with boundary rows."""

import pytest

from wardline.plans import diagnosis, offset
from wardline.registry import header

from helpers import table

LAB = "patientunitstayid int, labname string, labresult double, labresultoffset int, labresultrevisedoffset int"


def test_labs_duplicates_and_revisions(rows):
    lab = rows(LAB, [
        (1, "sodium", 140.0, 0, 5), (1, "sodium", 140.0, 0, 5),  # equal duplicate stays
        (1, "sodium", 150.0, 0, 9), (1, "sodium", 151.0, 0, 9),  # contradictory newest revision is dropped
        (1, "sodium", 130.0, 10, 5), (1, "sodium", 135.0, 10, 8),  # newest revision wins
        (1, "sodium", 145.0, 20, 3), (1, "sodium", 300.0, 20, 9),  # invalid newest gives way to the valid one
        (1, "sodium", 120.0, 30, None),  # no revision time
        (1, "sodium", 141.0, -60, 1), (1, "sodium", 142.0, 60, 61), (1, "sodium", 143.0, 1440, 1441), (1, "sodium", 144.0, 1441, 1442),
        (1, "bedside glucose", 90.0, 0, 1), (1, "glucose", 95.0, 0, 1), (1, "calcium", 0.0, 0, 1), (1, "BUN", 1.0, 0, 1)])
    wide = {r.labresultoffset: r for r in offset.labs_wide(lab).collect()}
    assert [wide[o].sodium for o in (0, 10, 20)] == [140.0, 135.0, 145.0] and 30 not in wide
    assert (wide[0].glucose, wide[0].calcium, wide[0].bun) == (95.0, None, 1.0)
    r = offset.labs(lab).first()
    assert (r.d1_sodium_min, r.d1_sodium_max, r.h1_sodium_min, r.h1_sodium_max) == (135.0, 145.0, 135.0, 145.0)
    assert offset.labs(rows(LAB, [(1, "sodium", 144.0, 1441, 1442)])).count() == 0


def test_blood_gas_units(rows):
    lab = rows(LAB, [(1, "FiO2", 50.0, 0, 1), (1, "paO2", 100.0, 0, 1), (1, "FiO2", 0.4, 60, 61), (1, "paO2", 100.0, 60, 61),
                     (1, "FiO2", 5.0, 70, 71), (1, "paO2", 720.5, 70, 71)])
    r = offset.blood_gas(lab).first()
    assert (r.d1_pao2fio2ratio_min, r.d1_pao2fio2ratio_max, r.d1_pao2_max) == (200.0, 250.0, 100.0)


def test_monitored_vitals(rows):
    patient = rows("patientunitstayid int", [(1,), (2,)])
    p = rows("""patientunitstayid int, observationoffset int, heartrate double, respiration double, sao2 double, temperature double,
        systemicsystolic double, systemicdiastolic double, systemicmean double""", [
        (1, 61, 400.0, 10.0, 100.5, 98.6, 0.5, 200.0, 334.0), (1, -60, 0.0, 12.0, 97.0, 37.5, 120.0, 201.0, 335.0), (1, -61, 200.0, 1.0, 1.0, 30.0, 2.0, 2.0, 2.0)])
    a = rows("patientunitstayid int, observationoffset int, noninvasivesystolic double, noninvasivediastolic double, noninvasivemean double", [(1, 0, 110.0, 70.0, 85.0)])
    r = {x.patientunitstayid: x for x in offset.vitals(patient, p, a).collect()}
    assert (r[1].d1_heartrate_max, r[1].h1_heartrate_max, r[1].d1_heartrate_min, r[1].d1_spo2_max) == (400.0, 0.0, 0.0, 97.0)
    assert r[1].d1_temp_min == pytest.approx(37.0) and r[1].d1_temp_max == 37.5
    assert (r[1].d1_sysbp_invasive_min, r[1].d1_diasbp_invasive_max, r[1].d1_mbp_invasive_max, r[1].h1_sysbp_noninvasive_max) == (120.0, 200.0, 334.0, 110.0)
    assert r[2].d1_heartrate_max is None


def test_charted_vitals_take_only_numbers(rows):
    cat, hr = "Vital Signs", ("Heart Rate", "Heart Rate")
    chart = rows("""patientunitstayid int, nursingchartoffset int, nursingchartcelltypecat string, nursingchartcelltypevallabel string,
        nursingchartcelltypevalname string, nursingchartvalue string""", [
        (1, 0, cat, *hr, "98."), (1, 1, cat, *hr, "-"), (1, 2, cat, *hr, "."), (1, 3, cat, *hr, "-5"), (1, 4, cat, *hr, "abc"), (1, 5, cat, *hr, "1e2"),
        (1, -60, cat, *hr, "50"), (1, 1440, cat, *hr, "51"), (1, 1439, cat, *hr, "120"), (1, 60, cat, *hr, "60"), (1, 6, "Other", *hr, "61"),
        (1, 7, "Scores", "Glasgow coma score", "GCS Total", "2"), (1, 7, "Scores", "Score (Glasgow Coma Scale)", "Value", "15"),
        (1, 8, cat, "Non-Invasive BP", "Non-Invasive BP Mean", "80")])
    r = offset.vitals_charted(chart).first()
    assert (r.d1_heartrate_min, r.d1_heartrate_max, r.h1_heartrate_min, r.h1_heartrate_max) == (60.0, 120.0, 98.0, 98.0)
    assert (r.d1_gcs_min, r.d1_gcs_max, r.d1_mbp_min, r.d1_mbp_invasive_min) == (15.0, 15.0, 80.0, None)


PATIENT = """patientunitstayid int, patienthealthsystemstayid int, uniquepid string, hospitalid int, wardid int, age string, gender string, ethnicity string,
    hospitaldischargeyear int, hospitaladmitoffset int, hospitaldischargeoffset int, unitdischargeoffset int, hospitaldischargestatus string,
    unitdischargestatus string, unitstaytype string, unittype string, unitadmitsource string, hospitaladmitsource string, hospitaldischargelocation string,
    unitdischargelocation string, admissionweight double, admissionheight double"""


def patient(i, pid, age="50", year=2014, out=1000, unit=500, hosp="Alive", status="Alive", kind="admit", site=1, height=170.0, weight=70.0):
    return (i, i, pid, site, 3, age, "Female", "X", year, -1440, out, unit, hosp, status, kind, "MICU", "PACU", "ED", "Home", "Floor", weight, height)


def test_cohort(rows):
    pt = rows(PATIENT, [
        patient(1, "a"), patient(2, "a", out=2000), patient(3, "b", age="> 89"), patient(4, "c", age=""), patient(5, "d", age="15"), patient(6, "e", age="16"),
        patient(7, "f", unit=239), patient(8, "g", hosp=""), patient(9, "h", status="Gone"), patient(10, "i", kind="stepdown/other"), patient(11, "j", site=2),
        patient(12, "k", hosp=None), patient(13, "l", status=None)])
    lab = rows(LAB, [(1, "x", 1.0, 0, 1)])
    vp = rows("patientunitstayid int, observationoffset int", [(2, 1), (11, 1)])
    results = rows("patientunitstayid int, apacheversion string, apachescore int, predictedhospitalmortality string", [
        (1, "IVa", 50, "-1"), (3, "IVa", 50, "0.2"), (4, "IV", 50, "-1")])
    pred = rows("patientunitstayid int, readmit int", [(1, 0), (3, 1)])
    out = {r.patientunitstayid: r for r in offset.cohort(pt, lab, vp, results, pred).collect()}
    # of the two stays of patient a the one with the larger discharge offset comes first
    assert {i for i, r in out.items() if r.excluded == 0} == {2, 3, 4, 6}
    assert out[1].exclusion_short_or_secondary_stay == 1 and out[7].exclusion_short_or_secondary_stay == 1 and out[10].exclusion_short_or_secondary_stay == 1
    assert [out[i].exclusion_missingoutcome for i in (8, 9, 12, 13)] == [1, 1, 1, 0] and out[13].excluded == 1
    assert (out[5].exclusion_non_adult, out[11].exclusion_missing_data) == (1, 1)
    assert (out[1].readmission_apache_pred, out[3].readmission_apache_combined, out[4].readmission_apache_pred) == (1, 1, 0)
    assert out[1].readmission_status == 0 and out[2].readmission_status is None


def test_extract(rows, spark):
    pt = rows(PATIENT, [patient(1, "a", height=1.7), patient(2, "b", height=49.0, weight=24.0, hosp="Expired")])
    hospital = rows("hospitalid int, teachingstatus int, numbedscategory string", [(1, 1, "<100")])
    names = "albumin bilirubin creatinine glucose hematocrit heartrate meanbp sodium fio2 pco2 pao2 ph respiratoryrate temperature bun urine wbc eyes motor verbal meds dialysis intubated".split()
    aps = rows("patientunitstayid int, " + ", ".join(f"{n} double" for n in names), [(1, *[-1.0 if n == "albumin" else 50.0 for n in names])])
    co = "aids diabetes cirrhosis hepaticfailure lymphoma leukemia metastaticcancer immunosuppression".split()
    pred = rows("patientunitstayid int, age double, electivesurgery int, readmit int, oobventday1 int, admitdiagnosis string, " + ", ".join(f"{c} int" for c in co),
                [(1, 66.0, 1, 0, -1, "SEPSIS", *[1] * 8)])
    res = rows("patientunitstayid int, apacheversion string, acutephysiologyscore int, apachescore int, predictedicumortality string, predictedhospitalmortality string",
               [(1, "IVa", 40, 55, "0.1", "0.2"), (1, "IV", 1, 1, "0.9", "0.9")])
    lab = rows(LAB, [(1, "sodium", 140.0, 0, 5), (1, "PT - INR", 1.5, 600, 601), (1, "FiO2", 50.0, 0, 1), (1, "paO2", 100.0, 0, 1)])
    vp = rows("""patientunitstayid int, observationoffset int, heartrate double, respiration double, sao2 double, temperature double,
        systemicsystolic double, systemicdiastolic double, systemicmean double""", [(1, 0, 80.0, 10.0, 98.0, 37.0, 120.0, 60.0, 80.0)])
    va = rows("patientunitstayid int, observationoffset int, noninvasivesystolic double, noninvasivediastolic double, noninvasivemean double", [(1, 0, 115.0, 70.0, 85.0)])
    nc = rows("""patientunitstayid int, nursingchartoffset int, nursingchartcelltypecat string, nursingchartcelltypevallabel string,
        nursingchartcelltypevalname string, nursingchartvalue string""", [(1, 0, "Vital Signs", "Heart Rate", "Heart Rate", "70"),
                                                                          (1, 0, "Vital Signs", "Invasive BP", "Invasive BP Systolic", "130")])
    dx = diagnosis.enrich(pred.select("patientunitstayid", "admitdiagnosis"), rows("admitdiagnosis string, code string", [("SEPSIS", "501.02")]),
                          rows("apache_3j_operative string, apache_3j_diagnosis string, apache_3j_bodysystem string, apache_2_diagnosis string",
                               [("Post-operative", "501", "Sepsis", "113")])).drop("admitdiagnosis")
    out = offset.extract("src", pt, hospital, aps, pred, res, pt, offset.labs(lab), offset.blood_gas(lab), offset.vitals(pt, vp, va), offset.vitals_charted(nc), dx)
    assert out.columns == header()
    r = {x.encounter_id: x for x in out.collect()}
    a, b = r["src_1"], r["src_2"]
    assert (a.patient_id, a.gender, a.height, a.hospital_death, a.icu_admit_source) == ("src_a", "F", 170.0, 0, "Operating Room / Recovery")
    assert a.bmi == pytest.approx(70 / 1.7**2) and a.pre_icu_los_days == 1.0
    assert (a.albumin_apache, a.bilirubin_apache, a.fio2_apache, a.ventilated_apache, a.apsiii, a.apache_3j_score) == (None, 50.0, 0.5, None, 40.0, 55.0)
    # charted values come first, the monitor fills the rest; pooled pressure takes a charted line before a monitored cuff
    assert (a.d1_heartrate_max, a.d1_resprate_max, a.d1_sysbp_max, a.d1_diasbp_min, a.d1_sysbp_noninvasive_max) == (70.0, 10.0, 130.0, 70.0, 115.0)
    # the first-hour value reads the first-hour window
    assert (a.d1_inr_max, a.h1_inr_max, a.d1_pao2fio2ratio_min, a.h1_sodium_max) == (1.5, None, 200.0, 140.0)
    assert (a.apache_3j_diagnosis, a.apache_2_diagnosis, a.apache_post_operative, a.aids) == ("501.02", "113", 1, 1)
    assert (b.height, b.weight, b.hospital_death, b.age) == (None, None, 1, None)


def test_body_systems(rows):
    three = rows("apache_3j_operative string, apache_3j_diagnosis string, apache_3j_bodysystem string, apache_2_diagnosis string", [("Non-operative", "101", "Heart", "115")])
    two = rows("apache_2_name string, apache_2_diagnosis string, apache_2_bodysystem string, apache_2_operative string", [
        ("x", "115", "Heart A", "Non-operative"), ("y", "115", "Heart B", "Post-operative")])
    df = rows("id int, apache_3j_diagnosis string, apache_2_diagnosis string, apache_post_operative int", [(1, "101.01", "115", 1), (2, "101", "115", 0), (3, None, None, None)])
    assert table(diagnosis.body_systems(df, three, two), "id", "apache_3j_bodysystem", "apache_2_bodysystem") == [
        (1, "Heart", "Heart B"), (2, "Heart", "Heart A"), (3, None, None)]
