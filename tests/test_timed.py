"""Absolute-time concepts on hand-made stays with boundary rows; expected values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from wardline.operators.windows import events_before, events_in_window, overlap_flag
from wardline.plans import timed
from wardline.registry import header

from helpers import table

CHART = "icustay_id int, itemid int, charttime timestamp, value string, valuenum double, error int"
LAB = "subject_id int, hadm_id int, itemid int, charttime timestamp, value string, valuenum double"
NOON = "2100-01-01 12:00:00"


@pytest.fixture
def stays(rows):
    return rows("subject_id int, hadm_id int, icustay_id int, intime timestamp, outtime timestamp", [
        (1, 10, 100, NOON, "2100-01-04 12:00:00"), (1, 10, 101, "2100-01-06 12:00:00", "2100-01-07 12:00:00"),
        (2, 20, 200, NOON, "2100-01-02 12:00:00")])


def test_window_ends_are_closed(rows, stays):
    ev = rows("icustay_id int, ts timestamp, n int", [
        (100, "2100-01-01 09:59:59", 1), (100, "2100-01-01 10:00:00", 2), (100, "2100-01-02 12:00:00", 3),
        (100, "2100-01-02 12:00:01", 4), (101, NOON, 5), (100, None, 6)])
    lo, hi = F.col("intime") - F.expr("interval 2 hour"), F.col("intime") + F.expr("interval 1 day")
    for cell in (600, 3600, 86400):
        assert table(events_in_window(stays, ev, ["icustay_id"], "ts", lo, hi, cell), "n") == [(2,), (3,)]
    assert table(events_in_window(stays, ev, ["icustay_id"], "ts", lo, hi, 3600, False, False), "n") == []
    assert table(events_before(stays, ev, ["icustay_id"], "ts", hi, salts=3), "n") == [(1,), (2,), (5,)]


def test_vitals_bounds_errors_and_pooling(rows, stays):
    chart = rows(CHART, [
        (100, 211, NOON, None, 80.0, None), (100, 220045, "2100-01-01 13:00:00", None, 90.0, 0),
        (100, 211, "2100-01-01 12:30:00", None, 299.9, 1),  # error
        (100, 211, "2100-01-01 14:00:00", None, 300.0, None),  # on the open bound
        (100, 211, "2100-01-01 15:00:00", None, 120.0, None),  # first day only
        (100, 678, "2100-01-01 12:10:00", None, 98.6, None), (100, 676, "2100-01-01 12:20:00", None, 36.0, None),
        (100, 646, "2100-01-01 12:10:00", None, 100.0, None), (100, 646, "2100-01-01 12:11:00", None, 100.5, None),
        (100, 51, "2100-01-01 12:10:00", None, 110.0, None), (100, 455, "2100-01-01 12:15:00", None, 90.0, None),
        (200, 807, "2100-01-03 12:00:00", None, 90.0, None)])  # outside the window
    out = timed.vitals(stays, chart).collect()
    assert [r.icustay_id for r in out] == [100]
    r = out[0]
    assert (r.d1_heartrate_min, r.d1_heartrate_max) == (80.0, 120.0)
    assert r.d1_heartrate_mean == pytest.approx((80 + 90 + 120) / 3)
    assert (r.h1_heartrate_min, r.h1_heartrate_max) == (80.0, 90.0)
    assert r.d1_temp_min == 36.0 and r.d1_temp_max == pytest.approx(37.0)
    assert r.d1_spo2_max == 100.0
    assert (r.d1_sysbp_min, r.d1_sysbp_max, r.d1_sysbp_invasive_min, r.d1_sysbp_noninvasive_max) == (90.0, 110.0, 110.0, 90.0)
    assert r.d1_pasys_invasive_min is None


def test_labs_ranges_and_frames(rows, stays):
    lab = rows(LAB, [
        (1, 10, 50862, "2100-01-01 11:00:00", None, 0.5),  # on the bound and one hour before
        (1, 10, 50862, "2100-01-01 20:00:00", None, 6.6),  # above the range
        (1, 10, 50862, "2100-01-01 21:00:00", None, 4.0), (1, 10, 50862, "2100-01-01 21:00:00", None, 4.5),
        (1, 10, 51300, NOON, None, 10.0), (1, 10, 51301, NOON, None, 12.0), (1, 10, 50912, NOON, None, -1.0)])
    r = {x.icustay_id: x for x in timed.labs(stays, lab).collect()}[100]
    assert (r.d1_albumin_min, r.d1_albumin_max, r.h1_albumin_min, r.h1_albumin_max) == (0.5, 4.5, 0.5, 0.5)
    assert (r.d1_wbc_min, r.d1_wbc_max, r.d1_creatinine_min) == (12.0, 12.0, None)
    literal = {x.icustay_id: x for x in timed.labs(stays, lab, literal_ranges=True).collect()}[100]
    assert literal.d1_albumin_max == 6.6
    wide = {x.laboffset: x for x in timed.labs_wide(stays, lab).where("icustay_id = 100").collect()}
    assert sorted(wide) == [-60.0, 0.0, 480.0, 540.0] and wide[540.0].albumin == 4.5


def gas(rows, stays, extra_lab=(), chart=()):
    lab = [(1, 10, 50821, NOON, None, 80.0), (1, 10, 50818, NOON, None, 40.0), (1, 10, 50820, NOON, None, 7.4),
           (1, 10, 50800, NOON, "ART", None), (1, 10, 50818, "2100-01-01 13:00:00", None, 44.0), *extra_lab]
    chart = list(chart) or [(100, 646, "2100-01-01 10:00:00", None, 97.0, 1), (100, 190, "2100-01-01 08:00:00", None, 0.5, None)]
    return timed.blood_gas(stays, rows(LAB, lab), rows(CHART, chart))


def test_gas_reach_is_closed_and_null_oxygen_is_dropped(rows, stays):
    out = gas(rows, stays).collect()
    assert len(out) == 1  # the 13:00 draw has no oxygen pressure
    r = out[0]
    assert (r.spo2, r.fio2, r.specimen_pred) == (97.0, 0.5, "ART")  # exactly 2 h and 4 h old; error rows count for SpO2
    assert r.aado2_calc == pytest.approx(0.5 * 713 - 40 / 0.8 - 80)
    assert r.pao2fio2 == pytest.approx(160)
    late = gas(rows, stays, chart=[(100, 646, "2100-01-01 09:59:59", None, 97.0, None), (100, 190, "2100-01-01 07:59:59", None, 0.5, None),
                                   (100, 190, "2100-01-01 11:00:00", None, 0.4, 1)]).first()
    assert late.spo2 is None and late.fio2 is None


def test_gas_with_two_specimens_is_dropped(rows, stays):
    assert gas(rows, stays, [(1, 10, 50800, NOON, "VEN", None)]).count() == 0


def test_gas_summary_picks_worst(rows, stays):
    later = "2100-01-01 18:00:00"
    more = [(1, 10, 50821, later, None, 45.0), (1, 10, 50818, later, None, 60.0), (1, 10, 50820, later, None, 7.1), (1, 10, 50800, later, "ART", None)]
    g = gas(rows, stays, more)
    r = {x.icustay_id: x for x in timed.blood_gas_summary(stays, g).collect()}
    assert (r[100].d1_oxygenation_score, r[100].d1_oxy_pao2, r[100].h1_oxygenation_score) == (15, 45.0, 0)
    assert (r[100].d1_acidbase_score, r[100].d1_acidbase_ph, r[100].h1_acidbase_score) == (4, 7.1, 0)
    assert (r[100].d1_pao2_min, r[100].d1_pao2_max, r[100].h1_pao2_min) == (45.0, 80.0, 80.0)
    assert r[200].d1_pao2_min is None and set(r) == {100, 101, 200}


@pytest.mark.parametrize("ph,pco2,points", [
    (7.19, 49.9, 12), (7.19, 50, 4), (7.2, 29, 9), (7.29, 39, 6), (7.29, 49, 3), (7.29, 50, 2), (7.3, 30, 0), (7.34, 45, 1),
    (7.35, 29, 5), (7.45, 34, 0), (7.49, 44, 2), (7.49, 45, 12), (7.5, 39, 3), (7.6, 24, 0), (7.7, 39, 3), (7.7, 40, 12)])
def test_acid_base_grid(spark, ph, pco2, points):
    df = spark.createDataFrame([(float(ph), float(pco2))], "ph double, pco2 double")
    assert df.select(timed.acid_base_points().alias("p")).first().p == points


def test_urine_subtracts_irrigant(rows, stays):
    out = rows("subject_id int, hadm_id int, icustay_id int, itemid int, charttime timestamp, value double", [
        (1, 10, 100, 40055, NOON, 300.0), (1, 10, 100, 227488, "2100-01-02 12:00:00", 100.0),
        (1, 10, 100, 40055, "2100-01-02 12:00:01", 900.0), (1, 10, 101, 1, "2100-01-06 13:00:00", 5.0)])
    assert table(timed.urine_output(stays, out), "icustay_id", "urineoutput") == [(100, 200.0)]


def coma(rows, stays, data):
    chart = rows(CHART, [(100, item, t, text, v, None) for item, t, text, v in data])
    return {r.icustay_id: r for r in timed.coma_scale(stays, chart).collect()}


def test_coma_previous_reading_expires_after_six_hours(rows, stays):
    first = [(454, NOON, None, 3.0), (723, NOON, None, 2.0), (184, NOON, None, 1.0)]
    near = coma(rows, stays, first + [(184, "2100-01-01 17:59:00", None, 1.0), (723, "2100-01-01 17:59:00", None, 1.0)])[100]
    assert (near.mingcs, near.gcsmotor) == (3 + 1 + 1, 3.0)
    far = coma(rows, stays, [(454, NOON, None, 5.0), (184, "2100-01-01 18:00:00", None, 1.0)])[100]
    assert (far.mingcs, far.gcsmotor, far.gcseyes) == (6 + 5 + 1, None, 1.0)


def test_coma_tube_counts_as_fifteen(rows, stays):
    r = coma(rows, stays, [(723, NOON, "1.0 ET/Trach", 1.0), (454, NOON, None, 1.0)])
    assert (r[100].mingcs, r[100].endotrachflag, r[100].gcsverbal) == (15.0, 1, 0.0)
    assert r[200].mingcs is None and r[200].endotrachflag is None
    after = coma(rows, stays, [(723, NOON, "1.0 ET/Trach", 1.0), (454, NOON, None, 1.0), (723, "2100-01-01 13:00:00", None, 3.0)])
    assert after[100].mingcs == 6 + 3 + 4  # readings taken with the tube in are not carried on


def test_smoking_notes(rows):
    notes = rows("subject_id int, text string", [
        (1, "Pt never smoked"), (2, "ex-smoker"), (3, "Smokes 10 cigs/day"), (4, "Tobacco: denies"), (5, "walks daily"),
        (6, "smoker"), (6, "He does not drink or smoke")])
    assert table(timed.smoking_from_notes(notes)) == [(1, 0), (2, 1), (3, 2), (4, 0), (5, None), (6, 0)]


def test_demographics(rows, stays):
    chart = rows(CHART, [(100, 762, NOON, None, 80.0, None), (100, 763, NOON, None, 90.0, None), (100, 762, NOON, None, 401.0, None),
                         (100, 920, "2099-12-01 12:00:00", None, 70.0, 0), (100, 225108, NOON, None, 1.0, None),
                         (200, 762, "2100-01-02 12:00:00", None, 80.0, None)])
    notes = rows("subject_id int, text string", [(1, "never smoked"), (2, "ex-smoker")])
    services = rows("hadm_id int, transfertime timestamp, curr_service string", [
        (10, NOON, "MED"), (10, "2100-01-06 13:00:00", "SURG"), (20, "2100-01-02 12:00:00", "LATE")])
    r = {x.icustay_id: x for x in timed.demographics(stays, chart, notes, services).collect()}
    assert (r[100].weight, r[100].height, r[100].smoking, r[100].first_service, r[100].readmission) == (85.0, 70.0, "Current Smoker", "MED", 0)
    assert (r[101].smoking, r[101].first_service, r[101].readmission) == ("Never Smoked", "SURG", 1)
    assert (r[200].weight, r[200].smoking, r[200].first_service) == (None, "Ex-Smoker", None)


def test_ventilation_overlap(rows, stays):
    spans = rows("icustay_id int, s timestamp, e timestamp", [
        (100, "2100-01-02 12:00:00", "2100-01-03 00:00:00"), (101, "2100-01-07 12:00:01", "2100-01-08 00:00:00"),
        (200, "2099-12-30 00:00:00", "2100-01-01 11:59:59"), (200, "2100-01-01 00:00:00", NOON)])
    out = overlap_flag(stays.select("icustay_id", "intime"), spans, "icustay_id", "intime", "s", "e", F.expr("interval 1 day"), "vent")
    assert table(out, "icustay_id", "vent") == [(100, 1), (101, 0), (200, 1)]


def score_row(spark, **given):
    names = [f"{v}_{e}" for v in ("heartrate", "mbp", "temp", "resprate", "hematocrit", "wbc", "creatinine", "bun", "sodium", "albumin",
                                  "bilirubin", "glucose") for e in ("min", "max")]
    names += ["vent", "arf", "urineoutput", "gcseyes", "gcsverbal", "gcsmotor", "endotrachflag", "acidbase_score", "oxygenation_score"]
    row = {n: None for n in names} | {k: float(v) for k, v in given.items()}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} double" for n in names))
    return timed.physiology_score(df).first()


def test_physiology_score_by_hand(spark):
    r = score_row(spark, heartrate_min=39, heartrate_max=110, mbp_min=60, mbp_max=100, temp_min=33, temp_max=40, resprate_min=5, resprate_max=20,
                  vent=1, arf=1, creatinine_min=1, creatinine_max=1.5, bun_min=90, bun_max=95, urineoutput=399, gcseyes=1, gcsverbal=1,
                  gcsmotor=6, endotrachflag=0, oxygenation_score=5)
    # heart 8 (low end), pressure 7, temperature 16, breathing 0 (ventilated), creatinine 10, nitrogen 12, urine 15, coma 16, oxygen 5
    assert r.apsiii == 8 + 7 + 16 + 0 + 10 + 12 + 15 + 16 + 5
    assert (r.heartrate, r.mbp, r.temp, r.creatinine, r.bun) == (39.0, 60.0, 33.0, 1.5, 95.0)
    assert r.albumin_score is None and r.apsiii_prob == pytest.approx(0.4428, abs=1e-4)


@pytest.mark.parametrize("eyes,verbal,motor,points", [(1, 1, 2, 48), (1, 1, 4, 33), (1, 3, 5, None), (1, 4, 6, None), (3, 1, 6, 15),
                                                      (4, 2, 5, 13), (4, 3, 6, 10), (2, 4, 4, 13), (2, 4, 5, 8), (4, 5, 5, 3), (4, 5, 6, 0)])
def test_coma_grid(spark, eyes, verbal, motor, points):
    assert score_row(spark, gcseyes=eyes, gcsverbal=verbal, gcsmotor=motor, endotrachflag=0).gcs_score == points


def test_tie_takes_the_high_value(spark):
    r = score_row(spark, heartrate_min=45, heartrate_max=115)
    assert (r.heartrate_score, r.heartrate) == (5, 115.0)


def cohort_inputs(rows):
    stays = rows("subject_id int, hadm_id int, icustay_id int, dbsource string, first_careunit string, first_wardid int, los double, intime timestamp, outtime timestamp", [
        (1, 10, 100, "a", "MICU", 1, 3.0, NOON, "2100-01-04 12:00:00"), (1, 11, 101, "a", "MICU", 1, 1.0, "2100-02-06 12:00:00", "2100-02-07 12:00:00"),
        (2, 20, 200, "a", "MICU", 1, 1.0, NOON, "2100-01-02 12:00:00"), (3, 30, 300, "a", "MICU", 1, 1.0, NOON, "2100-01-02 12:00:00"),
        (4, 40, 400, "a", "MICU", 1, 1.0, NOON, "2100-01-02 12:00:00"), (5, 50, 500, "a", "MICU", 1, 1.0, NOON, "2100-01-02 12:00:00")])
    patients = rows("subject_id int, gender string, dob timestamp", [
        (1, "F", "1800-01-01 00:00:00"), (2, "M", "2085-01-01 00:00:00"), (3, "M", "2050-01-01 00:00:00"), (4, "M", "2050-01-01 00:00:00"),
        (5, "M", "2050-01-01 00:00:00")])
    admissions = rows("""hadm_id int, admittime timestamp, dischtime timestamp, deathtime timestamp, admission_type string, admission_location string,
        discharge_location string, ethnicity string, hospital_expire_flag int""", [
        (h, t, "2100-03-01 00:00:00", d, kind, "HMO REFERRAL/SICK", "ICF", "ASIAN - THAI", 0) for h, t, d, kind in (
            (10, "2099-12-31 12:00:00", "2100-01-04 12:00:00", "ELECTIVE"), (11, "2100-02-05 12:00:00", None, "URGENT"), (20, NOON, None, "URGENT"),
            (30, NOON, None, "URGENT"), (40, NOON, None, "URGENT"), (50, NOON, None, "URGENT"))])
    services = rows("hadm_id int, transfertime timestamp, curr_service string", [(h, NOON, "MED") for h in (10, 20, 30, 40, 50)] + [(11, "2100-02-06 12:00:00", "MED")])
    beats = [(100, NOON), (100, "2100-01-01 20:00:00"), (101, "2100-02-06 13:00:00"), (101, "2100-02-06 20:00:00"), (200, NOON), (200, "2100-01-01 20:00:00"),
             (300, NOON), (300, "2100-01-01 15:59:59"), (400, NOON), (400, "2100-01-01 16:00:00")]
    chart = rows(CHART, [(s, 211, t, None, 80.0, None) for s, t in beats] + [(500, 211, NOON, None, 0.0, None), (400, 128, "2100-01-01 13:00:00", "DNR / DNI", None, None)])
    return stays, patients, admissions, services, chart


def test_cohort_flags(rows):
    out = {r.icustay_id: r for r in timed.cohort(*cohort_inputs(rows)).collect()}
    assert (out[100].age, out[100].excluded, out[100].admission_rank) == (91.6, 0, 1)
    assert (out[101].exclusion_readmission, out[101].excluded, out[101].readmit, out[101].admission_rank) == (1, 1, 1, 2)
    assert (out[200].exclusion_age, out[200].excluded) == (1, 1)
    assert (out[300].exclusion_shortstay, out[300].excluded) == (1, 1)  # one second under four hours
    assert (out[400].exclusion_shortstay, out[400].excluded, out[400].dnrtime_days) == (0, 0, pytest.approx(1 / 24))
    assert (out[500].exclusion_nodata, out[500].excluded, out[500].age) == (1, 1, None)
    strict = {r.icustay_id: r for r in timed.cohort(*cohort_inputs(rows), exclude_limited_care=True).collect()}
    assert strict[400].excluded == 1


def test_extract_fills_the_header(rows):
    stays, patients, admissions, services, chart = cohort_inputs(rows)
    lab = rows(LAB, [(1, 10, 50912, NOON, None, 2.0), (1, 10, 50821, NOON, None, 60.0), (1, 10, 50816, NOON, None, 50.0), (1, 10, 50800, NOON, "ART", None)])
    output = rows("subject_id int, hadm_id int, icustay_id int, itemid int, charttime timestamp, value double", [(1, 10, 100, 40055, NOON, 300.0)])
    notes = rows("subject_id int, text string", [(1, "ex-smoker")])
    codes = rows("hadm_id int, icd9_code string", [(10, "4019")])
    key = timed.STAY + ["intime", "outtime"]
    s = stays.select(*key)
    vit, lb = timed.vitals(s, chart), timed.labs(s, lab)
    gases = timed.blood_gas_summary(s, timed.blood_gas(s, lab, chart, first_day_only=True))
    urine = timed.urine_output(s, output)
    aps = timed.apsiii(s, vit, lb, gases, timed.coma_scale(s, chart), urine, codes)
    demo = timed.demographics(s, chart, notes, services)
    co = timed.cohort(stays, patients, admissions, services, chart)
    out = timed.extract(stays, patients, admissions, co.where("excluded = 0"), demo, vit, lb, gases, aps)
    assert out.columns == header()
    r = {x.encounter_id: x for x in out.collect()}
    assert set(r) == {"100", "400"}
    a = r["100"]
    assert (a.ethnicity, a.hospital_admit_source, a.hospital_disch_location) == ("Asian", "Direct Admit", "Other External")
    assert (a.icu_death, a.elective_surgery, a.smoking_status, a.pre_icu_los_days) == (1, 1, "Ex-Smoker", 1.0)
    assert (a.d1_heartrate_min, a.h1_heartrate_max, a.d1_creatinine_max) == (80.0, 80.0, 2.0)
    # creatinine 2.0 with 300 ml of urine and no chronic dialysis is acute renal failure
    assert (a.arf_apache, a.creatinine_apache, a.urineoutput_apache) == (1, 2.0, 300.0)
    assert (a.pao2_apache, a.fio2_apache, a.d1_pao2fio2ratio_min) == (60.0, 0.5, 120.0)
    assert a.apsiii == 10 + 15 + 5 and a.hospital_bed_size_numeric == 651 and a.hospital_type is None
