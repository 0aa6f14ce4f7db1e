"""Concepts from a source with absolute timestamps and long event tables.

Tables: stays(subject_id, hadm_id, icustay_id, intime, outtime, ...), chart(icustay_id, itemid,
charttime, value, valuenum, error), lab(subject_id, hadm_id, itemid, charttime, value, valuenum),
output(subject_id, hadm_id, icustay_id, itemid, charttime, value) and the small tables named in
each function. Every function returns a lazy frame with one row per stay unless it says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.text import first_match_code
from ..operators import joins as J
from ..operators import ordered as O
from ..operators import pivot as P
from ..operators import score as SC
from ..operators.cohort import flag_exclusions
from ..operators.conform import apply_field_map
from ..operators.windows import events_in_window, overlap_flag
from ..registry import header_schema
from . import timed_rules as R

STAY = ["subject_id", "hadm_id", "icustay_id"]
DAY = 86_400
FRAMES = {"d1": {"days": 1}, "h1": {"hours": 1}}


def _not_error(events: DataFrame) -> Column:
    return S.differs("error", 1)


def _frame(ts: str, name: str) -> Column:
    return F.col(ts) <= S.shift("intime", **FRAMES[name])


# --- vitals ---------------------------------------------------------------------------------
def vitals(stays: DataFrame, chart: DataFrame) -> DataFrame:
    """min, max and mean per vital sign for the first day and first hour, from one scan."""
    rules = {item: (label, lo, hi, lc, hc) for label, items, lo, hi, lc, hc in R.VITALS for item in items}
    typed = J.with_rules(chart.where(_not_error(chart)).select("icustay_id", "charttime", "itemid", "valuenum"),
                         "itemid", rules)
    celsius = F.when(F.col("label") == "tempf", S.fahrenheit_to_celsius("valuenum")).otherwise(F.col("valuenum"))
    events = typed.select("icustay_id", "charttime", F.when(S.within_rule("valuenum"), F.col("label")).alias("label"),
                          celsius.alias("v"))
    seen = events_in_window(
        stays.select(*STAY, "intime"), events, ["icustay_id"], "charttime",
        S.shift("intime", hours=-2), S.shift("intime", days=1),
    )
    frames = {name: _frame("charttime", name) for name in FRAMES}
    return P.summarise(seen, STAY, "label", "v", R.VITAL_COLUMNS, ["min", "max", "mean"], frames)


# --- chemistry --------------------------------------------------------------------------------
def _lab_draws(stays: DataFrame, lab: DataFrame, first_day_only: bool, literal_ranges: bool) -> DataFrame:
    """Cleaned analyte values of each stay with their minute offset."""
    rules = {}
    for label, items, lo, hi in R.LABS:
        # read literally, a two-sided check asks for a value below and above the range at once
        open_ended = literal_ranges and lo is not None
        rules.update({i: (label, None if open_ended else lo, None if open_ended else hi, True, True) for i in items})
    rows = lab.where(F.col("valuenum") > 0).select("hadm_id", "charttime", "itemid", "valuenum")
    events = J.with_rules(rows, "itemid", rules).select(
        "hadm_id", "charttime", "label", F.when(S.within_rule("valuenum"), F.col("valuenum")).alias("v"))
    end = S.shift("outtime", hours=1)
    if first_day_only:
        end = F.least(end, S.shift("intime", days=1))
    seen = events_in_window(
        stays.select("hadm_id", "icustay_id", "intime", "outtime"), events, ["hadm_id"], "charttime",
        S.shift("intime", hours=-1), end, cell_seconds=DAY)
    return seen.select("icustay_id", "label", "v", S.elapsed("intime", "charttime", "minutes").alias("laboffset"))


def labs_wide(stays: DataFrame, lab: DataFrame, literal_ranges: bool = False) -> DataFrame:
    """One row per stay and draw time with a column per analyte and the minute offset."""
    draws = _lab_draws(stays, lab, False, literal_ranges)
    return P.long_to_wide(draws, ["icustay_id", "laboffset"], "label", "v", [r[0] for r in R.LABS])


def labs(stays: DataFrame, lab: DataFrame, literal_ranges: bool = False) -> DataFrame:
    """min and max per analyte for the first day and first hour (from one hour before admission).

    Simultaneous values of one analyte count as their largest.
    """
    draws = _lab_draws(stays, lab, True, literal_ranges)
    once = draws.groupBy("icustay_id", "laboffset", "label").agg(F.max("v").alias("v"))
    frames = {"d1": S.within("laboffset", -60, 1440), "h1": S.within("laboffset", -60, 60)}
    stems = {r[0]: [r[0]] for r in R.LABS}
    return P.summarise(once, ["icustay_id"], "label", "v", stems, ["min", "max"], frames)


# --- blood gas ----------------------------------------------------------------------------------
def _fio2_chart() -> Column:
    v, item = F.col("valuenum"), F.col("itemid")
    percent = F.when(S.within(v, 20, 100, False, True), v / 100.0)
    fraction = S.keep_within(v, 0.2, 1, False, True)
    return (
        F.when(item.isin(*R.FIO2_MIXED_ITEMS), F.coalesce(fraction, percent))
        .when(item.isin(*R.FIO2_PERCENT_ITEMS), percent)
        .when(item.isin(*R.FIO2_FRACTION_ITEMS), fraction)
    )


def blood_gas(stays: DataFrame, lab: DataFrame, chart: DataFrame, first_day_only: bool = False, few_stays: bool = False) -> DataFrame:
    """One row per stay and gas: measured values, nearest charted SpO2 and FiO2, specimen guess.

    Gases without an oxygen pressure are left out, as are times with two specimens. ``few_stays``: see ``events_in_window``.
    """
    stay = stays.select(*STAY, "intime", "outtime")
    end = S.shift("outtime", days=1)
    if first_day_only:
        end = F.least(end, S.shift("intime", days=1))
    rules = {item: (name, lo, hi, True, True) for name, item, lo, hi in R.GASES}
    rules.update({item: (None, None, None, True, True) for item in (*R.GAS_OTHER_ITEMS, R.GAS_SPECIMEN_ITEM)})
    rows = J.with_rules(lab.select("subject_id", "charttime", "itemid", "value", "valuenum"), "itemid", rules)
    valid = F.when((F.col("valuenum") > 0) & S.within_rule("valuenum"), F.col("valuenum"))
    scaled = (F.when(F.col("label") == "fio2", S.percent_to_fraction(valid))
              .when(F.col("label") == "hematocrit", valid / 100.0).otherwise(valid))
    start, keys = S.shift("intime", hours=-1), [*STAY, "intime", "charttime"]
    # the specimen text travels beside the values, so the laboratory table is read once
    text = F.when(F.col("itemid") == R.GAS_SPECIMEN_ITEM, F.col("value")).alias("specimen")
    draws = rows.select("subject_id", "charttime", "label", scaled.alias("v"), text)
    seen = events_in_window(stay, draws, ["subject_id"], "charttime", start, end, DAY, few_stays=few_stays)
    measured = seen.groupBy(*keys).agg(
        *[F.max(F.when(F.col("label") == name, F.col("v"))).alias(name) for name, *_ in R.GASES],
        F.max("specimen").alias("specimen"), F.count("specimen").alias("n_sp"))
    gas = measured.where(F.col("po2").isNotNull() & (F.col("n_sp") < 2)).drop("n_sp")
    near = stay.select("icustay_id", "intime", "outtime")
    start = S.shift("intime", hours=-5)  # an hour before admission plus the longest reach

    saturation = F.col("itemid").isin(*R.SPO2_ITEMS)
    oxygen = F.col("itemid").isin(*R.FIO2_MIXED_ITEMS, *R.FIO2_PERCENT_ITEMS, *R.FIO2_FRACTION_ITEMS) & _not_error(chart)
    read = chart.where(saturation | oxygen).select(
        "icustay_id", "charttime", saturation.alias("is_spo2"), F.when(saturation, S.keep_within("valuenum", 0, 100, False, True)).alias("a"),
        F.when(oxygen, _fio2_chart()).alias("b"))
    beside = events_in_window(near, read, ["icustay_id"], "charttime", start, end, DAY).groupBy(
        "icustay_id", F.col("charttime").alias("t")).agg(
        F.max("a").alias("spo2"), F.max("b").alias("fio2_chart"), F.max("is_spo2").alias("has_spo2"), F.min("is_spo2").alias("only_spo2"))
    gas = O.asof_backward(gas, ["icustay_id"], "charttime", [
        O.Carried(beside, "t", R.SPO2_REACH_SECONDS, {"spo2": "spo2"}, F.col("has_spo2")),
        O.Carried(beside, "t", R.FIO2_REACH_SECONDS, {"fio2_chart": "fio2_chart"}, ~F.col("only_spo2")),
    ])
    z = F.lit(R.SPECIMEN_INTERCEPT) + R.SPECIMEN_PO2 * F.col("po2") + S.imputed_terms(R.SPECIMEN_TERMS)
    gas = gas.withColumn("specimen_prob", S.logistic(z)).withColumn("fio2", F.coalesce("fio2", "fio2_chart"))
    guess = F.when(F.col("specimen_prob") > R.ARTERIAL_CUTOFF, F.lit(R.ARTERIAL))
    calc = S.aado2("fio2", "pco2", "po2")
    return gas.select(
        "*", F.coalesce("specimen", guess).alias("specimen_pred"), calc.alias("aado2_calc"),
        S.pf_ratio("po2", "fio2").alias("pao2fio2"), F.coalesce("aado2", calc).alias("aado2_any"),
    )


def oxygenation_points(fio2="fio2", aado2="aado2", po2="po2") -> Column:
    high = (F.col(fio2) >= R.HIGH_FIO2) & F.col(aado2).isNotNull()
    return F.when(high, S.band(aado2, *R.AADO2_BANDS)).otherwise(S.band(po2, *R.PAO2_BANDS))


def acid_base_points(ph="ph", pco2="pco2") -> Column:
    return SC.grid_score(ph, pco2, R.ACID_BASE)


def blood_gas_summary(stays: DataFrame, gases: DataFrame) -> DataFrame:
    """Range of every gas value and the worst oxygenation and acid-base gas, arterial samples only.

    Both frames and both 'worst' picks come out of one aggregation.
    """
    art = gases.where(F.col("specimen_pred") == R.ARTERIAL).select(
        "*", oxygenation_points().alias("oxy"), acid_base_points().alias("ab"))
    art = art.select("*", *[_frame("charttime", name).alias(f"in_{name}") for name in FRAMES])
    oxy_order = F.struct(O.descending("oxy").alias("a"), O.nulls_last("po2").alias("b"),
                         F.col("fio2").isNull().alias("c"), F.col("charttime").alias("d"))
    ab_order = F.struct(O.descending("ab").alias("a"), O.descending("pco2").alias("b"), F.col("charttime").alias("c"))
    aggs, outs = [], []
    for name in FRAMES:
        for stem, src in R.GAS_SUMMARY.items():
            for end in ("min", "max"):
                aggs.append(F.expr(f"{end}(`{src}`) filter (where in_{name}) as {name}_{stem}_{end}"))
                outs.append(f"{name}_{stem}_{end}")
        inside = F.col(f"in_{name}")
        aggs.append(F.min_by(F.struct("po2", "pco2", "fio2", "aado2", "oxy"), F.when(inside, oxy_order)).alias(f"{name}_o"))
        aggs.append(F.min_by(F.struct("ph", "pco2", "ab"), F.when(inside & F.col("ab").isNotNull(), ab_order)).alias(f"{name}_a"))
        outs += [f"{name}_o.{src} as {name}_{out}" for src, out in (
            ("po2", "oxy_pao2"), ("pco2", "oxy_paco2"), ("fio2", "oxy_fio2"), ("aado2", "oxy_aado2"), ("oxy", "oxygenation_score"))]
        outs += [f"{name}_a.{src} as {name}_{out}" for src, out in (
            ("ph", "acidbase_ph"), ("pco2", "acidbase_paco2"), ("ab", "acidbase_score"))]
    per_stay = art.groupBy("icustay_id").agg(*aggs).selectExpr("icustay_id", *outs)
    return stays.select(*STAY).join(per_stay, "icustay_id", "left")


# --- urine, coma scale ------------------------------------------------------------------------
def urine_output(stays: DataFrame, output: DataFrame) -> DataFrame:
    """Urine volume of the first day; irrigant put in is subtracted."""
    rows = output.where(F.col("itemid").isin(*R.URINE_ITEMS)).select(*STAY, "itemid", "charttime", "value")
    seen = events_in_window(stays.select(*STAY, "intime"), rows, STAY, "charttime",
                            F.col("intime"), S.shift("intime", days=1))
    return P.signed_sum(seen, STAY, "value", F.col("itemid") == R.IRRIGANT_ITEM, "urineoutput")


def coma_scale(stays: DataFrame, chart: DataFrame) -> DataFrame:
    """Lowest coma scale of the first day with its components.

    A missing component takes the previous reading if that is under six hours old, else normal;
    intubated patients count as 15.
    """
    items = [i for ids in R.GCS_ITEMS.values() for i in ids]
    tube = F.lit(False)
    for item, text in R.GCS_TUBE_TEXT.items():
        tube = tube | ((F.col("itemid") == item) & (F.col("value") == text))
    rows = chart.where(F.col("itemid").isin(*items) & _not_error(chart)).select(
        "icustay_id", "charttime",
        J.label_items("itemid", {k: list(v) for k, v in R.GCS_ITEMS.items()}).alias("label"),
        F.when(S.is_true(tube), F.lit(0.0)).otherwise(F.col("valuenum")).alias("v"))
    seen = events_in_window(stays.select("icustay_id", "intime"), rows, ["icustay_id"], "charttime",
                            F.col("intime"), S.shift("intime", days=1))
    parts = list(R.GCS_ITEMS)
    wide = P.long_to_wide(seen, ["icustay_id", "charttime"], "label", "v", parts)
    both = O.previous_within(wide, ["icustay_id"], "charttime", parts, R.GCS_REACH_SECONDS)
    was_tubed = S.is_true(F.col("prev_verbal") == 0)
    tubed_now = S.is_true(F.col("verbal") == 0) | (F.col("verbal").isNull() & was_tubed)

    def known(part):
        earlier = F.when(~was_tubed, F.col(f"prev_{part}"))
        return F.coalesce(F.col(part), earlier, F.lit(float(R.GCS_NORMAL[part])))

    total = known("motor") + known("verbal") + known("eyes")
    scored = both.select(
        "icustay_id", "charttime", F.when(tubed_now, F.lit(15.0)).otherwise(total).alias("mingcs"),
        *[F.coalesce(p, f"prev_{p}").alias(f"gcs{p}") for p in parts],
        S.is_true(F.col("verbal") == 0).cast("int").alias("endotrachflag"),
    )
    take = ["mingcs", *[f"gcs{p}" for p in parts], "endotrachflag"]
    worst = O.first_row(scored, ["icustay_id"], [F.col("mingcs"), F.col("charttime")], take)
    return stays.select(*STAY).join(worst, "icustay_id", "left")


def coma_points(eyes="gcseyes", verbal="gcsverbal", motor="gcsmotor", tube="endotrachflag") -> Column:
    def table(rows):
        return SC.table_score([({verbal: v, motor: m}, pts) for v, m, pts in rows])

    return (
        F.when(F.col(tube) == 1, F.lit(0))
        .when(F.col(eyes) == 1, table(R.COMA_EYES_CLOSED))
        .when(F.col(eyes) > 1, table(R.COMA_EYES_OPEN))
    )


# --- demographics -------------------------------------------------------------------------------
def smoking_from_notes(notes: DataFrame) -> DataFrame:
    """Smoking code per patient: the most negative statement in any note wins."""
    return notes.groupBy("subject_id").agg(
        F.min(first_match_code("text", R.SMOKING_NOTES)).alias("note_smoking"))


def latest_service(stays: DataFrame, services: DataFrame, by: list[str]) -> DataFrame:
    """Service in charge at the end of the first day."""
    held = services.groupBy("hadm_id", "transfertime").agg(F.min("curr_service").alias("curr_service"))
    asked = stays.select(*dict.fromkeys(["hadm_id", *by]), S.shift("intime", days=1).alias("cutoff"))
    latest = F.struct("transfertime", "curr_service")
    found = O.totals_before(asked, ["hadm_id"], "cutoff", held, "transfertime", maxima={"latest": latest})
    # of several stays of one admission the one that saw the latest transfer
    return found.where("latest is not null").groupBy(*by).agg(F.max("latest").alias("latest")).select(
        *by, F.col("latest.curr_service").alias("first_service"))


def demographics(stays: DataFrame, chart: DataFrame, notes: DataFrame, services: DataFrame) -> DataFrame:
    """Weight, height, pregnancy, smoking, service and readmission per stay."""
    items = [i for rule in R.DEMOGRAPHIC_ITEMS for i in rule[1]]
    value = None
    for _, ids, lo, hi in R.DEMOGRAPHIC_ITEMS:
        cond = F.col("itemid").isin(*ids)
        kept = S.keep_within("valuenum", lo, hi)
        value = F.when(cond, kept) if value is None else value.when(cond, kept)
    user = (F.col("itemid") == R.TOBACCO_USE_ITEM) & (F.col("valuenum") == 1)
    label = J.label_items("itemid", {r[0]: list(r[1]) for r in R.DEMOGRAPHIC_ITEMS})
    rows = chart.where(
        F.col("itemid").isin(*items) & F.col("valuenum").isNotNull() & _not_error(chart)
    ).select("icustay_id", "charttime", label.alias("label"),
             F.when(user, F.lit(2.0)).otherwise(value).alias("v"))

    def of(name):
        return F.when(F.col("label") == name, F.col("v"))

    measured = {"weight": of("weight"), "height": of("height")}
    counted = {f"n_{n}": c.isNotNull().cast("long") for n, c in measured.items()}
    cutoff = stays.select("icustay_id", S.shift("intime", days=1).alias("cutoff"))
    known = O.totals_before(cutoff, ["icustay_id"], "cutoff", rows, "charttime", measured | counted,
                            {"pregnant": of("pregnant"), "item_smoking": of("smoking")})
    demo = known.select("icustay_id", *[F.try_divide(n, f"n_{n}").alias(n) for n in measured], "pregnant", "item_smoking")
    numbered = O.sequence(stays.select(*STAY, "intime"), ["hadm_id"], [F.col("intime").asc_nulls_last(), F.col("icustay_id")],
                          O.time_cell("intime", 7 * DAY), "stay_no")
    named = S.map_codes(F.col("item_smoking").cast("int"), R.SMOKING_LABELS)
    noted = S.map_codes("note_smoking", R.SMOKING_LABELS)
    known = J.assemble(numbered, [demo, latest_service(stays, services, ["icustay_id"])], "icustay_id")
    return J.assemble(known, [smoking_from_notes(notes)], "subject_id").select(
        *STAY, "weight", "height", "pregnant", F.coalesce(named, noted, F.lit("Unknown")).alias("smoking"), "first_service",
        (F.col("stay_no") > 1).cast("int").alias("readmission"))


# --- acute physiology score -----------------------------------------------------------------------
def renal_failure(stays: DataFrame, lab_summary: DataFrame, urine: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """1 for high creatinine with little urine in a patient not on chronic dialysis."""
    chronic = P.any_flag(diagnoses, ["hadm_id"], F.col("icd9_code").isin(*R.CHRONIC_DIALYSIS_CODES), "ckd")
    hit = ((F.col("d1_creatinine_max") >= R.RENAL_FAILURE_CR) & (F.col("urineoutput") < R.RENAL_FAILURE_URINE)
           & (F.col("ckd") == 0))
    parts = [lab_summary.select("icustay_id", "d1_creatinine_max"), urine.select("icustay_id", "urineoutput")]
    measured = J.assemble(stays.select("hadm_id", "icustay_id"), parts, "icustay_id")
    return J.assemble(measured, [chronic], "hadm_id").select("icustay_id", S.is_true(hit).cast("int").alias("arf"))


def _points(name: str, value: str) -> Column:
    plain = S.band(value, *R.BANDS[name])
    if name == "resprate":
        calm = (F.col("vent") == 1) & (F.col(value) < R.VENTILATED_RESPRATE_BELOW)
        return SC.band_score_if(S.is_true(calm), F.lit(0), plain)
    if name == "creatinine":
        return SC.band_score_if(S.is_true(F.col("arf") == 1), S.band(value, *R.RENAL_FAILURE_CREATININE), plain)
    return plain


def physiology_score(wide: DataFrame) -> DataFrame:
    """Score every variable, keep the worse end, add up.

    ``wide`` has one row per stay with ``<variable>_min`` and ``<variable>_max`` for the banded
    variables, plus vent, arf, urineoutput, the coma components and the two gas scores.
    """
    scores, values = {}, {}
    for name in R.BANDS:
        lo, hi = f"{name}_min", f"{name}_max"
        if name in R.ALWAYS_HIGH:
            scores[name], values[name] = _points(name, hi), F.col(hi)
        else:
            scores[name], values[name] = SC.worst_of(lo, hi, _points(name, lo), _points(name, hi))
    scores["urineoutput"] = S.band("urineoutput", *R.URINE_BANDS)
    scores["gcs"] = coma_points()
    parts = wide.select(
        "*", *[c.cast("int").alias(f"{n}_score") for n, c in scores.items()],
        *[c.alias(n) for n, c in values.items()])
    all_scores = [f"{n}_score" for n in scores] + ["acidbase_score", "oxygenation_score"]
    total = S.sum_known(all_scores)
    return parts.select("*", total.alias("apsiii")).withColumn(
        "apsiii_prob", S.logistic(R.MORTALITY_INTERCEPT + R.MORTALITY_SLOPE * F.col("apsiii")))


def apsiii(stays: DataFrame, vital_summary: DataFrame, lab_summary: DataFrame, gas_summary: DataFrame,
           coma: DataFrame, urine: DataFrame, diagnoses: DataFrame, ventilation: DataFrame | None = None) -> DataFrame:
    """Acute Physiology Score III of the first day with components and mortality estimate."""
    base = stays.select(*STAY, "intime")
    if ventilation is None:
        vent = base.select("icustay_id", F.lit(0).alias("vent"))
    else:
        vent = overlap_flag(base.select("icustay_id", "intime"), ventilation, "icustay_id", "intime",
                            "starttime", "endtime", F.expr("INTERVAL 1 DAY"), "vent").drop("intime")
    def first_day(names):
        return [f"d1_{n}_{e} as {n}_{e}" for n in names for e in ("min", "max")]

    v = vital_summary.selectExpr("icustay_id", *first_day(("heartrate", "mbp", "temp", "resprate")),
                                 "d1_glucose_min as vg_min", "d1_glucose_max as vg_max")
    lb = lab_summary.selectExpr(
        "icustay_id", *first_day(("hematocrit", "wbc", "creatinine", "bun", "sodium", "albumin", "bilirubin")),
        "d1_glucose_min as lg_min", "d1_glucose_max as lg_max")
    g = gas_summary.selectExpr(
        "icustay_id", "d1_oxy_pao2 as pao2", "d1_oxy_fio2 as fio2", "d1_oxy_paco2 as paco2_oxy", "d1_oxy_aado2 as aado2",
        "d1_oxygenation_score as oxygenation_score", "d1_acidbase_ph as ph", "d1_acidbase_paco2 as paco2",
        "d1_acidbase_score as acidbase_score")
    arf = renal_failure(stays, lab_summary, urine, diagnoses)
    parts = [vent, v, lb, g, coma.drop("subject_id", "hadm_id"), urine.select("icustay_id", "urineoutput"), arf]
    wide = J.assemble(base.drop("intime"), parts, "icustay_id").select(
        "*", F.least("vg_min", "lg_min").alias("glucose_min"), F.greatest("vg_max", "lg_max").alias("glucose_max"),
    ).drop("vg_min", "vg_max", "lg_min", "lg_max")
    ends = [f"{n}_{e}" for n in R.BANDS for e in ("min", "max")]
    return physiology_score(wide).drop(*ends)


# --- cohort and extract -----------------------------------------------------------------------------
def cohort(stays: DataFrame, patients: DataFrame, admissions: DataFrame, services: DataFrame,
           chart: DataFrame, exclude_limited_care: bool = False) -> DataFrame:
    """Stays with exclusion flags; ``excluded`` is 0 only when every condition is known to hold."""
    hr = chart.where(F.col("itemid").isin(*R.HEART_RATE_ITEMS) & (F.col("valuenum") > 0) & _not_error(chart))
    seen = events_in_window(
        stays.select("icustay_id", "intime", "outtime"), hr.select("icustay_id", "charttime"), ["icustay_id"],
        "charttime", S.shift("intime", days=-1), S.shift("outtime", days=1), DAY, False, False)
    span = P.observed_span(seen, ["icustay_id"], "charttime", "intime_hr", "outtime_hr")
    codes = chart.where(F.col("itemid").isin(*R.CODE_STATUS_ITEMS) & _not_error(chart))
    dnr = P.first_time_where(codes, ["icustay_id"], "charttime", F.col("value").isin(*R.LIMITED_CARE_TEXT), "dnrtime")
    service = latest_service(stays, services, ["hadm_id"])
    base = J.sorted_join(stays.select(*STAY, "intime", "outtime"), patients.select("subject_id", "dob", "gender"), "subject_id")
    base = J.sorted_join(J.sorted_join(base, admissions.select("hadm_id", "admittime"), "hadm_id"), service, "hadm_id")
    base = J.assemble(base, [dnr, span], "icustay_id")
    numbered = O.sequence(base, ["subject_id"], [F.col("intime_hr").asc_nulls_last(), F.col("icustay_id")],
                          O.time_cell("intime_hr", 7 * DAY), "icustay_num")
    ranked = O.sequence(numbered, ["subject_id"], [F.col("admittime").asc_nulls_last()],
                        O.time_cell("admittime", 7 * DAY), "admission_rank", ties=True)
    long_enough = F.col("outtime_hr") - F.col("intime_hr") >= F.expr(f"INTERVAL {R.MIN_STAY_HOURS} HOUR")
    full = ranked.select(
        *STAY, "intime_hr", "outtime_hr", "admission_rank", "icustay_num", "gender", "first_service",
        (F.col("icustay_num") > 1).cast("int").alias("readmit"),
        S.age_topcoded("dob", "intime_hr").alias("age"),
        S.elapsed("intime_hr", "dnrtime", "days").alias("dnrtime_days"),
    )
    rules = {
        "exclusion_nodata": F.col("intime_hr").isNull(),
        "exclusion_readmission": F.col("icustay_num") > 1,
        "exclusion_age": F.col("age") < R.MIN_AGE,
        "exclusion_shortstay": ~long_enough,
    }
    if exclude_limited_care:
        rules["exclusion_limited_care"] = F.col("dnrtime_days") < R.MIN_STAY_HOURS / 24
    flagged = flag_exclusions(full, rules, "any_flag")
    qualified = S.is_true((F.col("any_flag") == 0) & (F.col("age") >= R.MIN_AGE) & long_enough)
    return flagged.withColumn("excluded", (~qualified).cast("int")).drop("any_flag")


def extract(stays: DataFrame, patients: DataFrame, admissions: DataFrame, included: DataFrame, demo: DataFrame,
            vital_summary: DataFrame, lab_summary: DataFrame, gas_summary: DataFrame, aps: DataFrame) -> DataFrame:
    """The harmonised row per included stay.

    The concept tables each hold one row per stay and arrive partitioned by stay, so the chain of
    left joins adds no further shuffle of event-sized data.
    """
    base = J.in_cohort(stays, included, ["icustay_id"])
    s = J.sorted_join(J.sorted_join(base, admissions.drop("subject_id"), "hadm_id"),
                      patients.select("subject_id", "dob", "gender"), "subject_id")
    cm = S.inches_to_cm("height")
    ids = ["subject_id", "hadm_id"]
    # the three summaries share stems such as glucose and calcium, so two of them get a prefix
    vitals_part = vital_summary.drop(*ids, *[f"{f}_glucose_{e}" for f in FRAMES for e in ("min", "max", "mean")])
    lab_part = lab_summary.selectExpr("icustay_id", *[f"{c} as lab_{c}" for c in lab_summary.columns if c[2] == "_"])
    gas_part = gas_summary.selectExpr("icustay_id", *[f"{c} as gas_{c}" for c in gas_summary.columns if c[2] == "_"])
    wide = J.assemble(s, [demo.drop(*ids), vitals_part, lab_part, gas_part, aps.drop(*ids)], "icustay_id")
    frames = list(FRAMES)
    names = {
        "data_source": "dbsource", "encounter_id": F.col("icustay_id").cast("string"),
        "patient_id": F.col("subject_id").cast("string"),
        **{k: F.lit(v) for k, v in R.HOSPITAL.items()},
        "icu_id": "first_wardid", "icu_type": "first_careunit", "icu_stay_type": "first_service",
        "age": S.age_years("dob", "intime", 4), "gender": "gender", "weight": "weight", "height": cm,
        "bmi": F.when(F.col("height") > 0, S.bmi("weight", cm)),
        "ethnicity": S.recode("ethnicity", R.ETHNICITY, R.OTHER_ETHNICITY), "pregnant": "pregnant",
        "smoking_status": "smoking",
        "hospital_admit_source": S.recode("admission_location", R.ADMIT_SOURCE),
        "hospital_disch_location": S.recode("discharge_location", R.DISCHARGE_LOCATION),
        "hospital_los_days": S.days_between("admittime", "dischtime"),
        "hospital_death": "hospital_expire_flag",
        "pre_icu_los_days": F.round(S.elapsed("admittime", "intime", "days"), 4), "icu_los_days": "los",
        "icu_death": S.is_true(F.col("deathtime") <= F.col("outtime")).cast("int"),
        "elective_surgery": S.is_true(F.col("admission_type") == "ELECTIVE").cast("int"),
        "readmission_status": "readmission",
        "fio2_apache": "fio2", "paco2_apache": "paco2_oxy", "pao2_apache": "pao2",
        "ph_apache": "ph", "paco2_for_ph_apache": "paco2",
        "heart_rate_apache": "heartrate", "map_apache": "mbp",
        "gcs_eyes_apache": "gcseyes", "gcs_motor_apache": "gcsmotor",
        # a verbal reading of 0 stands for an intubated patient assumed normal
        "gcs_verbal_apache": F.when(F.col("gcsverbal") == 0, F.lit(5.0)).otherwise(F.col("gcsverbal")),
        "gcs_unable_apache": "endotrachflag", "ventilated_apache": "vent", "arf_apache": "arf",
        "apsiii": "apsiii",
    }
    for v in ("albumin", "bilirubin", "creatinine", "glucose", "hematocrit", "sodium", "resprate", "temp", "bun",
              "urineoutput", "wbc"):
        names[f"{v}_apache"] = v
    lab_names = {"hemaglobin": "hemoglobin", "platelets": "platelet"}
    gas_names = {"arterial_ph": "ph", "arterial_po2": "pao2", "arterial_pco2": "paco2", "pao2fio2ratio": "pao2fio2"}
    schema = header_schema()
    have = set(wide.columns)
    for frame in frames:
        for field in schema.names:
            if not field.startswith(f"{frame}_") or field in names:
                continue
            stem, end = field[3:].rsplit("_", 1)
            # a measure that the blood gas has too is the laboratory's; only the arterial names are the gas's
            source = f"gas_{frame}_{gas_names[stem]}_{end}" if stem in gas_names else f"lab_{frame}_{lab_names.get(stem, stem)}_{end}"
            if source in have:
                names[field] = source
            if field not in names and field in have:
                names[field] = field
    return apply_field_map(wide, names, schema)
