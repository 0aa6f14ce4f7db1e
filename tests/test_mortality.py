"""The mortality plan with splines on two sources."""

import random

import pytest

from wardline.plans import mortality


@pytest.fixture(scope="module")
def merged(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1500):
        source = "a" if i % 3 else "b"
        ph, sick = rng.gauss(7.3, 0.1), rng.random() < 0.3
        risk = 0.05 + 0.4 * sick + (0.4 if ph < 7.2 else 0)
        died = None if i % 50 == 0 else int(rng.random() < risk)
        rows.append((source, died, ph if i % 7 else None, 3000.0 if i % 100 == 1 else 120.0 + rng.gauss(0, 20), int(sick) if i % 5 else None,
                     "M" if i % 2 else "F", 1.0 if source == "a" else None))
    return spark.createDataFrame(rows, "data_source string, hospital_death int, ph_apache double, glucose_apache double, "
                                       "ventilated_apache int, gender string, wbc_apache double")


def test_covariates_are_those_all_sources_have(merged):
    assert set(mortality.shared_covariates(merged, ["a", "b"])) == {"ph_apache", "glucose_apache", "ventilated_apache", "gender"}


def test_fit_on_one_source_judges_the_others(merged):
    df = mortality.prepared(merged)
    assert df.where("hospital_death is null or glucose_apache > 2000").count() == 0
    model = mortality.fit(df.where("data_source = 'a'"), mortality.shared_covariates(df, ["a", "b"]))
    assert set(model.bounds) == {"ph_apache", "glucose_apache"} and "gender_missing" in model.dropped
    areas, curves = mortality.judged(df, model, ["a", "b"])
    got = {r.data_source: r.auroc for r in areas.collect()}
    assert got["a"] > 0.75 and got["b"] > 0.7
    sizes = {r.data_source: r.s for r in curves.groupBy("data_source").agg({"n": "sum"}).withColumnRenamed("sum(n)", "s").collect()}
    assert sizes == {s: df.where(f"data_source = '{s}'").count() for s in ("a", "b")}
