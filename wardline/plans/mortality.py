"""Hospital mortality across sources: fit on one source, judge on the others.

Fills, redundant flags and spline bounds come from the training source alone. A handful of numbers per column
reaches the driver; rows are never sampled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import model as M
from ..operators import profile as PR
from ..registry import numeric_columns, variables
from .merge import GLUCOSE_LIMIT

# --- fixed values -------------------------------------------------------------------------
OUTCOME = "hospital_death"
SPLINED = ("map_apache", "glucose_apache", "heart_rate_apache", "ph_apache", "resprate_apache", "temp_apache", "wbc_apache",
           "h1_arterial_po2_min", "h1_arterial_po2_max")
# measures that repeat another one
LEFT_OUT = ("paco2_for_ph_apache",)
# ------------------------------------------------------------------------------------------


def prepared(df: DataFrame) -> DataFrame:
    """Rows with a known outcome; an impossible glucose counts as unknown."""
    known = df.where(F.col(OUTCOME).isNotNull())
    if "glucose_apache" not in df.columns:
        return known
    return known.withColumn("glucose_apache", F.when(F.col("glucose_apache") <= GLUCOSE_LIMIT, F.col("glucose_apache")))


def shared_covariates(df: DataFrame, sources: list[str], windows: tuple[str, ...] = ()) -> list[str]:
    """Variables, identifiers aside, that all the sources have data for; ``windows`` keeps names with these starts."""
    names = [n for n, category, *_ in variables() if category != "identifier" and n in df.columns and n != OUTCOME]
    common = {r.variable for r in PR.common_variables(PR.availability(df, names, "data_source"), "data_source", sources).collect()}
    return [n for n in names if n in common and n not in LEFT_OUT and (not windows or n.startswith(windows))]


@dataclass(frozen=True)
class MortalityModel:
    covariates: list[str]
    fills: dict
    dropped: list[str]
    bounds: dict[str, tuple[float, float]]
    fitted: tuple

    def design(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        filled = M.impute(df.select(*keep, OUTCOME, *self.covariates), self.fills).drop(*self.dropped)
        return M.with_splines(filled, self.bounds)

    def scores(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """``hospital_death`` and the predicted risk ``p``, with the columns in ``keep`` before them."""
        return M.score(self.fitted, self.design(df, keep)).select(*keep, OUTCOME, "p")


def fit(train: DataFrame, covariates: list[str], splines: bool = True) -> MortalityModel:
    number = set(numeric_columns())
    fills = M.fill_values(train, [c for c in covariates if c in number], [c for c in covariates if c not in number])
    filled = M.impute(train.select(OUTCOME, *covariates), fills)
    dropped = M.redundant_flags(filled, [f"{c}_missing" for c in covariates])
    bounds = M.spline_bounds(filled, curved) if (curved := [c for c in covariates if c in SPLINED and splines]) else {}
    design = M.with_splines(filled.drop(*dropped), bounds)
    fitted = M.fit_logit(design, OUTCOME, [c for c in design.columns if c != OUTCOME])
    return MortalityModel(covariates, fills, dropped, bounds, fitted)


def judged(df: DataFrame, model: MortalityModel, sources: list[str]) -> tuple[DataFrame, DataFrame]:
    """AUROC and calibration of every source that has rows, each in one pass over all of them."""
    scored = model.scores(df.where(F.col("data_source").isin(*sources)), ("data_source",))
    return M.auroc(scored, OUTCOME, "p", by=("data_source",)), M.calibration(scored, OUTCOME, "p", by=("data_source",))
