"""Modelling steps on the merged table, on Spark ML and plain aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.feature import RFormula
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import running_total, with_quantile_cell


def split(df: DataFrame, source_column: str, source, columns: list[str]) -> DataFrame:
    return df.where(F.col(source_column) == source).select(*columns)


# --- imputation ------------------------------------------------------------------------------
def fill_values(df: DataFrame, numeric: list[str], categorical: list[str]) -> dict:
    """Mean per numeric column and most frequent value per categorical one.

    One number per column reaches the driver. Ties between values go to the smallest.
    """
    fills = df.agg(*[F.avg(c).alias(c) for c in numeric]).first().asDict() if numeric else {}
    if categorical:
        pairs = F.explode(F.array(*[
            F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in categorical
        ]))
        counts = (
            df.select(pairs.alias("p")).select("p.c", "p.v").where("v is not null")
            .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        )
        top = counts.groupBy("c").agg(F.min_by("v", F.struct(-F.col("n"), "v")).alias("v"))
        fills.update({r["c"]: r["v"] for r in top.collect()})
    return fills


def impute(df: DataFrame, fills: dict, flag_suffix: str = "_missing") -> DataFrame:
    """Fill nulls and add a 0/1 missing flag per filled column, in one select."""
    out = []
    for field in df.schema:
        c = F.col(field.name)
        known = field.name in fills and fills[field.name] is not None
        filled = F.coalesce(c, F.lit(fills[field.name]).cast(field.dataType)) if known else c
        out.append(filled.alias(field.name))
    flags = [F.col(c).isNull().cast("int").alias(c + flag_suffix) for c in fills]
    return df.select(*out, *flags)


def redundant_flags(train: DataFrame, flags: list[str]) -> list[str]:
    """Flags that are constant or have the same count as an earlier flag."""
    row = train.agg(F.count(F.lit(1)).alias("__n"), *[F.sum(f).alias(f) for f in flags]).first()
    seen, drop = {0, row["__n"]}, []
    for flag in flags:
        if row[flag] in seen:
            drop.append(flag)
        seen.add(row[flag])
    return drop


# --- design and fit ----------------------------------------------------------------------------
def spline_bounds(train: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest training value per column: two numbers each."""
    row = train.agg(*[F.min(c).alias(f"{c}__lo") for c in columns],
                    *[F.max(c).alias(f"{c}__hi") for c in columns]).first()
    return {c: (float(row[f"{c}__lo"]), float(row[f"{c}__hi"])) for c in columns}


def spline_basis(column: str, lo: float, hi: float) -> list[Column]:
    """Cubic B-spline basis with three degrees of freedom and no inner knot."""
    t = (F.col(column) - lo) / (hi - lo)
    return [
        (3 * t * (1 - t) * (1 - t)).alias(f"{column}_s1"),
        (3 * t * t * (1 - t)).alias(f"{column}_s2"),
        (t * t * t).alias(f"{column}_s3"),
    ]


def with_splines(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Replace columns by their spline basis; bounds come from the training data."""
    extra = [b for c, (lo, hi) in bounds.items() for b in spline_basis(c, lo, hi)]
    return df.select(*[c for c in df.columns if c not in bounds], *extra)


def fit_logit(df: DataFrame, outcome: str, covariates: list[str]):
    """Unpenalised logistic regression with standard errors; rows with a null are skipped."""
    formula = RFormula(
        formula=f"{outcome} ~ " + " + ".join(covariates), featuresCol="features", labelCol="label",
        handleInvalid="skip",
    ).fit(df)
    glm = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="features",
                                      labelCol="label", predictionCol="p", maxIter=50)
    # every iteration reads the narrow design, not the plan above it
    design = formula.transform(df).select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return formula, glm.fit(design)
    finally:
        design.unpersist()


def score(fitted, df: DataFrame) -> DataFrame:
    formula, model = fitted
    return model.transform(formula.transform(df))


def feature_names(fitted, df: DataFrame) -> list[str]:
    meta = fitted[0].transform(df).schema["features"].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for g in meta.values() for a in g), key=lambda a: a["idx"])]


def coefficients(fitted, df: DataFrame) -> list[tuple]:
    """(term, coefficient, standard error, odds ratio) with the intercept last."""
    model = fitted[1]
    names = [*feature_names(fitted, df), "(intercept)"]
    betas = [*map(float, model.coefficients), float(model.intercept)]
    errors = list(model.summary.coefficientStandardErrors)
    import math

    return [(n, b, float(e), math.exp(b)) for n, b, e in zip(names, betas, errors)]


# --- evaluation ----------------------------------------------------------------------------------
def auroc(df: DataFrame, outcome: str, score_column: str, cells: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Exact area under the ROC curve; tied scores count half. ``by`` gives one row per group, in the same pass.

    Rows collapse to counts per score; the negatives below each score are a running total.
    """
    known = df.where(F.col(outcome).isNotNull() & F.col(score_column).isNotNull())
    x = F.col(score_column).cast("double").alias("__x")
    per_score = known.groupBy(*by, x).agg(
        F.sum(F.when(F.col(outcome) == 1, 1).otherwise(0)).alias("__p"),
        F.sum(F.when(F.col(outcome) == 1, 0).otherwise(1)).alias("__q"),
    )
    per_score = with_quantile_cell(per_score, known.select(x), "__x", "__cellno", cells)
    cum = running_total(per_score, list(by), [F.col("__x")], F.col("__q"), F.col("__cellno"), "__neg")
    wins = F.sum(F.col("__p") * (F.col("__neg") - F.col("__q") / 2.0))
    return cum.groupBy(*by).agg(
        F.sum("__p").alias("n_pos"), F.sum("__q").alias("n_neg"),
        F.try_divide(wins, F.sum("__p") * F.sum("__q")).alias("auroc"),
    )


def calibration(df: DataFrame, outcome: str, p: str, bins: int = 10, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean prediction and observed fraction per group and uniform bin; empty bins do not appear."""
    bin_no = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    return (
        df.where(F.col(p).isNotNull() & F.col(outcome).isNotNull())
        .groupBy(*by, bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_predicted"),
             F.avg(F.col(outcome).cast("double")).alias("fraction_positive"))
    )


def drop_columns(frames: list[DataFrame], columns: list[str]) -> list[DataFrame]:
    """The same columns leave every frame, so train and test keep one design."""
    return reduce(lambda acc, f: [*acc, f.drop(*columns)], frames, [])
