"""Profiling: counts, cross-tabs, completeness, summary tables, histograms, correlation."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .selection import quantiles


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per known value, most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
    )


def crosstab(df: DataFrame, a: str, b: str, values: list) -> DataFrame:
    """Counts of ``a`` by the listed values of ``b``, rows with a null left out."""
    counts = [F.count(F.when(F.col(b) == v, 1)).alias(str(v)) for v in values]
    return df.where(F.col(a).isNotNull() & F.col(b).isin(*values)).groupBy(a).agg(*counts)


def crosstab_share(df: DataFrame, a: str, by: list[str], scale: float = 1.0) -> DataFrame:
    """Long cross-tab with margins: count, and share of the column total.

    The row margin is ``All``; the column margin has ``All`` in every ``by`` column.
    """
    known = df.where(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in [a, *by]]))
    text = known.select(*[F.col(c).cast("string").alias(c) for c in [a, *by]])
    # one pass: the four grouping sets come from the pre-aggregated cells, not from the rows
    cells = text.groupBy(a, *by).agg(F.count(F.lit(1)).alias("n"))
    sides = F.explode(F.array(F.lit(0), F.lit(1)))
    spread = cells.withColumn("__ra", sides).withColumn("__cb", sides)
    named = spread.select(
        F.when(F.col("__ra") == 1, "All").otherwise(F.col(a)).alias(a),
        *[F.when(F.col("__cb") == 1, "All").otherwise(F.col(c)).alias(c) for c in by],
        "n",
    )
    table = named.groupBy(a, *by).agg(F.sum("n").alias("n"))
    totals = table.where(F.col(a) == "All").select(*by, F.col("n").alias("__total"))
    return table.join(totals, by).select(a, *by, "n", (F.col("n") * scale / F.col("__total")).alias("share"))


def _unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(keys, columns, name, value) if keys else df.unpivot([], columns, name, value)


def completion(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Percent of known values per variable and source; a column that is empty there is null."""
    share = [F.expr(f"nullif(count(`{c}`) * 100.0D / count(1), 0.0D) as `{c}`") for c in columns]
    return _unpivot(df.groupBy(by).agg(*share), [by], columns, "variable", "percent")


def completion_requiring(df: DataFrame, columns: list[str], by: str, source) -> DataFrame:
    """Completion limited to the variables the given source has data for."""
    table = completion(df, columns, by)
    there = F.max(F.when(F.col(by) == source, F.col("percent"))).over(Window.partitionBy("variable"))
    return table.withColumn("__there", there).where("__there is not null").drop("__there")


def availability(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """1 where a variable has no data at all in a source, else 0."""
    empty = [F.expr(f"cast(count(`{c}`) = 0 as int) as `{c}`") for c in columns]
    return _unpivot(df.groupBy(by).agg(*empty), [by], columns, "variable", "all_missing")


def common_variables(avail: DataFrame, by: str, sources: list) -> DataFrame:
    """Variables with data in every listed source."""
    return (
        avail.where(F.col(by).isin(*sources))
        .groupBy("variable").agg(F.sum("all_missing").alias("m"), F.count(F.lit(1)).alias("k"))
        .where((F.col("m") == 0) & (F.col("k") == len(sources))).select("variable")
    )


def missingness(df: DataFrame, columns: list[str], denominator: str) -> DataFrame:
    """Percent of missing rows per column, relative to the known rows of one column."""
    share = [F.expr(f"count_if(`{c}` is null) * 100.0D / count(`{denominator}`) as `{c}`") for c in columns]
    return _unpivot(df.agg(*share), [], columns, "variable", "percent_missing")


def table_one(df: DataFrame, by: str, categorical: list[str], continuous: list[str]) -> DataFrame:
    """Summary table by group: n and percent per level, mean and SD per number.

    Categorical levels are counted on pre-aggregated rows and percentages refer to the known
    values of the variable in the group.
    """
    parts = []
    if categorical:
        # one scan: the columns of each row unfold inside the map side and combine before the shuffle
        pairs = F.explode(F.array(*[
            F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level")) for c in categorical
        ]))
        levels = (
            df.select(by, pairs.alias("p")).select(by, "p.variable", "p.level")
            .where(F.col("level").isNotNull())
            .groupBy(by, "variable", "level").agg(F.count(F.lit(1)).alias("n"))
        )
        totals = levels.groupBy(F.col(by).alias("__by"), F.col("variable").alias("__variable")).agg(F.sum("n").alias("__total"))
        same = F.col(by).eqNullSafe(F.col("__by")) & (F.col("variable") == F.col("__variable"))
        parts.append(levels.join(totals, same).select(
            by, "variable", "level", "n", (F.col("n") * 100.0 / F.col("__total")).alias("percent"),
            F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("sd"),
        ))
    if continuous:
        wide = df.groupBy(by).agg(*[
            F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev(c).alias("sd")).alias(c)
            for c in continuous
        ])
        parts.append(_unpivot(wide, [by], continuous, "variable", "s").select(
            by, "variable", F.lit(None).cast("string").alias("level"), F.col("s.n").alias("n"),
            F.lit(None).cast("double").alias("percent"), F.col("s.mean").alias("mean"), F.col("s.sd").alias("sd"),
        ))
    return reduce(lambda a, b: a.unionByName(b), parts)


def describe_all(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Known values, mean, SD, median, 5th and 95th percentile of every column by group, exact; one row per group and variable."""
    moments = df.groupBy(by).agg(*[
        F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev(c).alias("sd")).alias(c) for c in columns])
    long = _unpivot(moments, [by], columns, "variable", "s").select(by, "variable", "s.n", "s.mean", "s.sd")
    ranked = quantiles(df, [by], columns, {"p5": 0.05, "median": 0.5, "p95": 0.95}).withColumnRenamed(by, "__by").withColumnRenamed("variable", "__v")
    # null-safe: rows without a group are a group of their own
    same = F.col(by).eqNullSafe(F.col("__by")) & (F.col("variable") == F.col("__v"))
    return long.join(ranked, same, "left").drop("__by", "__v")


def describe_by(df: DataFrame, by: str, column: str) -> DataFrame:
    """Mean, SD, median, 5th and 95th percentile of one column by group, exact."""
    return describe_all(df, by, [column]).drop("variable")


def histogram(df: DataFrame, column: str, lo: float, hi: float, bins: int,
              by: list[str] | None = None) -> DataFrame:
    """Equal-width counts on [lo, hi] with the last bin closed, and their density.

    Values outside the range are left out; the density of a group integrates to one.
    """
    width = (hi - lo) / bins
    x = F.col(column)
    bin_no = F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("int")
    counts = (
        df.where(x.between(lo, hi)).groupBy(*(by or []), bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # at most ``bins`` rows per group reach the window
    total = F.sum("n").over(Window.partitionBy(*(by or [])))
    return counts.select(
        *(by or []), "bin", (F.lit(lo) + F.col("bin") * width).alias("left_edge"), "n",
        (F.col("n") / (total * width)).alias("density"),
    )


#: Columns up to which every pair is an aggregate of its own, and columns in a block beyond that.
DIRECT_COLUMNS, BLOCK = 12, 32


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows where both are known.

    Few columns are one aggregation. More are cut into blocks: a task multiplies the blocks of its rows as matrices
    and sends one row of sums for each pair of blocks, whatever the number of rows. A pair without a common row does
    not appear; one that is constant on its common rows has a null.
    """
    if len(columns) > DIRECT_COLUMNS:
        return _block_correlation(df, columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    both = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")).alias("r"),
                     F.count(F.when(F.col(f"`{a}`").isNotNull() & F.col(f"`{b}`").isNotNull(), 1)).alias("n")) for a, b in pairs]
    return df.agg(F.array(*both).alias("p")).select(F.inline("p")).where("n > 0").drop("n")


def _block_correlation(df: DataFrame, columns: list[str], width: int = BLOCK) -> DataFrame:
    # centred on the mean of the finite values, so that the sums lose no digits
    value = [F.col(f"`{c}`").cast("double") for c in columns]
    finite = [F.when(F.abs(v) < float("inf"), v) for v in value]
    means = df.agg(F.array(*[F.coalesce(F.avg(v), F.lit(0.0)) for v in finite])).scalar()
    centred = df.withColumn("__m", means).select(*[(v - F.get("__m", F.lit(i))).alias(f"c{i}") for i, v in enumerate(value)])
    wide = len(columns)
    starts = range(0, wide, width)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = {}
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(wide)], axis=1)
            known = np.stack([batch.column(i).is_valid().to_numpy(zero_copy_only=False) for i in range(wide)], axis=1).astype(float)
            odd = known * ~np.isfinite(x)
            x = np.where((known > 0) & (odd == 0), x, 0.0)
            for i in starts:
                for j in range(i, wide, width):
                    p, q = slice(i, i + width), slice(j, j + width)
                    sums = (known[:, p].T @ known[:, q], x[:, p].T @ known[:, q], known[:, p].T @ x[:, q], (x[:, p] ** 2).T @ known[:, q],
                            known[:, p].T @ (x[:, q] ** 2), x[:, p].T @ x[:, q], odd[:, p].T @ known[:, q] + known[:, p].T @ odd[:, q])
                    cell = np.zeros((len(sums), width, width))
                    cell[:, :sums[0].shape[0], :sums[0].shape[1]] = sums
                    total[i, j] = total[i, j] + cell if (i, j) in total else cell
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in total], pa.int32()), pa.array([j for _, j in total], pa.int32()),
                                              pa.array([c.reshape(-1) for c in total.values()], pa.list_(pa.float64()))], ["i", "j", "sums"])

    parts = centred.mapInArrow(run, "i int, j int, sums array<double>")
    blocks = parts.groupBy("i", "j").agg(Summarizer.sum(array_to_vector("sums")).alias("s")).select("i", "j", vector_to_array("s").alias("s"))
    cells = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(width * width - 1))).alias("at"))
    names = F.array(*[F.lit(c) for c in columns])
    first, second = F.col("i") + F.floor(F.col("at") / width), F.col("j") + F.col("at") % width
    sums = [F.get("s", F.col("at") + k * width * width).alias(n) for k, n in enumerate(("n", "sx", "sy", "sxx", "syy", "sxy", "odd"))]
    pairs = cells.select(first.alias("a"), second.alias("b"), *sums).where(f"a < b and b < {wide} and n > 0")
    # a spread that is lost in rounding counts as none
    spread = [F.when(F.col("n") * F.col(s2) - F.col(s) * F.col(s) > 1e-12 * F.col("n") * F.col(s2), F.col("n") * F.col(s2) - F.col(s) * F.col(s))
              for s, s2 in (("sx", "sxx"), ("sy", "syy"))]
    r = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(spread[0]) / F.sqrt(spread[1])
    return pairs.select(F.get(names, F.col("a").cast("int")).alias("a"), F.get(names, F.col("b").cast("int")).alias("b"),
                        F.when(F.col("odd") > 0, F.lit(float("nan"))).otherwise(r).alias("r"))


def perfect_pairs(corr: DataFrame, tolerance: float = 1e-12) -> DataFrame:
    return corr.where(F.col("r") >= 1 - tolerance).select("a", "b")


def order_by_category(df: DataFrame, rank: Column, name: str) -> DataFrame:
    return df.orderBy(F.asc_nulls_last(rank) if isinstance(rank, str) else rank.asc_nulls_last(), name)
