"""Ordered operators that survive hot keys.

A SQL window sorts a whole partition in one task, which fails when one key holds a large share
of all rows. Here every group is cut into *cells* by a coarse, order-preserving function of the
order key (an hour of time, a quantile range of a number). Each cell is summarised with partial
aggregation, what later cells need from it is handed on as one row per cell, and the detail rows
only meet the other rows of their own cell. Results are exact: cells change where the work
happens, not what it computes. Cells may be as many as the rows, so they are joined by sorting,
in the order that the numbering of a cell needs anyway.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import _col, micros, seconds
from .balanced import bound_index

_CELL, _BASE, _TOTAL = "__cell", "__base", "__total"
_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, Window.currentRow)


# --- cells ----------------------------------------------------------------------------------
def time_cell(ts, width: int) -> Column:
    """Number of the ``width``-second cell of a timestamp; missing times sort last."""
    cell = F.floor(seconds(ts) / F.lit(width))
    return F.coalesce(cell, F.lit(9_223_372_036_854_775_807))


def number_cell(c, width: float) -> Column:
    """Cell number of a number; missing numbers sort last."""
    return F.coalesce(F.floor(_col(c) / F.lit(width)), F.lit(9_223_372_036_854_775_807))


def with_quantile_cell(df: DataFrame, sample: DataFrame, column: str, out: str, cells: int | None = None) -> DataFrame:
    """Add the cell number of a numeric column, with approximate quantiles of ``sample`` as bounds.

    The bounds (one number per shuffle partition unless ``cells`` is given) are a scalar subquery: they are
    computed when the plan runs, and building the plan starts no job.
    """
    cells = cells or max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    probs = F.array(*[F.lit(i / cells) for i in range(1, cells)])
    bounds = sample.agg(F.array_distinct(F.percentile_approx(column, probs, F.lit(4 * cells)))).scalar()
    below = bound_index("__bounds", F.col(column), 1 << cells.bit_length())
    return df.withColumn("__bounds", bounds).select(*df.columns, F.coalesce(below, F.lit(0)).cast("double").alias(out))


def _with_cell(df: DataFrame, keys: list[str], cell: Column) -> DataFrame:
    # one struct: never null itself, so null keys and null cells group and join like values
    fields = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)] + [cell.alias("c")]
    return df.withColumn(_CELL, F.struct(*fields))


def _over_cells(keys: list[str]):
    by = [F.col(f"{_CELL}.k{i}") for i in range(len(keys))]
    return Window.partitionBy(*by).orderBy(F.col(f"{_CELL}.c"))


# --- running totals and numbering -----------------------------------------------------------
def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    weight: Column,
    cell: Column,
    out: str = "running",
    group_total: str | None = None,
) -> DataFrame:
    """Cumulative sum of ``weight`` in ``order`` within each key, the current row included.

    ``cell`` must not decrease along the first order column. ``group_total`` names a column that
    receives the sum over the whole key.
    """
    celled = _with_cell(df, keys, cell)
    sums = celled.groupBy(_CELL).agg(F.sum(weight).alias("__w"))
    over = _over_cells(keys)
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = sums.select(
        _CELL,
        F.coalesce(F.sum("__w").over(over.rowsBetween(*_BEFORE)), F.lit(0)).alias(_BASE),
        F.sum("__w").over(whole).alias(_TOTAL),
    )
    local = F.sum(weight).over(Window.partitionBy(_CELL).orderBy(*order).rowsBetween(*_UP_TO))
    extra = [F.col(_TOTAL).alias(group_total)] if group_total else []
    return celled.join(bases.hint("merge"), _CELL).select(*df.columns, (F.col(_BASE) + local).alias(out), *extra)


def sequence(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    cell: Column,
    out: str = "seq",
    ties: bool = False,
) -> DataFrame:
    """Row number of each row within its key, or rank when ``ties`` is set."""
    number = F.rank() if ties else F.row_number()
    celled = _with_cell(df, keys, cell)
    sums = celled.groupBy(_CELL).agg(F.count(F.lit(1)).alias("__w"))
    before = F.sum("__w").over(_over_cells(keys).rowsBetween(*_BEFORE))
    bases = sums.select(_CELL, F.coalesce(before, F.lit(0)).alias(_BASE))
    local = number.over(Window.partitionBy(_CELL).orderBy(*order))
    return celled.join(bases.hint("merge"), _CELL).select(*df.columns, (F.col(_BASE) + local).alias(out))


# --- carrying values forward -----------------------------------------------------------------
@dataclass(frozen=True)
class Carried:
    """Rows whose latest value is wanted: ``take`` maps their columns to output names.

    ``where`` narrows the rows. Sides given the same ``rows`` and ``ts`` are read together, once.
    """

    rows: DataFrame
    ts: str
    reach_seconds: int
    take: dict[str, str]
    where: Column | None = None


def _carry(rows: DataFrame, on: list[str], width: int, reach: int, order: list[str], value: str) -> DataFrame:
    """The last ``value`` of each time cell, copied into the following cells its reach touches.

    ``rows`` has the key columns, ``__cell``, the order columns and ``value``. At most one row per
    cell is copied, so the copies stay few however dense a cell is.
    """
    ranked = F.struct(*order)
    last = rows.groupBy(*on, "__cell").agg(F.max(ranked).alias("__o"), F.max_by(value, ranked).alias(value))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(math.ceil(reach / width))))
    return last.withColumn("__step", ahead).select(
        *on, (F.col("__cell") + F.col("__step")).alias("__cell"), *[F.col("__o")[c].alias(c) for c in order], value)


def asof_backward(
    left: DataFrame, on: list[str], left_ts: str, sides: list[Carried], width: int | None = None
) -> DataFrame:
    """Every left row with the latest row of each side at or before it, within that side's reach.

    Left rows, side rows and the carried last rows of earlier cells are stacked, partitioned by key
    and time cell, and read once in time order. Neither input is joined and no pair is formed that
    the result does not contain; the left side is computed and shuffled once. A smaller ``width``
    splits a dense key further. Side rows of equal time need distinct values to be told apart.
    """
    width = width or max(s.reach_seconds for s in sides)
    stacked = left.select(
        *on, time_cell(left_ts, width).alias("__cell"), F.col(left_ts).alias("__ts"), F.lit(len(sides)).alias("__side"),
        F.struct(*left.columns).alias("__l"))
    shared: dict[tuple, list[int]] = {}
    for i, side in enumerate(sides):
        shared.setdefault((id(side.rows), side.ts), []).append(i)
    for members in shared.values():
        first, values = sides[members[0]], []
        for i in members:
            value = F.struct(F.col(first.ts).alias("t"), *[F.col(c).alias(o) for c, o in sides[i].take.items()])
            values.append((value if sides[i].where is None else F.when(sides[i].where, value)).alias(f"__r{i}"))
        rows = first.rows.where(F.col(first.ts).isNotNull()).select(
            *on, time_cell(first.ts, width).alias("__cell"), F.col(first.ts).alias("__ts"), F.lit(members[0]).alias("__side"), *values)
        # of each cell the last value of every side, copied into the following cells that its reach touches
        names = [f"__r{i}" for i in members]
        last = rows.groupBy(*on, "__cell", "__side").agg(
            F.max("__ts").alias("__ts"), *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col("__ts"))).alias(n) for n in names])
        ahead = F.explode(F.sequence(F.lit(1), F.lit(math.ceil(max(sides[i].reach_seconds for i in members) / width))))
        copies = last.withColumn("__step", ahead).select(*on, (F.col("__cell") + F.col("__step")).alias("__cell"), "__ts", "__side", *names)
        stacked = stacked.unionByName(rows, allowMissingColumns=True).unionByName(copies, allowMissingColumns=True)
    window = Window.partitionBy(*on, "__cell").orderBy("__ts", "__side").rowsBetween(*_UP_TO)
    hits = [F.last(f"__r{i}", ignorenulls=True).over(window).alias(f"__h{i}") for i in range(len(sides))]
    found = stacked.select("__side", "__ts", "__l", *hits).where(F.col("__side") == len(sides))
    outs = []
    for i, side in enumerate(sides):
        fresh = micros("__ts") - micros(f"__h{i}.t") <= side.reach_seconds * 1_000_000
        outs += [F.when(fresh, F.col(f"__h{i}.{o}")).alias(o) for o in side.take.values()]
    return found.select("__l.*", *outs)


def previous_within(
    df: DataFrame,
    keys: list[str],
    ts: str,
    values: list[str],
    reach_seconds: int,
    tiebreak: list[str] | None = None,
    width: int | None = None,
    closed: bool = False,
    prefix: str = "prev_",
) -> DataFrame:
    """Values of the row just before, where it lies less than ``reach_seconds`` back, else null."""
    width = width or reach_seconds
    order = [ts, *(tiebreak or [])]
    row = F.struct(F.col(ts).alias("t"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    rows = df.select("*", time_cell(ts, width).alias("__cell"), row.alias("__v"), F.lit(True).alias("__own"))
    copies = _carry(rows.where(F.col(ts).isNotNull()), keys, width, reach_seconds, order, "__v")
    stacked = rows.unionByName(copies, allowMissingColumns=True)
    window = Window.partitionBy(*keys, "__cell").orderBy(*order).rowsBetween(*_BEFORE)
    found = stacked.select("*", F.last("__v", ignorenulls=True).over(window).alias("__prev")).where("__own")
    age = micros(ts) - micros("__prev.t")
    fresh = age <= reach_seconds * 1_000_000 if closed else age < reach_seconds * 1_000_000
    taken = [F.when(fresh, F.col(f"__prev.v{i}")).alias(prefix + v) for i, v in enumerate(values)]
    return found.select(*df.columns, *taken)


def totals_before(
    left: DataFrame,
    on: list[str],
    at: str,
    rows: DataFrame,
    ts: str,
    sums: dict[str, Column] | None = None,
    maxima: dict[str, Column] | None = None,
    closed: bool = False,
    width: int = 7 * 86400,
) -> DataFrame:
    """Every left row with sums and maxima over all ``rows`` of its key before ``at`` (or at it, if ``closed``).

    A prefix scan: rows are totalled per key and time cell, a window over the cells carries the totals on, and a left
    row adds what its own cell holds before it. There is no limit to how far back a row may lie, and no left row
    meets a row. The maximum of a struct that begins with the time is the latest row. Null where there is none.
    """
    sums, maxima = sums or {}, maxima or {}
    values = [c.alias(f"__v{i}") for i, c in enumerate([*sums.values(), *maxima.values()])]
    folds = [F.sum] * len(sums) + [F.max] * len(maxima)
    names = [f"__v{i}" for i in range(len(values))]
    known = rows.where(F.col(ts).isNotNull() & F.expr(" and ".join(f"`{k}` is not null" for k in on))).select(
        *on, time_cell(ts, width).alias("__cell"), F.col(ts).alias("__ts"), F.lit(1 if closed else 3).alias("__kind"), *values)
    asking = left.select(*on, time_cell(at, width).alias("__cell"), F.col(at).alias("__ts"), F.lit(2).alias("__kind"), F.struct("*").alias("__l"))
    totals = known.groupBy(*on, "__cell").agg(*[f(n).alias(n) for f, n in zip(folds, names)])
    cells = totals.unionByName(asking.select(*on, "__cell", F.lit(True).alias("__asked")).distinct(), allowMissingColumns=True)
    earlier = Window.partitionBy(*on).orderBy("__cell").rangeBetween(Window.unboundedPreceding, -1)
    carried = cells.select(*on, "__cell", "__asked", *[f(n).over(earlier).alias(n) for f, n in zip(folds, names)]).where("__asked").drop("__asked")
    stacked = asking.unionByName(known, allowMissingColumns=True).unionByName(
        carried.withColumn("__kind", F.lit(0)), allowMissingColumns=True)
    upto = Window.partitionBy(*on, "__cell").orderBy((F.col("__kind") > 0), "__ts", "__kind").rowsBetween(*_UP_TO)
    found = stacked.select("__kind", "__ts", "__l", *[f(n).over(upto).alias(n) for f, n in zip(folds, names)]).where("__kind = 2")
    outs = [F.when(F.col("__ts").isNotNull(), F.col(n)).alias(out) for n, out in zip(names, [*sums, *maxima])]
    return found.select("__l.*", *outs)


# --- one row per key -------------------------------------------------------------------------
def nulls_last(c) -> Column:
    c = _col(c)
    return F.struct(c.isNull(), c)


def nulls_first(c) -> Column:
    c = _col(c)
    return F.struct(c.isNotNull(), c)


def descending(c) -> Column:
    """Order key for a number of any type, largest first and nulls first; the type is kept, so big ids stay apart."""
    c = _col(c)
    return F.struct(c.isNotNull(), -c)


def descending_time(ts) -> Column:
    return F.struct(_col(ts).isNotNull(), -micros(ts))


def first_row(df: DataFrame, keys: list[str], order: list[Column], take: list[str]) -> DataFrame:
    """The first row of each key in ascending ``order``, combined on the map side before the shuffle.

    Use ``nulls_last``, ``descending`` and friends to build order keys. Equal order keys need a
    tiebreak in ``order`` for a stable answer.
    """
    best = F.min_by(F.struct(*take), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    return df.groupBy(*keys).agg(best.alias("__b")).select(*keys, *[F.col("__b")[c].alias(c) for c in take])


# --- quantiles -------------------------------------------------------------------------------
def exact_quantiles(
    df: DataFrame, by: list[str], column: str, probs: dict[str, float], cells: int | None = None
) -> DataFrame:
    """Linear-interpolation quantiles per group, exact at any size.

    Equal values collapse to counts first, the counts are accumulated cell by cell, and each
    wanted rank is picked from the cumulative count.
    """
    known = df.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("__x"))
    counts = known.groupBy(*by, "__x").agg(F.count(F.lit(1)).alias("__n"))
    counts = with_quantile_cell(counts, known, "__x", "__q", cells)
    cum = running_total(counts, by, [F.col("__x")], F.col("__n"), F.col("__q"), "__cum", "__all")
    aggs, outs = [], []
    for name, p in probs.items():
        pos = F.lit(p) * (F.col("__all") - 1)
        aggs.append(F.min(F.when(F.col("__cum") > F.floor(pos), F.col("__x"))).alias(f"lo_{name}"))
        aggs.append(F.min(F.when(F.col("__cum") > F.ceil(pos), F.col("__x"))).alias(f"hi_{name}"))
        aggs.append(F.max(pos - F.floor(pos)).alias(f"fr_{name}"))
        lo, hi, fr = F.col(f"lo_{name}"), F.col(f"hi_{name}"), F.col(f"fr_{name}")
        outs.append((lo + (hi - lo) * fr).alias(name))
    return cum.groupBy(*by).agg(*aggs).select(*by, *outs)
