"""Exact quantiles of many columns by selection: histogram, narrow, repeat.

Numbers become longs of the same order. Four rounds fix sixteen bits each: a round counts the values of every group and
column by their next sixteen bits, among the values that agree with a wanted rank so far, and moves on to the bits in
which the rank lies. Counts are combined before the shuffle, so a task sends as many rows as it met different sixteen
bits; distinct values are neither shuffled nor sorted, and all columns, groups and ranks share each round's one scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_BITS, _ROUNDS = 16, 4
#: Fixed values of the IEEE double: bits of the fraction, smallest and largest exponent, code of infinity.
_FRACTION, _SMALLEST, _LARGEST, _INFINITE = 52, -1022, 1023, 2047


def with_sortable(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add a long that orders as the double ``column`` does: zeros alike, NaN above all; null stays null.

    It is the bit pattern of the magnitude, with the sign in front, put together from exponent and fraction. Powers
    of two divide exactly, so no two different numbers share a long.
    """
    a = F.abs(F.col(column))
    sized = df.withColumn("__a", a).withColumn("__e", F.coalesce(F.floor(F.log2(F.when(F.col("__a") < float("inf"), F.col("__a")))), F.lit(_SMALLEST)))
    sized = sized.withColumn("__e", F.greatest(F.lit(_SMALLEST), F.least(F.lit(_LARGEST), F.col("__e")))).withColumn("__p", F.pow(F.lit(2.0), F.col("__e")))
    # the logarithm may be one off next to a power of two
    up = (F.col("__a") >= 2 * F.col("__p")) & (F.col("__a") < float("inf"))
    down = (F.col("__a") < F.col("__p")) & (F.col("__e") > _SMALLEST)
    moved = sized.withColumn("__d", F.when(up, 1).when(down, -1).otherwise(0))
    scale = F.when(F.col("__d") == 1, 2 * F.col("__p")).when(F.col("__d") == -1, F.col("__p") / 2).otherwise(F.col("__p"))
    finite = (F.col("__e") + F.col("__d") - _SMALLEST) * (1 << _FRACTION) + (F.col("__a") / scale * float(1 << _FRACTION)).cast("long")
    top = F.lit(_INFINITE << _FRACTION)
    magnitude = F.when(F.isnan("__a"), top + 1).when(F.col("__a") == float("inf"), top).otherwise(finite)
    signed = F.when(F.col(column) < 0, -F.col("__m")).otherwise(F.col("__m"))
    found = moved.withColumn("__m", magnitude).select(*df.columns, F.when(F.col(column).isNotNull(), signed).alias(out))
    # a generator keeps the optimizer from copying the whole expression into the filters and join keys above
    return found.select(*df.columns, F.explode(F.array(out)).alias(out))


def _long_form(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """``__g`` (group, never null itself), ``__i`` (column number), ``__x`` and ``__k`` (its sortable long)."""
    group = F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"g{i}") for i, c in enumerate(by)])
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("x")) for i, c in enumerate(columns)]))
    rows = df.select(group.alias("__g"), values.alias("__v")).select("__g", F.col("__v.i").alias("__i"), F.col("__v.x").alias("__x"))
    return with_sortable(rows.where(F.col("__x").isNotNull()), "__x", "__k")


def _ranks(probs: list[float], total: Column) -> list[Column]:
    """From 0: the ranks just below and above every wanted position."""
    positions = [F.lit(p) * (total - 1) for p in probs]
    return [f(x).cast("long") for x in positions for f in (F.floor, F.ceil)]


def quantiles(df: DataFrame, by: list[str], columns: list[str], probs: dict[str, float], few_groups: bool = True) -> DataFrame:
    """``by``, ``variable`` and one linearly interpolated quantile per entry of ``probs``; exact at any size.

    Between rounds at most ``2 * len(probs)`` rows per group and column are handed on. They are broadcast, as groups
    are sources or classes; ``few_groups=False`` shuffles the values of each round to them instead.
    """
    rows = _long_form(df, by, columns)
    wanted = [f"__r{i}" for i in range(2 * len(probs))]
    state, shift = None, 64
    for turn in range(_ROUNDS):
        shift -= _BITS
        bits, path = F.shiftright("__k", shift).alias("__bits"), ["__g", "__i"]
        if state is None:
            counts = rows.groupBy("__g", "__i", bits).agg(F.count(F.lit(1)).alias("__n"))
            whole = Window.partitionBy(*path)
            counts = counts.withColumn("__all", F.sum("__n").over(whole))
            counts = counts.select("*", *[r.alias(w) for r, w in zip(_ranks(list(probs.values()), F.col("__all")), wanted)], F.col("__all").alias("__total"))
        else:
            path = [*path, "__path"]
            met = rows.withColumn("__path", F.shiftright("__k", shift + _BITS)).join(F.broadcast(state) if few_groups else state, path)
            last = [F.min("__x").alias("__x")] if turn == _ROUNDS - 1 else []
            counts = met.groupBy(*path, bits).agg(F.count(F.lit(1)).alias("__n"), F.max("__total").alias("__total"),
                                                  *[F.max(w).alias(w) for w in wanted], *last)
        before = F.coalesce(F.sum("__n").over(Window.partitionBy(*path).orderBy("__bits").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = counts.withColumn("__before", before)
        inside = [F.when((F.col(w) >= F.col("__before")) & (F.col(w) < F.col("__before") + F.col("__n")), F.col(w) - F.col("__before")).alias(w) for w in wanted]
        extra = ["__x"] if turn == _ROUNDS - 1 else []
        state = placed.select("__g", "__i", F.col("__bits").alias("__path"), "__total", *inside, *extra).where(
            reduce(lambda p, q: p | q, [F.col(w).isNotNull() for w in wanted]))
    picked = state.groupBy("__g", "__i").agg(F.max("__total").alias("__total"), *[F.max(F.when(F.col(w).isNotNull(), F.col("__x"))).alias(w) for w in wanted])
    outs = []
    for i, (name, p) in enumerate(probs.items()):
        position, lo, hi = F.lit(p) * (F.col("__total") - 1), F.col(wanted[2 * i]), F.col(wanted[2 * i + 1])
        outs.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    names = F.array(*[F.lit(c) for c in columns])
    return picked.select(*[F.col(f"__g.g{i}").alias(c) for i, c in enumerate(by)], F.element_at(names, F.col("__i") + 1).alias("variable"), *outs)
