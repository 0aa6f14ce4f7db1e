"""Order-preserving cells found from the data, and running totals over them.

The cells of ``ordered`` come from a fixed width, so rows that share a time, or have none, stay together. Here
a cell that turns out to hold more than ``most`` rows is cut again at bounds taken from its own rows: a hash
picks a few of its distinct order keys, sorted they are the bounds, and a row finds its part by binary search. The
whole order key is compared, tiebreaks and a hash of the row included, so even rows whose times are all null or
equal are spread, in order. Cells that are not hot are left alone, and where none is, nothing is sampled.

``order`` lists plain columns or order keys (``ordered.nulls_last``, ``ordered.descending``), compared ascending
with nulls first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows a cell may hold before it is cut, parts a hot cell is cut into at most, and picks per part.
MOST, PARTS, PICKS = 1_000_000, 4096, 8
_CELL, _PART, _KEY, _BOUNDS = "__cell", "__part", "__order", "__bounds"


def bound_index(bounds: str, value: Column, most: int = PARTS) -> Column:
    """How many of the sorted ``bounds`` (fewer than ``most``, a power of two) lie below ``value``; null without bounds."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range((most - 1).bit_length()))])
    return F.when(F.col(bounds).isNotNull(), F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < value, at + step).otherwise(at)))


def with_cells(df: DataFrame, keys: list[str], order: list[Column], cell: Column | None = None, most: int = MOST,
               parts: int = PARTS) -> DataFrame:
    """``df`` with ``__cell`` (key and coarse cell), ``__part`` (of a hot cell, else 0) and ``__order`` (the order key).

    Parts and cells rise with the order key. What is broadcast is one row per hot cell, so at most rows / ``most``
    of them, and at most ``2 * PICKS`` keys per ``most`` rows.
    """
    # without keys the one cell is no constant to the optimizer, so that joins on it stay joins on a key
    one = F.lit(0) if keys else F.pmod(F.hash(*order), F.lit(1))
    fields = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)] + [(one if cell is None else cell).alias("c")]
    key = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.xxhash64(*df.columns).alias("h"))
    celled = df.select("*", F.struct(*fields).alias(_CELL), key.alias(_KEY))
    hot = celled.groupBy(_CELL).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > most)
    wanted = F.least(F.lit(PICKS * (parts - 1)), F.ceil(F.col("__n") * (2 * PICKS / most)))
    picked = celled.select(_CELL, _KEY).join(F.broadcast(hot), _CELL).where(
        F.pmod(F.xxhash64(_KEY, F.lit(1)), F.greatest(F.lit(1), F.floor(F.col("__n") / wanted))) == 0)
    found = picked.groupBy(_CELL).agg(F.array_sort(F.collect_set(_KEY)).alias("__all"))
    # every few picks one bound, evenly, fewer than ``parts`` in all
    gap = F.greatest(F.lit(PICKS), F.ceil(F.size("__all") / F.lit(parts - 1)))
    bounds = found.select(_CELL, F.filter("__all", lambda _, i: (i + 1) % gap == 0).alias(_BOUNDS))
    cut = celled.join(F.broadcast(bounds), _CELL, "left")
    return cut.select(*df.columns, _CELL, F.coalesce(bound_index(_BOUNDS, F.col(_KEY), parts), F.lit(0)).alias(_PART), _KEY)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    weights: dict[str, Column],
    cell: Column | None = None,
    most: int = MOST,
    parts: int = PARTS,
) -> DataFrame:
    """``df`` with, for each name in ``weights``, the sum of its column up to the row, the row included.

    Rows with equal order keys are summed one after another, by a hash of the row. No task sorts more than a
    cell, and a window over the cells carries their sums on.
    """
    celled = with_cells(df, keys, order, cell, most, parts)
    sums = celled.groupBy(_CELL, _PART).agg(*[F.sum(w).alias(f"__w{i}") for i, w in enumerate(weights.values())])
    by = [F.col(f"{_CELL}.k{i}") for i in range(len(keys))]
    before = Window.partitionBy(*by).orderBy(F.col(f"{_CELL}.c"), _PART).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(_CELL, _PART, *[F.coalesce(F.sum(f"__w{i}").over(before), F.lit(0)).alias(f"__b{i}") for i in range(len(weights))])
    inside = Window.partitionBy(_CELL, _PART).orderBy(_KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = [(F.col(f"__b{i}") + F.coalesce(F.sum(w).over(inside), F.lit(0))).alias(name) for i, (name, w) in enumerate(weights.items())]
    return celled.join(bases.hint("merge"), [_CELL, _PART]).select(*df.columns, *local)


def sequence(df: DataFrame, keys: list[str], order: list[Column], out: str = "seq", cell: Column | None = None, ties: bool = False,
             most: int = MOST, parts: int = PARTS) -> DataFrame:
    """Row number of each row within its key, or rank when ``ties`` is set.

    Ranks are worked out on the distinct order keys, so that however many rows tie, they meet only their count.
    """
    if not ties:
        return running(df, keys, order, {out: F.lit(1)}, cell, most, parts)
    names = [f"__o{i}" for i in range(len(order))]
    group = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[o.alias(n) for n, o in zip(names, order)])
    keyed = df.select("*", group.alias("__g"), (F.lit(0) if cell is None else cell).alias("__coarse"))
    counts = keyed.groupBy("__g", "__coarse").agg(F.count(F.lit(1)).alias("__n"))
    parted = counts.select("__g", "__coarse", "__n", *[F.col(f"__g.k{i}").alias(f"__k{i}") for i in range(len(keys))])
    summed = running(parted, [f"__k{i}" for i in range(len(keys))], [F.col(f"__g.{n}") for n in names], {"__upto": F.col("__n")},
                     F.col("__coarse") if cell is not None else None, most, parts)
    ranks = summed.select("__g", (F.col("__upto") - F.col("__n") + 1).alias(out))
    return keyed.join(ranks, "__g").select(*df.columns, out)
