"""Long-to-wide reshaping and per-stay summaries.

Rows are combined per (key, label, time frame) first, on the map side, with a handful of plain
aggregates; only those combined rows are spread into columns. A wide list of conditional
aggregates would instead evaluate every column's condition for every event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import is_true, within


def _by_key(combined: DataFrame, keys: list[str]) -> DataFrame:
    """Rows combined per key and label, dealt by key, so that a task spreads the keys it was dealt and no others.

    Dealt by key and label, nearly every key would be in every task, each as a wide row. A key has at most one row
    per label here. The number of parts is the session's, as narrow rows measure too small for what they become.
    """
    return combined.repartition(int(combined.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def long_to_wide(df: DataFrame, keys: list[str], label: str, value: str, labels: list[str]) -> DataFrame:
    """One row per key with a column per label holding the largest value."""
    combined = df.groupBy(*keys, label).agg(F.max(value).alias("__v"))
    return _by_key(combined, keys).groupBy(*keys).pivot(label, labels).agg(F.max("__v"))


def _level(frames: dict[str, Column]) -> Column:
    """Index of the innermost frame a row lies in, null outside all frames."""
    out = F.lit(None).cast("int")
    for i, cond in reversed(list(enumerate(frames.values()))):
        out = F.when(is_true(cond), F.lit(i)) if i == len(frames) - 1 else F.coalesce(out, F.when(is_true(cond), F.lit(i)))
    return out


def summarise(
    df: DataFrame,
    keys: list[str],
    label: str,
    value: str,
    columns: dict[str, list[str]],
    stats: list[str],
    frames: dict[str, Column] | None = None,
) -> DataFrame:
    """min/max/mean per label set, for several time frames in one pass.

    ``columns`` maps an output stem to the labels it pools (for instance both ways of measuring
    blood pressure). ``frames`` maps a prefix to the row condition of that frame; list the widest
    first, each frame lying inside the one before.
    """
    frames = frames or {"": F.lit(True)}
    labels = list(dict.fromkeys(x for xs in columns.values() for x in xs))
    cell = F.concat(F.col(label), F.lit("__"), _level(frames).cast("string"))
    cells = [f"{x}__{i}" for x in labels for i in range(len(frames))]
    v = F.col(value)
    aggs = {"lo": F.min(v), "hi": F.max(v)}
    if "mean" in stats:
        aggs |= {"sum": F.sum(v), "n": F.count(v)}
    combined = df.withColumn("__cell", cell).groupBy(*keys, "__cell").agg(*[a.alias(f"__{k}") for k, a in aggs.items()])
    wide = _by_key(combined, keys).groupBy(*keys).pivot("__cell", cells).agg(*[F.max(f"__{k}").alias(k) for k in aggs])
    outs = []
    for i, frame in enumerate(frames):
        for stem, pooled in columns.items():
            at = [f"{x}__{j}" for x in pooled for j in range(i, len(frames))]
            text = {"min": _fold("least", at, "lo"), "max": _fold("greatest", at, "hi"),
                    "mean": f"({_total(at, 'sum')}) / nullif({_total(at, 'n')}, 0)"}
            outs += [f"{text[s]} as `{frame}_{stem}_{s}`" if frame else f"{text[s]} as `{stem}_{s}`" for s in stats]
    return wide.selectExpr(*keys, *outs)


def _fold(fn: str, cells: list[str], kind: str) -> str:
    names = [f"`{c}_{kind}`" for c in cells]
    return names[0] if len(names) == 1 else f"{fn}({', '.join(names)})"


def _total(cells: list[str], kind: str) -> str:
    return " + ".join(f"coalesce(`{c}_{kind}`, 0)" for c in cells)


def minmax(
    df: DataFrame,
    keys: list[str],
    columns: dict[str, str | Column],
    frames: dict[str, Column] | None = None,
    ranges: dict[str, tuple] | None = None,
) -> DataFrame:
    """Smallest and largest value per wide column, optionally inside a range, per time frame.

    ``frames`` are nested as in ``summarise``. Each frame level is aggregated once; the frames are
    then put together from at most one row per key and level.
    """
    cols = []
    for stem, src in columns.items():
        v = F.col(src) if isinstance(src, str) else src
        if ranges and stem in ranges:
            v = F.when(within(v, *ranges[stem]), v)
        cols.append(v.alias(stem))
    ends = [F.expr(f"{e}(`{s}`) as `{s}_{e}`") for s in columns for e in ("min", "max")]
    if not frames:
        return df.select(*keys, *cols).groupBy(*keys).agg(*ends)
    levels = df.select(*keys, _level(frames).alias("__lv"), *cols).groupBy(*keys, "__lv").agg(*ends)
    outs = [F.expr(f"{e}(`{s}_{e}`) filter (where __lv >= {i}) as `{frame}_{s}_{e}`")
            for i, frame in enumerate(frames) for s in columns for e in ("min", "max")]
    return levels.groupBy(*keys).agg(*outs)


def signed_sum(df: DataFrame, keys: list[str], value: str, negative: Column, out: str) -> DataFrame:
    """Sum in which rows meeting ``negative`` are subtracted."""
    v = F.col(value)
    return df.groupBy(*keys).agg(F.sum(F.when(negative, -v).otherwise(v)).alias(out))


def first_time_where(df: DataFrame, keys: list[str], ts: str, cond: Column, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(F.when(cond, F.col(ts))).alias(out))


def observed_span(df: DataFrame, keys: list[str], ts: str, first: str, last: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias(first), F.max(ts).alias(last))


def any_flag(df: DataFrame, keys: list[str], cond: Column, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(F.when(cond, 1).otherwise(0)).alias(out))
