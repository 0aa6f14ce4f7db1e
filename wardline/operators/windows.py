"""Joining observations to the time window of a stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import within
from .balanced import MOST, running
from .joins import Sieve
from .ordered import time_cell


def events_in_window(
    stays: DataFrame,
    events: DataFrame,
    on: list[str],
    ts: str,
    lo: Column,
    hi: Column,
    cell_seconds: int = 6 * 3600,
    lo_closed: bool = True,
    hi_closed: bool = True,
    few_stays: bool = False,
) -> DataFrame:
    """Inner join of stays to the events that fall between ``lo`` and ``hi`` of the stay.

    Each stay lists the time cells its window touches and the join is an equi-join on key and
    cell. A stay with a huge history therefore spreads over many tasks, and events outside any
    window match nothing. The window of a stay must be of bounded length. Both sides are sorted:
    stays with their cells grow with the stays, and their size is unknown when the plan is made,
    so they are never broadcast. With ``few_stays``, for stays that few of the events belong to, events whose key
    and cell no stay lists are left out before they are shuffled.
    """
    bounded = stays.withColumn("__lo", lo).withColumn("__hi", hi)
    ok = F.col("__lo") <= F.col("__hi")
    cells = F.explode(F.sequence(time_cell("__lo", cell_seconds), time_cell("__hi", cell_seconds)))
    left = bounded.where(ok).withColumn("__cell", cells)
    clash = [c for c in events.columns if c in stays.columns and c not in on]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    right = events.where(F.col(ts).isNotNull()).withColumn("__cell", time_cell(ts, cell_seconds))
    if few_stays:
        if any(left.schema[k].dataType != right.schema[k].dataType for k in on):
            raise ValueError(f"{on} are of two types, whose hashes differ")
        place = F.xxhash64(*on, "__cell").alias("__place")
        right = Sieve(left.select(place), ["__place"]).rows(right.select("*", place), "__place").drop("__place")
    joined = left.hint("merge").join(right, [*on, "__cell"])
    keep = within(ts, F.col("__lo"), F.col("__hi"), lo_closed, hi_closed)
    return joined.where(keep).drop("__lo", "__hi", "__cell")


def events_before(
    stays: DataFrame, events: DataFrame, on: list[str], ts: str, hi: Column, salts: int = 32
) -> DataFrame:
    """Inner join of stays to all their events before ``hi``, with no lower limit.

    Events of one stay spread over ``salts`` join partitions by a hash of their time; each stay
    row is repeated once per salt.
    """
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    left = stays.withColumn("__hi", hi).withColumn("__salt", salt)
    right = events.withColumn("__salt", F.pmod(F.xxhash64(ts), F.lit(salts)).cast("int"))
    return left.join(right, [*on, "__salt"]).where(F.col(ts) < F.col("__hi")).drop("__hi", "__salt")


def offset_window(df: DataFrame, offset: str, lo: int, hi: int, closed: bool = True) -> DataFrame:
    """Rows whose minute offset lies in the window."""
    return df.where(within(offset, lo, hi, closed, closed))


def overlap_flag(
    stays: DataFrame,
    spans: DataFrame,
    key: str,
    point: str,
    start: str,
    end: str,
    reach: Column,
    out: str,
    most: int = MOST,
) -> DataFrame:
    """1 per stay when some span is open at ``point`` or starts within ``reach`` after it.

    A sweep: spans that open and close and the points of the stays are read once in time order, and the number of
    spans open at a point is a running total. No stay meets a span, however many of either share a key. A span that
    ends before it would open counts for nothing, and neither does a null key, point or end.
    """
    opens, closes = F.col(start) - reach, F.col(end)
    known = spans.where(F.col(key).isNotNull() & (opens <= closes))
    edges = F.explode(F.array(F.struct(opens.alias("__at"), F.lit(0).alias("__kind"), F.lit(1).alias("__w")),
                              F.struct(closes.alias("__at"), F.lit(2).alias("__kind"), F.lit(-1).alias("__w"))))
    # equal edges of a key count together, so a key's spans are few rows where they repeat
    edges = known.select(key, edges.alias("e")).groupBy(key, "e.__at", "e.__kind").agg(F.sum("e.__w").alias("__w"))
    points = stays.select(key, F.col(point).alias("__at"), F.lit(1).alias("__kind"), F.lit(0).alias("__w"), F.struct("*").alias("__row"))
    stacked = edges.unionByName(points, allowMissingColumns=True)
    swept = running(stacked, [key], [F.col("__at"), F.col("__kind")], {"__open": F.col("__w")}, most=most)
    return swept.where(F.col("__kind") == 1).select("__row.*", (F.col("__open") > 0).cast("int").alias(out))


def span_overlap(left: DataFrame, right: DataFrame, on: list[str], a: tuple, b: tuple, most: int = MOST) -> DataFrame:
    """Pairs of spans of a key that share at least one moment; columns of both sides, the key once.

    Two spans overlap when one starts inside the other. A sweep over all starts and ends numbers the starts of each
    side within the key and tells every span between which numbers the other side's starts fall into it. A span then
    lists those numbers, and an equi-join on key and number finds their spans: every row it makes is a pair of the
    result, so a key with many spans on both sides costs what it returns and is spread over its numbers. Equal
    rows travel as one with a count. A span that ends before it starts, or has a null key, start or end, has no pairs.
    """
    def side(df, ends, which):
        lo, hi = F.col(ends[0]), F.col(ends[1])
        rows = df.where((lo <= hi) & F.expr(" and ".join(f"`{k}` is not null" for k in on)))
        rows = rows.groupBy(*on, F.struct(*df.columns).alias("__row"), lo.alias("__lo"), hi.alias("__hi")).agg(F.count(F.lit(1)).alias("__many"))
        # at one moment: starts of the right, starts of the left, then ends
        moments = F.explode(F.array(F.struct(F.col("__lo").alias("at"), F.lit(1 - which).alias("kind")),
                                    F.struct(F.col("__hi").alias("at"), F.lit(2).alias("kind"))))
        return rows.select(*on, F.lit(which).alias("__side"), F.col("__row").alias(f"__row{which}"), "__many", moments.alias("__e"))

    stacked = side(left, a, 0).unionByName(side(right, b, 1), allowMissingColumns=True)
    starts = {"__left": F.when(F.col("__e.kind") == 1, 1).otherwise(0), "__right": F.when(F.col("__e.kind") == 0, 1).otherwise(0)}
    swept = running(stacked, on, [F.col("__e.at"), F.col("__e.kind")], starts, most=most)

    # one row per span: its number among the starts of its side, and the other side's numbers that start inside it
    starting = F.col("__e.kind") < 2
    own, other = (F.when(F.col("__side") == 0, F.col(x)).otherwise(F.col(y)) for x, y in (("__left", "__right"), ("__right", "__left")))
    facts = swept.groupBy(*on, "__side", "__row0", "__row1", "__many").agg(
        F.max(F.when(starting, own)).alias("__no"), F.max(F.when(starting, other)).alias("__from"), F.max(F.when(~starting, other)).alias("__upto"))
    asked = facts.where("__from < __upto").select(
        *on, (1 - F.col("__side")).alias("__side"), F.col("__row0").alias("__a0"),
        F.col("__row1").alias("__a1"), F.col("__many").alias("__asked"), F.explode(F.sequence(F.col("__from") + 1, F.col("__upto"))).alias("__no"))
    met = asked.join(facts.drop("__from", "__upto"), [*on, "__side", "__no"])
    pairs = met.select(*on, F.coalesce("__a0", "__row0").alias("__row0"), F.coalesce("__a1", "__row1").alias("__row1"), "__asked", "__many")
    # copies of a pair are unfolded in two steps, so no array is longer than a side's copies
    unfolded = pairs.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__asked")))).withColumn(
        "__j", F.explode(F.sequence(F.lit(1), F.col("__many"))))
    return unfolded.select(*on, *[F.col(f"__row0.`{c}`").alias(c) for c in left.columns if c not in on],
                           *[F.col(f"__row1.`{c}`").alias(c) for c in right.columns if c not in on])
