"""Joins and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import within

def sorted_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Equi-join of two tables that both grow with the stays, by sorting.

    Sizes guessed in advance know neither how rows compress nor what is computed from them, so such a table
    would be broadcast, through the driver, long after it has stopped being small.
    """
    return left.join(right.hint("merge"), on, how)


#: Bits of a sieve for each of its keys, as a power of two, unless the caller knows how many keys there are.
SIEVE_BITS = 24


class Sieve:
    """Which keys a table holds, as bits, so that rows without a partner are left out before a join shuffles them.

    Every known value of a key sets the bit its hash names. The 2^bits bits (16 at least) of each key are one scalar subquery, so
    their size does not grow with the table and building the plan starts no job. More values than bits make it useless, not wrong.
    """

    def __init__(self, wanted: DataFrame, keys: list[str], bits: int = SIEVE_BITS):
        self.types = {k: wanted.schema[k].dataType for k in keys}
        self.bits, self.first = bits, {k: i << bits for i, k in enumerate(keys)}
        # 64 bits to a word, 512 words to a row
        held = wanted.select(F.explode(F.array(*[F.when(F.col(k).isNotNull(), self._at(k)) for k in keys])).alias("at")).where("at is not null")
        held = held.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("w"))
        blank = wanted.sparkSession.range(len(keys) << (bits - 6)).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("w"))
        words = held.unionByName(blank).groupBy("word").agg(F.bit_or("w").alias("w"))
        lists = words.groupBy(F.shiftright("word", 9).alias("row")).agg(F.sort_array(F.collect_list(F.struct("word", "w"))).alias("s"))
        self.table = lists.select("row", F.col("s.w").alias("s")).agg(F.sort_array(F.collect_list(F.struct("row", "s"))).alias("s")).select("s.s")

    def _at(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(1 << self.bits)) + F.lit(self.first[key])

    def rows(self, rows: DataFrame, key: str) -> DataFrame:
        """Rows whose ``key`` may be among the table's: all that are, and a few others."""
        if rows.schema[key].dataType != self.types[key]:
            raise ValueError(f"{key} is of two types, whose hashes differ")
        asked = F.struct(self.table.scalar().alias("table"), self._at(key).alias("at"))

        def held(x: Column) -> Column:
            word = F.get(F.get(x["table"], F.shiftright(x["at"], 15).cast("int")), F.shiftright(x["at"], 6).bitwiseAND(F.lit(511)).cast("int"))
            return F.getbit(word, x["at"].bitwiseAND(F.lit(63)).cast("int")) == 1

        # a lambda, so that the hash is worked out once and the code around stays small enough to be compiled
        known = rows.where(F.col(key).isNotNull()).withColumn("__sieve", asked)
        return known.where(F.exists(F.array("__sieve"), held)).select(*[F.col(f"`{c}`") for c in rows.columns])


def sieved(rows: DataFrame, key: str, wanted: DataFrame, bits: int = SIEVE_BITS) -> DataFrame:
    """Rows whose ``key`` may be among the values of that column of ``wanted``, for the larger side of an inner join on it."""
    return Sieve(wanted, [key], bits).rows(rows, key)


def assemble(base: DataFrame, parts: list[DataFrame], key: str) -> DataFrame:
    """Left-join concept tables (one row per key each) onto the base table."""
    out = base
    for part in parts:
        out = sorted_join(out, part, key, "left")
    return out


def in_cohort(df: DataFrame, cohort: DataFrame, on: list[str]) -> DataFrame:
    return df.join(cohort.select(*on), on, "left_semi")


def not_in_cohort(df: DataFrame, cohort: DataFrame, on: list[str]) -> DataFrame:
    return df.join(cohort.select(*on), on, "left_anti")


def filter_valid(df: DataFrame, item: str, value: str, rules: list[tuple]) -> DataFrame:
    """Rows whose value lies in the range of their item; items without a rule are dropped.

    ``rules`` holds ``(items, lo, hi, lo_closed, hi_closed)`` and folds into one predicate.
    """
    cond = F.lit(False)
    for items, lo, hi, lo_closed, hi_closed in rules:
        cond = cond | (F.col(item).isin(*items) & within(value, lo, hi, lo_closed, hi_closed))
    return df.where(cond)


def rule_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A constant table written into the plan. Rules are fixed text, so broadcasting them is safe."""
    def text(v):
        return "null" if v is None else repr(v) if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v)

    listed = ", ".join("(" + ", ".join(map(text, row)) + ")" for row in rows)
    return F.broadcast(spark.sql(f"select * from values {listed} as r({', '.join(columns)})"))


def with_rules(events: DataFrame, item: str, rules: dict, extra: list[str] | None = None) -> DataFrame:
    """Events of the listed items with the rule of their item.

    ``rules`` maps an item to ``(label, lo, hi, lo_closed, hi_closed, *extra)``. The item list also
    goes into a filter, which the scan can use; the rule columns come from a map-side join.
    """
    columns = [item, "label", "lo", "hi", "lo_closed", "hi_closed", *(extra or [])]
    rows = [(k, r[0], *[None if b is None else f"{float(b)}D" for b in r[1:3]], *r[3:]) for k, r in rules.items()]
    rows = [tuple(_Raw(v) if isinstance(v, str) and i in (2, 3) else v for i, v in enumerate(r)) for r in rows]
    table = rule_table(events.sparkSession, columns, rows)
    return events.where(F.col(item).isin(*rules)).join(table, item)


class _Raw(str):
    """SQL text that is not quoted."""

    def __repr__(self) -> str:
        return str(self)


def label_items(item: str, rules: dict[str, list]) -> Column:
    """Label of the item set an item belongs to, null outside all sets."""
    out = None
    for label, items in rules.items():
        cond = F.col(item).isin(*items)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def label_valid(item: str, value: str, rules: list[tuple]) -> Column:
    """Label by item and range together: a value outside its range loses the label, not the row."""
    out = None
    for label, items, lo, hi, lo_closed, hi_closed in rules:
        cond = F.col(item).isin(*items) & within(value, lo, hi, lo_closed, hi_closed)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


# --- duplicates and revisions ---------------------------------------------------------------
def keep_consistent(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows of the groups in which all known values agree.

    Groups with a null key are dropped, as an equality join on the keys would.
    """
    agree = df.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    agree = agree.where(F.col("__lo").eqNullSafe(F.col("__hi"))).select(*keys)
    return df.join(agree, keys, "left_semi")


def latest_consistent(
    df: DataFrame, keys: list[str], revision: str, value: str, valid: Column
) -> DataFrame:
    """Value of the newest revision per key, among revisions that agree and hold a valid value.

    Two aggregations with partial combine do the work of a duplicate filter, a self-join and a
    ranking: one row per revision first, one row per key after that.
    """
    per_revision = (
        df.where(F.col(revision).isNotNull())
        .groupBy(*keys, revision)
        .agg(F.min(value).alias(value), F.max(value).alias("__hi"))
        .where(F.col(value) == F.col("__hi"))
    )
    return per_revision.where(valid).groupBy(*keys).agg(F.max_by(value, revision).alias(value))


# --- code maps --------------------------------------------------------------------------------
def lookup(df: DataFrame, dim: DataFrame, on: dict[str, str], take: dict[str, str]) -> DataFrame:
    """Left join to a code map on one or more keys; adaptive execution broadcasts it where it measures small.

    ``on`` maps data columns to map columns and ``take`` map columns to output names, so clashing
    names never meet.
    """
    keys = {m: f"__k{i}" for i, m in enumerate(on.values())}
    side = dim.select(*[F.col(m).alias(k) for m, k in keys.items()],
                      *[F.col(m).alias(o) for m, o in take.items()])
    cond = None
    for d, m in on.items():
        eq = df[d] == F.col(keys[m])
        cond = eq if cond is None else cond & eq
    return df.join(side, cond, "left").drop(*keys.values())


def two_step_lookup(
    df: DataFrame, dim: DataFrame, code: tuple[str, str], second: tuple[str, str], take: list[str]
) -> DataFrame:
    """Codes with one map row resolve by code alone, ambiguous ones by code and a second key.

    ``code`` and ``second`` are (data column, map column). Map rows with a null are ignored.
    """
    dim = dim.na.drop()
    ambiguous = dim.groupBy(code[1]).count().where("count > 1").select(code[1])
    plain = dim.join(ambiguous, code[1], "left_anti")
    double = dim.join(ambiguous, code[1], "left_semi")
    one = lookup(df, plain, {code[0]: code[1]}, {c: f"__1{c}" for c in take})
    two = lookup(one, double, {code[0]: code[1], second[0]: second[1]}, {c: f"__2{c}" for c in take})
    return two.select(*df.columns, *[F.coalesce(f"__1{c}", f"__2{c}").alias(c) for c in take])


def code_bridge(dim: DataFrame, code: str, attr: str) -> DataFrame:
    """Distinct (main code, attribute) pairs of a map with sub-codes; code 0 means undefined."""
    main = F.substring_index(F.col(code), ".", 1)
    return dim.select(main.alias(code), attr).where(F.col(code) != "0").distinct()


# --- coverage and reconciliation ---------------------------------------------------------------
def coverage(
    base: DataFrame, events: DataFrame, key: str, group: list[str], counted: str, out: str
) -> DataFrame:
    """Events per group, counted per key before the key meets its group."""
    per_key = events.groupBy(key).agg(F.count(counted).alias("__n"))
    return (
        base.select(key, *group).join(per_key, key)
        .groupBy(*group).agg(F.sum("__n").alias(out))
    )


#: Bits by which each level of the digest tree cuts the key space.
LEVEL_BITS = 12


def _both_sides(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of both sides with a known key: side, place of the key's hash, two digests of the row."""
    def side(df, which):
        row = [F.col(f"`{c}`") for c in (key, *columns)]
        return df.where(F.col(key).isNotNull()).select(
            F.lit(which).alias("side"), F.xxhash64(key).alias("at"), F.xxhash64(*row).alias("d1"), F.xxhash64(F.lit("2"), *row).alias("d2"))

    return side(a, 0).unionByName(side(b, 1))


def differing_ranges(a: DataFrame, b: DataFrame, key: str, columns: list[str], levels: int = 2) -> DataFrame:
    """Ranges of the key's hash in which the two versions differ: ``range``, ``rows_a``; 2^(12 * levels) ranges in all.

    A digest tree, read from the top: every level totals counts and digests of the ranges that differed on the level
    above, both sides in one pass, and goes on with those that differ. What a task sends is one row per range it met.
    Keys must be unique on each side, as for any row-by-row comparison; rows with a null key are left out.
    """
    rows, found = _both_sides(a, b, key, columns), None
    for level in range(1, levels + 1):
        if found is not None:
            above = F.shiftright("at", 64 - LEVEL_BITS * (level - 1)).alias("range")
            # at most 2^12 rows below the top, and only as many as there are ranges with a difference
            rows = rows.withColumn("range", above).join(F.broadcast(found.select("range")) if level == 2 else found.select("range"), "range", "left_semi")
        digest = [F.count(F.when(F.col("side") == w, 1)).alias(f"rows_{n}") for w, n in ((0, "a"), (1, "b"))]
        digest += [F.coalesce(F.bit_xor(F.when(F.col("side") == w, F.col(d))), F.lit(0)).alias(f"{d}_{w}") for w in (0, 1) for d in ("d1", "d2")]
        totals = rows.groupBy(F.shiftright("at", 64 - LEVEL_BITS * level).alias("range")).agg(*digest)
        found = totals.where("rows_a <> rows_b or d1_0 <> d1_1 or d2_0 <> d2_1").select("range", "rows_a")
    return found


def _differing_rows(a: DataFrame, b: DataFrame, key: str, columns: list[str], levels: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both sides cut down to the differing ranges (rows of ``a`` without a key stay), and the ranges."""
    found = differing_ranges(a, b, key, columns, levels)
    here = F.shiftright(F.xxhash64(key), 64 - LEVEL_BITS * levels)
    wanted = found.select(F.col("range").alias("__range"))
    left, right = (df.withColumn("__range", F.when(F.col(key).isNotNull(), here)) for df in (a.select(key, *columns), b.select(key, *columns)))
    keyless = left.where(F.col("__range").isNull())
    return left.join(wanted, "__range", "left_semi").unionByName(keyless).drop("__range"), right.join(wanted, "__range", "left_semi").drop("__range"), found


def reconcile(a: DataFrame, b: DataFrame, key: str, columns: list[str], levels: int = 2) -> DataFrame:
    """Per column, how many rows of ``a`` agree with ``b`` (null agrees with null); keys are unique on each side.

    Only rows in key ranges whose digests differ are joined. All others agree, and are counted.
    """
    near, far, found = _differing_rows(a, b, key, columns, levels)
    left = near.select(key, *[F.col(c).alias(f"__a_{c}") for c in columns])
    right = far.select(key, *[F.col(c).alias(f"__b_{c}") for c in columns])
    same = [F.sum(F.col(f"__a_{c}").eqNullSafe(F.col(f"__b_{c}")).cast("long")).alias(c) for c in columns]
    wide = left.join(right, key, "left").agg(F.count(F.lit(1)).alias("__n"), *same)
    agreeing = a.agg(F.count(key).alias("c")).scalar() - found.agg(F.coalesce(F.sum("rows_a"), F.lit(0)).alias("c")).scalar()
    wide = wide.withColumn("__equal", agreeing)
    counts = [(F.coalesce(F.col(c), F.lit(0)) + F.col("__equal")).alias(c) for c in columns]
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.select((F.col("__n") + F.col("__equal")).alias("n_rows"), *counts).selectExpr(
        "n_rows", f"stack({len(columns)}, {pairs}) as (variable, n_match)")


def mismatches(a: DataFrame, b: DataFrame, key: str, column: str, levels: int = 2) -> DataFrame:
    """Rows of ``a`` whose column differs from ``b``; only key ranges whose digests differ are joined."""
    near, far, _ = _differing_rows(a, b, key, [column], levels)
    left = near.select(key, F.col(column).alias(f"{column}_a"))
    right = far.select(key, F.col(column).alias(f"{column}_b"))
    return left.join(right, key, "left").where(
        ~F.col(f"{column}_a").eqNullSafe(F.col(f"{column}_b"))
    )
