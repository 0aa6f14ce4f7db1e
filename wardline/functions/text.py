"""Text parsing: measurements with units, codes, keys and keyword flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import CM_PER_INCH, _col, to_number


def _strip_unit(c: Column, unit: str) -> Column:
    return to_number(F.trim(F.replace(c, F.lit(unit), F.lit(""))))


def parse_weight(c) -> Column:
    """Kilograms from text such as ``62 kg``."""
    return _strip_unit(_col(c), "kg")


def parse_height(c) -> Column:
    """Centimetres from text in inches, centimetres or without a unit."""
    c = F.lower(_col(c))
    return (
        F.when(c.contains("inch"), _strip_unit(c, "inch") * CM_PER_INCH)
        .when(c.contains("cm"), _strip_unit(c, "cm"))
        .otherwise(_strip_unit(c, "na"))
    )


def parse_age(c, limit: float = 150) -> Column:
    """Years from text in months, yrs, years or without a unit; implausible bare numbers are null."""
    c = F.lower(_col(c))
    bare = _strip_unit(c, "na")
    return (
        F.when(c.contains("months"), _strip_unit(c, "months") / 12.0)
        .when(c.contains("yrs"), _strip_unit(c, "yrs"))
        .when(c.contains("years"), _strip_unit(c, "years"))
        .otherwise(F.when(bare <= limit, bare))
    )


def main_code(c) -> Column:
    """The part of a code before its first dot."""
    return F.substring_index(_col(c), ".", 1)


def code_text(c) -> Column:
    """Integer code as text, with zero meaning none."""
    return F.nullif(_col(c).cast("int").cast("string"), F.lit("0"))


def key_of(*parts) -> Column:
    """Key built from parts; null when any part is null."""
    return F.concat(*[_col(p).cast("string") for p in parts])


def contains_flag(c, word: str, yes: str, no: str) -> Column:
    """``yes`` when the word occurs, ``no`` otherwise and for null."""
    return F.when(_col(c).contains(word), F.lit(yes)).otherwise(F.lit(no))


def matches(c, pattern: str, ignore_case: bool = True) -> Column:
    return _col(c).rlike(("(?i)" if ignore_case else "") + pattern)


def first_match_code(c, rules: list[tuple[str, int]]) -> Column:
    """Code of the first pattern that matches the text, null when none does."""
    out = None
    for pattern, code in rules:
        cond = matches(c, pattern)
        out = F.when(cond, F.lit(code)) if out is None else out.when(cond, F.lit(code))
    return out


def rescue_misplaced(target, source, marker: str = "NA") -> tuple[Column, Column]:
    """A value typed behind ``marker`` in ``source`` moves to ``target``; source becomes 'na'."""
    source = _col(source)
    hit = source.contains(marker)
    moved = F.trim(F.replace(source, F.lit(marker), F.lit("")))
    return F.when(hit, moved).otherwise(_col(target)), F.when(hit, F.lit("na")).otherwise(source)
