"""Severity-score building blocks driven by rule tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.scalars import _col, band, literal


def band_score(c, edges: list, points: list) -> Column:
    """Points of the first band whose upper edge exceeds the value; null stays null."""
    return band(c, edges, points)


def band_score_if(cond: Column, special: Column, otherwise: Column) -> Column:
    """Bands that change with the patient's context."""
    return F.when(cond, special).otherwise(otherwise)


def worst_of(lo, hi, lo_score: Column, hi_score: Column) -> tuple[Column, Column]:
    """The worse of two scores and the value behind it; the high value wins a tie."""
    lo, hi = _col(lo), _col(hi)
    use_hi = hi_score >= lo_score
    known = hi.isNotNull()
    score = F.when(known, F.when(use_hi, hi_score).otherwise(lo_score))
    value = F.when(known, F.when(use_hi, hi).otherwise(lo))
    return score, value


def grid_score(x, y, rows: list[tuple]) -> Column:
    """Two-way bands: ``rows`` holds ``(x_edge, y_edges, points)``, the last edge is ``None``."""
    x = _col(x)
    out = F.when(x.isNull() | _col(y).isNull(), F.lit(None))
    for edge, y_edges, points in rows:
        inner = band(y, y_edges, points)
        if edge is None:
            return out.otherwise(inner)
        out = out.when(x < edge, inner)
    return out


def table_score(rules: list[tuple[dict, int | None]]) -> Column:
    """Points of the first rule whose named columns all hold one of the listed values."""
    def holds(wanted):
        return " and ".join(f"`{n}` in ({', '.join(map(literal, v))})" for n, v in wanted.items())

    return F.expr("case " + " ".join(f"when {holds(w)} then {literal(p)}" for w, p in rules) + " end")
