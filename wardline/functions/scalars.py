"""Column expressions: cleaning, recoding, units, time and arithmetic.

All of them are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------
NUMERIC_TEXT = r"^[-]?[0-9]+[.]?[0-9]*$"
NOT_NUMBERS = ("-", ".")
DAYS_PER_YEAR = 365.242
CM_PER_INCH = 2.54
ATMOSPHERE_MINUS_WATER = 760 - 47
RESPIRATORY_QUOTIENT = 0.8
# unit factors, multiplied into the source value
UNIT_FACTORS = {
    "umol_creatinine_to_mg_dl": 1 / 88.42,
    "mmol_glucose_to_mg_dl": 18.018018,
    "fraction_to_percent": 100.0,
    "g_l_to_g_dl": 0.1,
    "umol_bilirubin_to_mg_dl": 1 / 17.1,
    "mmol_urea_to_mg_dl": 1 / 0.3571,
}
# ------------------------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- predicates and cleaning ---------------------------------------------------------------
def is_true(predicate: Column) -> Column:
    """A row mask in which unknown counts as false."""
    return F.coalesce(predicate, F.lit(False))


def differs(c, value) -> Column:
    """Null-safe inequality: null differs from any value."""
    return ~_col(c).eqNullSafe(F.lit(value))


def within(c, lo=None, hi=None, lo_closed: bool = True, hi_closed: bool = True) -> Column:
    """Range predicate with open or closed ends; ``None`` leaves an end unbounded."""
    c, parts = _col(c), []
    if lo is not None:
        parts.append(c >= lo if lo_closed else c > lo)
    if hi is not None:
        parts.append(c <= hi if hi_closed else c < hi)
    if not parts:
        return c.isNotNull()
    return reduce(lambda a, b: a & b, parts)


def within_rule(c, rule: str = "") -> Column:
    """Range predicate whose bounds are columns ``lo, hi, lo_closed, hi_closed`` of the row."""
    c, lo, hi = _col(c), F.col(f"{rule}lo"), F.col(f"{rule}hi")
    above = lo.isNull() | (c > lo) | (F.col(f"{rule}lo_closed") & (c == lo))
    below = hi.isNull() | (c < hi) | (F.col(f"{rule}hi_closed") & (c == hi))
    return c.isNotNull() & above & below


def keep_within(c, lo=None, hi=None, lo_closed: bool = True, hi_closed: bool = True) -> Column:
    """The value inside its plausible range, else null."""
    return F.when(within(c, lo, hi, lo_closed, hi_closed), _col(c))


def percent_or_null(c) -> Column:
    return keep_within(c, 0, 100)


def sentinel_null(c, sentinel=-1) -> Column:
    return F.nullif(_col(c), F.lit(sentinel))


def to_number(c) -> Column:
    """Text to double; text that is no number becomes null."""
    return _col(c).try_cast("double")


def is_numeric_text(c) -> Column:
    c = _col(c)
    return c.rlike(NUMERIC_TEXT) & ~c.isin(*NOT_NUMBERS)


def numeric_text(c) -> Column:
    """Charted text to double, only where the whole text is a plain number."""
    return F.when(is_numeric_text(c), to_number(c))


def to_datetime(c, fmt: str | None = None) -> Column:
    c = _col(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else c.try_cast("timestamp_ntz")


# --- recoding -------------------------------------------------------------------------------
def map_codes(c, codes: dict) -> Column:
    """Dictionary lookup; a code outside the dictionary gives null."""
    pairs = [F.lit(x) for pair in codes.items() for x in pair if pair[1] is not None]
    return F.create_map(*pairs)[_col(c)]


def recode(c, groups: dict[str, list], default=None) -> Column:
    """Many codes to few labels: ``{label: [codes]}`` with a default for the rest."""
    out = None
    for label, codes in groups.items():
        cond = _col(c).isin(*codes)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def literal(v) -> str:
    """SQL text of a constant."""
    if v is None:
        return "null"
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def band(c, edges: list, labels: list) -> Column:
    """Step function: ``labels[i]`` for the first ``c < edges[i]``, the last label otherwise."""
    if len(labels) != len(edges) + 1:
        raise ValueError("band needs one label more than it has edges")
    if isinstance(c, str):
        # one parsed expression instead of dozens of calls into the JVM
        steps = " ".join(f"when `{c}` < {e} then {literal(x)}" for e, x in zip(edges, labels))
        return F.expr(f"case when `{c}` is null then null {steps} else {literal(labels[-1])} end")
    out = F.when(c.isNull(), F.lit(None))
    for edge, label in zip(edges, labels):
        out = out.when(c < edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def any_equal(cols: list, value) -> Column:
    """1 when any column equals the value, else 0 (null counts as not equal)."""
    return reduce(or_, [is_true(_col(c) == value) for c in cols]).cast("int")


def sum_all(cols: list) -> Column:
    """Sum that is null as soon as one part is null."""
    return reduce(add, [_col(c) for c in cols])


def sum_known(cols: list) -> Column:
    """Sum in which a missing part counts as zero."""
    return reduce(add, [F.coalesce(_col(c), F.lit(0)) for c in cols])


# --- units ----------------------------------------------------------------------------------
def convert(c, unit: str) -> Column:
    return _col(c) * F.lit(UNIT_FACTORS[unit])


def fahrenheit_to_celsius(c) -> Column:
    return (_col(c) - 32) / 1.8


def celsius_by_value(c, lo: float = 25, hi: float = 46) -> Column:
    """Temperature in either unit, told apart by its size; outside both ranges null."""
    c = _col(c)
    as_fahrenheit = within(c, lo * 1.8 + 32, hi * 1.8 + 32, False, False)
    return F.when(as_fahrenheit, fahrenheit_to_celsius(c)).when(within(c, lo, hi, False, False), c)


def metres_or_cm(c) -> Column:
    """Height in cm from a column that mixes metres and centimetres."""
    c = _col(c)
    return F.when(within(c, 0.5, 3.0, True, False), c * 100).when(within(c, 50, 300), c)


def inches_to_cm(c) -> Column:
    return _col(c) * CM_PER_INCH


def percent_to_fraction(c, threshold: float = 20) -> Column:
    """Values from the threshold up are read as percent."""
    c = _col(c)
    return F.when(c >= threshold, c / 100.0).otherwise(c)


def bmi(weight, height_cm) -> Column:
    metres = _col(height_cm) / 100
    return F.try_divide(_col(weight), metres * metres)


def aado2(fio2, pco2, po2) -> Column:
    """Alveolar-arterial oxygen gradient."""
    return (_col(fio2) * ATMOSPHERE_MINUS_WATER - _col(pco2) / RESPIRATORY_QUOTIENT) - _col(po2)


def pf_ratio(po2, fio2) -> Column:
    return F.try_divide(_col(po2), _col(fio2))


# --- time -----------------------------------------------------------------------------------
def micros(ts) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, the same in every session zone."""
    return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), _col(ts).cast("timestamp_ntz"))


def seconds(ts) -> Column:
    """Whole seconds since 1970, rounded down."""
    exact = micros(ts)
    return F.call_function("div", exact - F.pmod(exact, F.lit(1_000_000)), F.lit(1_000_000))


def elapsed(start, end, unit: str = "minutes") -> Column:
    per = {"seconds": 1e6, "minutes": 6e7, "hours": 3.6e9, "days": 8.64e10}[unit]
    return (micros(end) - micros(start)) / per


def shift(ts, **parts) -> Column:
    """Timestamp plus an interval, e.g. ``shift("intime", hours=-2)``."""
    text = " ".join(f"{value} {unit}" for unit, value in parts.items())
    return _col(ts) + F.expr(f"INTERVAL {text}")


def days_between(start, end) -> Column:
    return F.datediff(_col(end), _col(start))


def age_years(born, at, digits: int | None = None) -> Column:
    age = days_between(born, at) / DAYS_PER_YEAR
    return age if digits is None else F.round(age, digits)


def age_topcoded(born, at, top: float = 91.6, shifted_years: int = 199) -> Column:
    """Age in years; births shifted far into the past mean 'over 89' and get the top code."""
    exact = elapsed(born, at, "days") / DAYS_PER_YEAR
    return F.round(F.when(_col(at) > shift(born, years=shifted_years), F.lit(top)).otherwise(exact), 2)


def minutes_to_days(c) -> Column:
    return _col(c) / 60.0 / 24.0


def hours_to_days(c) -> Column:
    return _col(c) / 24.0


def year_between(ts, first: int, last: int) -> Column:
    return is_true(F.year(_col(ts)).between(first, last))


# --- probability ----------------------------------------------------------------------------
def logistic(z) -> Column:
    return 1 / (1 + F.exp(-_col(z)))


def imputed_terms(terms: list[tuple]) -> Column:
    """Sum of ``beta * x`` where a missing ``x`` is replaced by a constant contribution.

    ``terms`` holds ``(beta, column, contribution_when_null)``.
    """
    return reduce(add, [F.coalesce(F.lit(b) * _col(x), F.lit(const)) for b, x, const in terms])
