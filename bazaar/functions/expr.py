"""Column-expression helpers that reproduce the reference's scalar semantics.

All helpers return JVM-side ``Column`` expressions (whole-stage codegen friendly); none is a UDF.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"

# Microseconds per DATEDIFF unit.
_UNIT_MICROS = {"MINUTE": 60_000_000, "HOUR": 3_600_000_000, "DAY": 86_400_000_000}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- literals / as_of
def ts_lit(value) -> Column:
    """TIMESTAMP_NTZ literal (no session time zone involved). Accepts datetime/date/str."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(value)
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def date_lit(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.date()
    return F.expr(f"DATE '{value}'")


def dec_lit(value, precision: int = 10, scale: int = 2) -> Column:
    return F.lit(Decimal(str(value))).cast(f"decimal({precision},{scale})")


def as_date(c) -> Column:
    """CAST(x AS DATE) for a timestamp_ntz column."""
    return col(c).cast("date")


# ---------------------------------------------------------------- dates
def month_start(c) -> Column:
    """DATEFROMPARTS(YEAR(x), MONTH(x), 1)."""
    return F.trunc(as_date(c), "MM")


def epoch_micros(c) -> Column:
    """Microseconds since 1970-01-01 for a timestamp_ntz, free of the session time zone."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), col(c))


def _floor_div(x: Column, n: int) -> Column:
    return (x - F.pmod(x, F.lit(n))) / F.lit(n)


def boundary_diff(unit: str, start, end) -> Column:
    """T-SQL ``DATEDIFF(unit, start, end)``: number of unit *boundaries* crossed (M1).

    Spark's ``timestampdiff`` counts elapsed units, which is 0 where T-SQL returns 1 for
    23:59 -> 00:01. Result is BIGINT; NULL if either side is NULL."""
    unit = unit.upper()
    a, b = col(start), col(end)
    if unit == "DAY":
        return F.datediff(as_date(b), as_date(a)).cast("bigint")
    if unit == "MONTH":
        return ((F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))).cast("bigint")
    if unit == "YEAR":
        return (F.year(b) - F.year(a)).cast("bigint")
    if unit in _UNIT_MICROS:
        n = _UNIT_MICROS[unit]
        return (_floor_div(epoch_micros(b), n) - _floor_div(epoch_micros(a), n)).cast("bigint")
    raise ValueError(f"unsupported DATEDIFF unit {unit}")


def days_between_ms(start, end) -> Column:
    """Mongo ``($subtract: [end, start]) / 86400000`` as a double."""
    return (epoch_micros(end) - epoch_micros(start)).cast("double") / F.lit(86_400_000_000.0)


# ---------------------------------------------------------------- strings
def concat_null_safe(*cols) -> Column:
    """T-SQL ``CONCAT(a, b, ...)``: NULL arguments count as ''."""
    return F.concat_ws("", *[col(c).cast("string") for c in cols])


def concat_plus(*cols) -> Column:
    """T-SQL ``a + b`` on strings: NULL if any side is NULL."""
    return F.concat(*[col(c) for c in cols])


def full_name(first="FirstName", last="LastName") -> Column:
    return concat_plus(col(first), F.lit(" "), col(last))


# ---------------------------------------------------------------- numbers
def exact_avg(c) -> Column:
    """AVG over exact decimals returned as DOUBLE: Σ (exact) / count. Deterministic bit for bit
    regardless of summation order, unlike averaging doubles."""
    x = col(c)
    n = F.count(x)
    return F.when(n > 0, F.sum(x).cast("double") / n.cast("double"))


def pct(numer, denom, digits: int | None = 2) -> Column:
    """ROUND(100.0 * numer / denom, digits) in double; NULL when denom is 0 or NULL."""
    d = col(denom).cast("double")
    v = F.when(d != 0, F.lit(100.0) * col(numer).cast("double") / d)
    return F.round(v, digits) if digits is not None else v


def to_double(c) -> Column:
    return col(c).cast("double")


def and_all(preds) -> Column:
    """Fold a list of predicates with AND (P12); TRUE when the list is empty."""
    preds = [p for p in preds if p is not None]
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)
