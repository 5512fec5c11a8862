"""Column-expression helpers (all JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """``a / b`` with null on a zero or null divisor, also under ANSI mode."""
    return F.try_divide(col_(a), col_(b))


def ratio_or_zero(a, b) -> Column:
    return F.coalesce(safe_div(a, b), F.lit(0.0))


def fractional_days(end, start) -> Column:
    """``JULIANDAY(end) - JULIANDAY(start)``: elapsed days with fraction."""
    return F.timestamp_diff("MICROSECOND", col_(start), col_(end)) / F.lit(86400e6)


def day_of(ts) -> Column:
    return F.to_date(col_(ts))


def month_floor(ts) -> Column:
    return F.trunc(F.to_date(col_(ts)), "MM")


def year_month(ts) -> Column:
    return F.date_format(col_(ts), "yyyy-MM")


def month_index(d, origin) -> Column:
    """Month difference + 1 (``y*12+m+1`` of the cohort query)."""
    d, origin = col_(d), col_(origin)
    return (F.year(d) - F.year(origin)) * 12 + (F.month(d) - F.month(origin)) + 1


def date_lit(d: _dt.date | str) -> Column:
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def dates_array(ds: Iterable) -> Column:
    return F.array(*[date_lit(d) for d in ds])


def ts_of(d) -> Column:
    return col_(d).cast("timestamp_ntz")


def in_range(ts, start, end) -> Column:
    """Half-open ``start <= ts < end``."""
    ts = col_(ts)
    return (ts >= ts_of(start)) & (ts < ts_of(end))


def sigmoid(features: Sequence[str], coefs: Sequence[float], intercept: float = 0.0) -> Column:
    """Logistic function of a linear score written as a column expression."""
    z = F.lit(float(intercept))
    for f, c in zip(features, coefs):
        z = z + F.col(f) * F.lit(float(c))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def money(c) -> Column:
    return F.concat(F.lit("$"), F.format_number(col_(c), 2))


def tier(c, table: Sequence[tuple[float, float]], default: float) -> Column:
    """Value of the first (floor, value) row with ``c >= floor`` (descending floors)."""
    x = col_(c)
    expr = None
    for floor, value in sorted(table, key=lambda t: -t[0]):
        expr = F.when(x >= F.lit(floor), F.lit(value)) if expr is None else expr.when(x >= F.lit(floor), F.lit(value))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def stable_hash_bucket(cols: Sequence, seed: int, modulus: int = 100) -> Column:
    """Partitioning-independent pseudo-random bucket of a key: the first 32 bits of the MD5 of
    ``seed:col:col..`` as text (nulls are left out), so other engines find the same rows."""
    text = F.concat_ws(":", F.lit(str(int(seed))), *[col_(c).cast("string") for c in cols])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(modulus))
