"""Numeric helpers shared by every view and query.

The reference rounds NUMERIC values half away from zero. Rounding a double
directly differs between engines (1.005 is 1.00499.. in binary), so every
rounded output goes through a DECIMAL(38,12) step first, which absorbs the
binary noise and then rounds half away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DEC = "decimal(38,12)"


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def pg_round(x, digits: int = 0) -> Column:
    """ROUND(x::numeric, digits) as a double (half away from zero)."""
    return F.round(_c(x).cast("double").cast(_DEC), digits).cast("double")


def safe_div(num, den) -> Column:
    """num / NULLIF(den, 0) in double precision (never raises under ANSI)."""
    return _c(num).cast("double") / F.nullif(_c(den), F.lit(0))


def pct(num, den, digits: int = 2) -> Column:
    """ROUND(100.0 * num / NULLIF(den, 0), digits)."""
    return pg_round(F.lit(100.0) * _c(num).cast("double") / F.nullif(_c(den), F.lit(0)), digits)


def ratio(num, den, digits: int = 2, scale: float = 1.0) -> Column:
    """ROUND(num / NULLIF(den, 0) * scale, digits)."""
    return pg_round(safe_div(num, den) * F.lit(float(scale)), digits)


def sum_long(x) -> Column:
    return F.sum(_c(x)).cast("long")


def sum_money(x) -> Column:
    """Exact decimal sum of a money column, returned as double."""
    return F.sum(_c(x)).cast("double")


def count_if(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END)."""
    return F.count(F.when(cond, F.lit(1)))


def sum_if(cond: Column, value, otherwise=0) -> Column:
    """SUM(CASE WHEN cond THEN value ELSE otherwise END); ``otherwise=None`` keeps NULL."""
    w = F.when(cond, _c(value))
    if otherwise is not None:
        w = w.otherwise(F.lit(otherwise))
    return F.sum(w).cast("long")


def py_round(x, digits: int = 0) -> Column:
    """pandas / Python ``round``: half to even, on the shortest decimal text of the value."""
    return F.bround(_c(x).cast("double").cast(_DEC), digits).cast("double")
