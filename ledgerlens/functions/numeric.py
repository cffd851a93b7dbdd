"""Exact numeric expressions.

Ratios are computed in integer arithmetic and rounded half away from zero at
the requested scale, so the value does not depend on floating-point order or
on an engine's intermediate decimal scale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def int_div(a, b) -> Column:
    """Integer division truncating toward zero (SQL ``div``), never ``floor``."""
    b = F.lit(b) if isinstance(b, int) else _c(b)
    return F.call_function("div", _c(a), b)


def ratio(num, den, scale: int = 2, mult: int = 1, precision: int = 18) -> Column:
    """``num * mult / den`` rounded half away from zero to ``scale`` digits.

    ``num`` and ``den`` must be integral. A zero or NULL denominator yields
    NULL instead of failing (the lift and click rates can divide by zero).
    """
    whole = "decimal(38,0)"
    n, d = _c(num).cast(whole), _c(den).cast(whole)
    top = (F.abs(n) * F.lit(2 * mult * 10 ** scale).cast(whole) + F.abs(d)).cast(whole)
    bottom = (F.abs(d) * F.lit(2)).cast(whole)
    # ``div`` would return a bigint and wrap; this quotient is exact and stays decimal.
    q = ((top - top % bottom) / bottom).cast(whole)
    signed = F.when(F.signum(n) * F.signum(d) < 0, -q).otherwise(q)
    value = signed.cast(whole) / F.lit(10 ** scale)
    return F.when(d != 0, value.cast(f"decimal({precision},{scale})"))


def truncated_avg(col) -> Column:
    """AVG over an integer column returning the truncated integer."""
    return int_div(F.sum(_c(col)).cast("bigint"), F.count(_c(col))).cast("int")
