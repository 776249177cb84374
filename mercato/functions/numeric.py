"""Exact rounding of ratios and integer division.

``round(a / b, d)`` on doubles can round a tie the wrong way (1.005 is stored
as 1.00499...). Both sides count with four decimals, and the result is computed
exactly with integral division (``div``) on decimal(38, 0) values, rounding
half away from zero, which is what NUMERIC rounding and a cast to
decimal(p, d) do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def int_div(num, den) -> Column:
    """Integer division truncating toward zero (``a div b``), as bigint."""
    return F.call_function("div", _c(num), _c(den))


PLACES = 4


def _units(col) -> Column:
    """A value in units of 10 ** -PLACES, as a whole decimal."""
    return (_c(col).cast(f"decimal(34,{PLACES})") * (10 ** PLACES)).cast("decimal(38,0)")


def round_ratio(num, den, digits: int = 2) -> Column:
    """``round(num / den, digits)`` as a double; both sides count with up to
    ``PLACES`` decimals.

    NULL when either side is NULL or ``den`` is 0.
    """
    scale = 10 ** digits
    n = _units(num)
    d = F.nullif(_units(den), F.lit(0).cast("decimal(38,0)"))
    sign = (F.signum(n) * F.signum(d)).cast("bigint")  # signum is a double
    whole = int_div(F.abs(n) * (2 * scale) + F.abs(d), F.abs(d) * 2)
    # shift the decimal point in decimal arithmetic (exact), then convert once,
    # so the double is the one nearest to the exact decimal at any magnitude
    shifted = (sign * whole).cast("decimal(38,0)") / F.lit(scale).cast("decimal(38,0)")
    return shifted.cast("double")
