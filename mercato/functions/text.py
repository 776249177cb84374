"""Dirty-text helpers: the four kinds of "missing" and numbers inside text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_text(col, to: str | None = "", sql_null_too: bool = False) -> Column:
    """Replace the text ``'null'`` (and, if asked, SQL NULL) by ``to``."""
    c = _c(col)
    cond = c == "null"
    if sql_null_too:
        cond = c.isNull() | cond
    return F.when(cond, F.lit(to)).otherwise(c)


def leading_number(col, integral: bool = False) -> Column:
    """The number at the start of a text such as ``'20km'``, ``'32 mins'``,
    ``'-5km'``, ``'.5km'`` or ``'1,200km'``.

    What follows the number (a unit, blanks) is dropped whatever its spelling.
    Any other text, such as ``'null'``, ``''`` or ``'1,2km'``, gives NULL
    instead of a wrong number. ``integral`` cuts the decimals off.
    """
    number = r"(?:(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?|\.\d+)"
    txt = F.replace(F.regexp_extract(_c(col), rf"^\s*([+-]?{number})(?![\d.,])", 1), F.lit(","), F.lit(""))
    return txt.try_cast("decimal(38,10)").try_cast("bigint") if integral else txt.try_cast("double")


def money_text(col, prefix: str = "$ ") -> Column:
    """Whole amount with thousands separators, e.g. ``$ 1,358,148``."""
    return F.concat(F.lit(prefix), F.format_number(_c(col), 0))


def dollars(col, digits: int | None = None) -> Column:
    """``'$'`` followed by the value; with ``digits`` it is rounded first."""
    return F.concat(F.lit("$"), _c(col).cast("string") if digits is None else rounded_text(col, digits))


def rounded_text(col, digits: int = 2) -> Column:
    """The value rounded to ``digits`` decimals as text, without trailing zeros
    or exponent, as a database prints a rounded float."""
    text = F.round(_c(col), digits).cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(text, r"\.?0+$", "")
