"""Date and time expressions whose meaning differs between SQL dialects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mercato.functions.numeric import int_div


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def shift_years(col, years: int) -> Column:
    """Date of ``col`` moved by whole years (Feb 29 falls back to Feb 28)."""
    return F.add_months(F.to_date(_c(col)), 12 * years)


def parse_dmy(col) -> Column:
    """Text ``d/M/yy`` (single or double digits, two-digit year in 20xx) to date.

    ``dd/mm/yy`` would read ``mm`` as minutes and reject one-digit days.
    """
    return F.to_date(_c(col), "d/M/yy")


def tsql_week(col) -> Column:
    """Week number where week 1 holds January 1 and weeks start on Sunday."""
    d = F.to_date(_c(col))
    jan1_weekday = F.dayofweek(F.trunc(d, "YEAR"))  # Sunday = 1
    return int_div((F.dayofyear(d) + jan1_weekday - 2).cast("bigint"), F.lit(7)) + 1


# Fixed origin day for counting whole minutes.
_MINUTE_ORIGIN = "1970-01-01"


def _minutes_since_origin(col) -> Column:
    """Whole minutes from the origin to a wall-clock time, from its date,
    hour and minute: date arithmetic and field extraction on timestamp_ntz
    involve no time zone, so no DST change can shift the count."""
    ts = _c(col).cast("timestamp_ntz")
    days = F.datediff(F.to_date(ts), F.lit(_MINUTE_ORIGIN).cast("date")).cast("bigint")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def minute_boundaries(start, end) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end``.

    18:05:59 -> 18:15:01 gives 10 (a plain elapsed-minutes difference gives 9).
    Computed on wall-clock (timestamp_ntz) values as the difference of whole
    minutes since a fixed origin day, so no session time zone or DST shift
    enters.
    """
    return _minutes_since_origin(end) - _minutes_since_origin(start)


# Fixed reference days for naming numbers: 2023-01-01 was a Sunday.
_SUNDAY = "2023-01-01"


def day_name_of(dow, case: str = "title") -> Column:
    """Name of a ``dayofweek`` number (1 = Sunday ... 7 = Saturday).

    Grouping on the number and naming the few result rows afterwards avoids
    formatting a name for every input row."""
    return _case(F.date_format(F.date_add(F.lit(_SUNDAY).cast("date"), _c(dow) - 1), "EEEE"), case)


def month_name_of(month, case: str = "title") -> Column:
    """Name of a month number (1 = January)."""
    return _case(F.date_format(F.make_date(F.lit(2000), _c(month), F.lit(1)), "MMMM"), case)


def _case(c: Column, case: str) -> Column:
    if case == "upper":
        return F.upper(c)
    if case == "lower":
        return F.lower(c)
    return c
