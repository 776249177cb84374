"""Column-level helpers: dates, dirty text and exact rounding.

All of them return native Spark Column expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from mercato.functions.dates import (
    day_name_of,
    month_name_of,
    minute_boundaries,
    parse_dmy,
    shift_years,
    tsql_week,
)
from mercato.functions.exact import exact_avg, exact_sum
from mercato.functions.numeric import round_ratio
from mercato.functions.text import dollars, leading_number, money_text, null_text

__all__ = [
    "day_name_of", "month_name_of", "minute_boundaries", "parse_dmy", "shift_years",
    "tsql_week", "exact_avg", "exact_sum", "round_ratio", "dollars", "leading_number", "money_text", "null_text",
]
