"""Sums and averages of doubles that do not depend on the order of the rows.

A plain SUM of doubles rounds after every row, so its last digits change with
the partitioning. Here every double is split into signed integers of 30 bits
(limbs) at fixed powers of two, the limbs are summed as whole decimals, which
is exact in any order and merges from partial aggregates, and the exact total
is rounded once, to the nearest double. It is a Column of built-in aggregates:
one state of a fixed size for each group, whatever its rows.

Nulls are passed over; no value at all gives null, as SUM does. If a group
holds NaN or an infinity, the plain sum is given (it has no digits to lose). A
value that needs bits outside [2 ** low, 2 ** high) fails the query rather than
being rounded; the default keeps all bits of magnitudes from 1e-20 to 1e35.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 30
LOW, HIGH = -120, 120

_BASE = 1 << BITS


def _whole(x: Column, bit: int) -> Column:
    """x in units of 2 ** bit, rounded to a whole double; scaling is exact."""
    return F.rint(x * F.lit(2.0 ** -bit))


def _digits(limbs: Column, sign: Column) -> Column:
    """Limb sums times ``sign`` as digits from 0 to 2 ** BITS - 1, lowest first,
    and the carry that is left (below 0 for a negative total)."""
    zero = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

    def add(state: Column, limb: Column) -> Column:
        total = (limb * sign).cast("decimal(38,0)") + state["carry"].cast("decimal(38,0)")
        digit = F.pmod(total, F.lit(_BASE).cast("decimal(38,0)"))
        carry = F.call_function("div", total - digit, F.lit(_BASE).cast("decimal(38,0)"))
        return F.struct(carry.alias("carry"), F.concat(state["digits"], F.array(digit.cast("bigint"))).alias("digits"))

    return F.aggregate(limbs, zero, add)


def _nearest(limbs: Column, n: int, low: int) -> Column:
    """The double nearest to the exact total: its four leading digits (91 bits
    or more) as one whole number, doubled, with a last bit for all below them."""
    sign = F.when(_digits(limbs, F.lit(1))["carry"] < 0, F.lit(-1)).otherwise(F.lit(1))
    digits = _digits(limbs, sign)["digits"]
    indexed = F.transform(digits, lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    top = F.greatest(F.aggregate(indexed, F.lit(0), lambda s, x: F.when(x["d"] > 0, x["i"]).otherwise(s)), F.lit(3))
    lead = F.aggregate(F.slice(F.reverse(digits), F.lit(n) - top, 4), F.lit(0).cast("decimal(38,0)"),
                       lambda s, d: (s * F.lit(_BASE) + d).cast("decimal(38,0)"))
    rest = F.exists(indexed, lambda x: (x["i"] < top - 3) & (x["d"] > 0)).cast("int")
    lead = (lead * F.lit(2) + rest).cast("decimal(38,0)").cast("double")
    return sign * lead * F.pow(F.lit(2.0), (top - 3) * BITS + (low - 1))


def exact_sum(col: str | Column, low: int = LOW, high: int = HIGH) -> Column:
    """The sum of a double column, rounded once: equal for any partitioning."""
    x = (F.col(col) if isinstance(col, str) else col).cast("double")
    if (high - low) % BITS:
        raise ValueError(f"high - low must be a multiple of {BITS}")
    finite = ~(F.isnan(x) | (F.abs(x) == float("inf")))
    fits = (F.abs(x) < 2.0 ** (high - 1)) & (_whole(x, low) * F.lit(2.0 ** low) == x)
    x_ = F.when(finite & fits, x).when(finite, F.raise_error(F.concat(F.lit(f"needs bits outside 2^{low} to 2^{high}: "), x.cast("string"))).cast("double"))
    sums = []
    for bit in range(low, high, BITS):
        limb = _whole(x_, bit) - _whole(x_, bit + BITS) * F.lit(float(_BASE))
        sums.append(F.sum(limb.cast("decimal(18,0)")).cast("decimal(38,0)"))
    # Two more digits take the carries of up to 2 ** 60 rows.
    sums += [F.lit(0).cast("decimal(38,0)")] * 2
    limbs = F.array(*sums)
    special = F.sum(F.when(~finite, x))
    return F.coalesce(special, F.when(F.count(x) > 0, _nearest(limbs, len(sums), low)))


def exact_avg(col: str | Column, low: int = LOW, high: int = HIGH) -> Column:
    """The average of a double column: the exact sum over the count."""
    x = F.col(col) if isinstance(col, str) else col
    return exact_sum(x, low, high) / F.nullif(F.count(x), F.lit(0))
