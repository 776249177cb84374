"""Ranking, top-per-group and ordering building blocks that stay skew-safe.

A single key may hold a third of all rows. Windows partitioned by such a key
put the whole group in one task, so these helpers use aggregation (partial,
map-side combined) plus an equi-join back instead, and keep windows for inputs
whose group size is bounded (already aggregated, or distinct calendar days).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def ties_at_max(df: DataFrame, keys: Sequence[str] | str | None, value: str,
                highest: bool = True) -> DataFrame:
    """Rows whose ``value`` equals the max (or min) of their group; ties kept.

    Same rows as ``rank() over (partition by keys order by value desc) = 1``.
    The group extreme is a partial aggregate; with no keys it is one row,
    joined as a broadcast (its size is one row by construction).
    """
    keys = _cols(keys)
    agg = F.max(value) if highest else F.min(value)
    ext = "__ext"
    if not keys:
        top = df.agg(agg.alias(ext))
        return df.join(F.broadcast(top), F.col(value) == F.col(ext)).drop(ext)
    top = df.groupBy(*keys).agg(agg.alias(ext))
    return _join_back(df, top, keys).filter(F.col(value) == F.col(ext)).drop(ext)


def _join_back(df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join per-key results back on ``keys`` with null-safe equality, so a
    NULL key is one group, as in a window partition."""
    renamed = per_key.select(*[F.col(k).alias(f"__key_{k}") for k in keys],
                             *[c for c in per_key.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__key_{k}"))
        cond = c if cond is None else cond & c
    return df.join(renamed, cond, how).drop(*[f"__key_{k}" for k in keys])


def first_by(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str],
             carry: Sequence[str] = (), last: bool = False) -> DataFrame:
    """One row per key: the smallest (or largest) by ``order`` columns.

    Equivalent to ``row_number() over (partition by keys order by order) = 1``
    with ``order`` a total tie-break, computed as ``min(struct(order, carry))``
    so the work is a partial aggregate rather than a sort of each whole group.
    """
    keys = _cols(keys)
    # NULLs order last, as ascending ORDER BY does in the case study's SQL;
    # the flag fields are dropped from the output below.
    flags = [F.col(c).isNull().alias(f"__null_{i}") for i, c in enumerate(order)]
    fields = [f for pair in zip(flags, [F.col(c) for c in order]) for f in pair]
    packed = F.struct(*fields, *[F.col(c) for c in carry])
    agg = F.max(packed) if last else F.min(packed)
    return df.groupBy(*keys).agg(agg.alias("__f")).select(
        *keys, *[F.col(f"__f.{c}") for c in [*order, *carry]])


def rank_distinct(df: DataFrame, keys: Sequence[str] | str, order: str, name: str,
                  descending: bool = False) -> DataFrame:
    """Distinct (keys, order) pairs numbered 1, 2, ... within each key."""
    keys = _cols(keys)
    distinct = df.select(*keys, order).distinct()
    o = F.col(order).desc_nulls_first() if descending else F.col(order).asc_nulls_last()
    return distinct.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(o)))


def next_time(df: DataFrame, key: str, t: str, tie: str, name: str) -> DataFrame:
    """Add ``lead(t) over (partition by key order by t, tie)`` as ``name``.

    Only the next time is wanted, so the window runs over the distinct
    (key, t) pairs, of which a key has as many as the calendar has times,
    whatever its number of rows. A row whose ``tie`` is not the largest of its
    time is followed by another row of the same time. (key, t, tie) must be
    unique and ``t`` and ``tie`` not NULL.
    """
    times = df.groupBy(key, t).agg(F.max(tie).alias("__last"))
    times = times.withColumn("__next", F.lead(t).over(Window.partitionBy(key).orderBy(t)))
    j = _join_back(df, times, [key, t])
    return j.withColumn(name, F.when(F.col(tie) < F.col("__last"), F.col(t)).otherwise(F.col("__next"))).select(*df.columns, name)
