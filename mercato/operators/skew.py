"""Joins whose left side has hot keys.

A hash join sends all rows of a key to one task. ``skew_join`` finds the keys
that hold more than a task's share of the left rows and deals each over as many
salts as it has shares; the right rows of these keys are repeated once a salt.
All other rows keep one salt. It needs no adaptive execution, and keeps inner,
left, semi and anti joins as they are. Two cases are joined plainly: a right side
that the planner broadcasts anyway (its size is checked against
spark.sql.autoBroadcastJoinThreshold), where no key has a task of its own; and a
left side that as a whole is one task's work, by
spark.sql.adaptive.advisoryPartitionSizeInBytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_KEYS = 256            # hot keys kept by the driver; a key below 1 / 256 of the rows is no hot key
TRACKED = 4096             # items of the frequency sketch of each task
HOWS = ("inner", "left", "left_outer", "left_semi", "semi", "left_anti", "anti")


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a plan's result."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _bytes_conf(spark, name: str) -> int:
    text = spark.conf.get(name).strip().lower().removesuffix("b")
    units = {"k": 10, "m": 20, "g": 30}
    return int(text[:-1]) << units[text[-1]] if text[-1:] in units else int(text)


def hot_keys(df: DataFrame, on: Sequence[str], parts: int) -> dict[int, int]:
    """Hashes of the keys that hold more than 1 / parts of the rows, and how many
    such shares each holds. A mergeable sketch of bounded size finds them; its
    counts may be a little high, which costs a salt and no result. Keys with a
    NULL are left out: they match nothing."""
    known = df.select(F.xxhash64(*on).alias("h"), *on).na.drop(subset=list(on))
    top = F.expr(f"approx_top_k(h, {min(MOST_KEYS, 2 * parts)}, {TRACKED})")
    sketch = known.agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {r["item"]: min(parts, -(-r["count"] * parts // sketch["n"])) for r in sketch["top"] or () if r["count"] * parts > sketch["n"]}


def _salts(on: Sequence[str], hot: dict[int, int]) -> Column:
    """Number of salts of a row's key."""
    table = F.create_map(*[F.lit(x).cast(t) for pair in hot.items() for x, t in zip(pair, ("bigint", "int"))])
    return F.coalesce(F.try_element_at(table, F.xxhash64(*on)), F.lit(1))


def skew_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str, how: str = "inner",
              parts: int | None = None) -> DataFrame:
    """``left.join(right, on, how)`` without a hot task. ``parts``: the number of
    shares that the left rows are to be dealt in (default: the session's shuffle partitions)."""
    on = [on] if isinstance(on, str) else list(on)
    if how not in HOWS:
        raise ValueError(f"a salted join is one of {HOWS}")
    spark = left.sparkSession
    if (estimated_bytes(right) <= _bytes_conf(spark, "spark.sql.autoBroadcastJoinThreshold")
            or estimated_bytes(left) <= _bytes_conf(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes")):
        return left.join(right, on, how)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(left, on, parts)
    # Rows with a NULL key match nothing, but a left join keeps them: they are dealt over all tasks.
    unmatched = F.greatest(*[F.col(c).isNull() for c in on]) if len(on) > 1 else F.col(on[0]).isNull()
    salts = F.when(unmatched, parts).otherwise(_salts(on, hot) if hot else F.lit(1))
    dealt = left.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), salts).cast("int"))
    copies = F.sequence(F.lit(0), _salts(on, hot) - 1) if hot else F.array(F.lit(0))
    repeated = right.withColumn("__salt", F.explode(copies))
    return dealt.join(repeated, [*on, "__salt"], how).drop("__salt")
