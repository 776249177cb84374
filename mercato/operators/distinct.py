"""Distinct counts that roll up: exact bitmaps written once, merged for any level.

``count(DISTINCT id)`` of a region and of a year do not add up to that of both,
so every level scans the facts again. A bitmap does merge: for each group and
each range of 32,768 ids one bit an id (4 KB). The table of bitmaps has a row
for each group and range that occurs, whatever the number of facts, and answers
every coarser level by ``or``. Ids are integers; where they are sparse, number
them first (``ordered.with_ranks(..., dense=...)``), as a range of one id costs
as much as a full one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, ids: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row for each group of ``by``, id column (``measure``) and range of ids
    (``bucket``) with the ``bitmap`` of the ids found. NULL ids have no bit; a
    group without ids keeps a row without a bitmap."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("bigint").alias("id")) for c in ids]))
    rows = df.select(*by, each.alias("m")).select(*by, "m.*").distinct()
    return rows.groupBy(*by, "measure", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.when(F.count("id") > 0, F.bitmap_construct_agg(F.bitmap_bit_position("id"))).alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, measures: dict[str, str], levels: Sequence[Sequence[str]]) -> DataFrame:
    """Distinct ids of each level (a subset of the bitmaps' grouping columns;
    empty: all rows), one column a measure ({id column: name}). Columns that a
    level lacks are NULL and counted in ``rolled_up`` (as grouping_id tells them
    from NULL values: the level's number in ``levels``)."""
    columns = list(dict.fromkeys(c for level in levels for c in level))
    out = []
    for number, level in enumerate(levels):
        merged = bitmaps.groupBy(*level, "measure", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bits"))
        counts = merged.groupBy(*level).agg(*[
            F.coalesce(F.sum(F.when(F.col("measure") == c, F.bitmap_count("bits"))), F.lit(0)).alias(name) for c, name in measures.items()])
        here = [F.col(c) if c in level else F.lit(None).cast(bitmaps.schema[c].dataType).alias(c) for c in columns]
        out.append(counts.select(*here, F.lit(number).alias("level"), *measures.values()))
    return reduce(DataFrame.unionByName, out)
