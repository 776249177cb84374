"""Window functions and percentiles over groups of any size.

A window puts a whole group in one task. Here the rows lie in *cells* instead:
ranges of (group, order values) between bounds taken from a small sample, so a
group of any share of the rows is cut into many cells, and small groups share
one. What a row needs from the cells before its own is one number (or the last
few values), and only groups that a bound cuts need any; a group without a bound
lies in one cell. So every function here is

* counts or sums by (group, cell) of the cut groups, partially aggregated: the
  offsets. They are at most three times the number of bounds, hence broadcast;
* the plain window within (group, cell), over the one exchange of the rows;
* local value + offset.

A bound's own value is a cell by itself. Its rows all tie, so they may be dealt
over many tasks: a value that a third of the rows share makes no hot task
either. Rows of equal order values always share a cell: ties need no care at
the borders.

The bounds only decide how even the cells are, never a result. They are literal
values, the same in every pass and in every retried task. NULL keys are one
group and NULL order values sort as the largest, as in the case study's SQL.
Helper columns are named ``__…``; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from mercato.sources.catalog import written

SAMPLE_PER_CELL = 40       # sampled rows a bound; the sample is that times the bounds
MAX_CELLS = 2048           # bounds, at most: the driver holds 40 sampled rows for each
SELECT_ROWS = 2_000_000    # rows of a cell that a rank is picked from by a sort


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal columns where NULL equals NULL, as groups do; the columns of ``left`` stay."""
    renamed = right.select(*[F.col(c).alias(f"__on_{c}") if c in on else F.col(c) for c in right.columns])
    joined = left.join(renamed, _all(F.col(c).eqNullSafe(F.col(f"__on_{c}")) for c in on), how)
    return joined.drop(*[f"__on_{c}" for c in on])


class Cells:
    """Ordered cells of the rows of ``df`` by (keys, order), about ``n`` of equal size."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int | None = None):
        self.spark, self.keys, self.order = df.sparkSession, list(keys), list(order)
        n = min(n or int(self.spark.conf.get("spark.sql.shuffle.partitions")), MAX_CELLS)
        place = self._place(df).alias("b")
        rows = df.select(place)
        found = []
        total = rows.count() if n > 1 else 0
        if total:
            share = min(1.0, n * SAMPLE_PER_CELL / total)
            sample = rows if share == 1.0 else rows.sample(share, seed=7)
            picked = sample.sort("b").collect()
            # Evenly spaced places; a value that many rows share is one bound.
            found = [picked[i * len(picked) // n].b for i in range(1, n)] if picked else []
        self.bounds = [b for i, b in enumerate(found) if not i or b != found[i - 1]]
        self.type = rows.schema["b"].dataType
        groups = [b[:len(self.keys)] for b in self.bounds]
        #: No group holds two bounds: none has more rows than about two cells, and the plain window makes no hot task.
        self.even = bool(self.keys) and all(a != b for a, b in zip(groups, groups[1:])) or not self.bounds

    def _place(self, df: DataFrame) -> Column:
        """The struct that orders the rows: keys, then the order columns, NULL as the largest."""
        fields = [F.col(k).alias(f"k{i}") for i, k in enumerate(self.keys)]
        for i, c in enumerate(self.order):
            fields += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"o{i}")]
        return F.struct(*fields)

    def of(self, df: DataFrame) -> DataFrame:
        """``df`` with its cell in ``__cell``: 2 i + 1 for rows equal to bound i, 2 i for those below it."""
        n = len(self.bounds)
        if not n:
            return df.withColumn("__cell", F.lit(0))
        schema = StructType([StructField("__bounds", ArrayType(self.type))])
        literal = self.spark.createDataFrame([(self.bounds,)], schema)          # one row
        d = df.crossJoin(F.broadcast(literal)).withColumn("__place", self._place(df))
        steps = [1 << i for i in reversed(range(n.bit_length()))]
        # Binary search for the number of bounds below the row's place.
        below = F.aggregate(
            F.array(*[F.lit(s) for s in steps]), F.lit(0),
            lambda low, s: F.when((low + s <= n) & (F.get("__bounds", low + s - 1) < F.col("__place")), low + s).otherwise(low))
        d = d.withColumn("__below", below)
        at_bound = F.coalesce(F.get("__bounds", F.col("__below")) == F.col("__place"), F.lit(False))
        return d.withColumn("__cell", 2 * F.col("__below") + at_bound.cast("int")).drop("__bounds", "__place", "__below")

    def of_cut_groups(self, celled: DataFrame) -> DataFrame:
        """The rows of groups that lie in more than one cell: a bound's group."""
        if not self.keys:
            return celled
        if not self.bounds:
            return celled.limit(0)
        types = StructType([celled.schema[k] for k in self.keys])
        cut = self.spark.createDataFrame([b[:len(self.keys)] for b in self.bounds], types).distinct()
        return join_null_safe(celled, F.broadcast(cut), self.keys, "left_semi")   # at most a row for each bound

    def window(self, descending: bool = False, spread: bool = False) -> "Window":
        """The window within (group, cell). ``spread``: rows equal to a bound are
        dealt over many tasks, for functions that give all of them the same value."""
        spread_by = [F.col("__deal")] if spread else []
        return Window.partitionBy(*self.keys, "__cell", *spread_by).orderBy(*self.sorting(descending))

    def plain_window(self, descending: bool = False) -> "Window":
        return Window.partitionBy(*self.keys).orderBy(*self.sorting(descending))

    def sorting(self, descending: bool = False) -> list[Column]:
        return [F.col(c).desc_nulls_first() if descending else F.col(c).asc_nulls_last() for c in self.order]

    def deal(self, celled: DataFrame) -> DataFrame:
        """Adds ``__deal``, by which rows equal to a bound spread over tasks."""
        any_task = F.pmod(F.monotonically_increasing_id(), F.lit(len(self.bounds) + 1)).cast("int")
        return celled.withColumn("__deal", F.when(F.col("__cell") % 2 == 1, any_task).otherwise(0))

    def before(self, descending: bool = False) -> "Window":
        """All earlier cells of a group, over rows of (group, cell)."""
        c = F.col("__cell")
        return Window.partitionBy(*self.keys).orderBy(c.desc() if descending else c.asc()).rowsBetween(Window.unboundedPreceding, -1)

    def attach(self, celled: DataFrame, offsets: DataFrame) -> DataFrame:
        """Offsets by (group, cell) joined to the rows; bounded, hence broadcast."""
        return join_null_safe(celled, F.broadcast(offsets), [*self.keys, "__cell"])


def with_ranks(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), rank: str | None = "rank",
               dense: str | None = None, descending: bool = False, cells: int | None = None) -> DataFrame:
    """Adds ``rank()`` and / or ``dense_rank() over (partition by keys order by
    order)`` as bigint columns of the given names."""
    at = Cells(df, keys, order, cells)
    if at.even:
        w = at.plain_window(descending)
        made = [(rank, F.rank()), (dense, F.dense_rank())]
        return df.select("*", *[f.over(w).cast("bigint").alias(name) for name, f in made if name])
    celled = at.of(df)
    cut = at.of_cut_groups(celled)
    if dense:                                             # values of each cell first: they are counted once
        values = cut.groupBy(*at.keys, "__cell", *at.order).agg(F.count(F.lit(1)).alias("__n"))
        sums = values.groupBy(*at.keys, "__cell").agg(F.sum("__n").alias("__n"), F.count(F.lit(1)).alias("__d"))
    else:
        sums = cut.groupBy(*at.keys, "__cell").agg(F.count(F.lit(1)).alias("__n"), F.lit(0).alias("__d"))
    before = at.before(descending)
    offsets = sums.select(*at.keys, "__cell", F.sum("__n").over(before).alias("__rows"), F.sum("__d").over(before).alias("__values"))
    w = at.window(descending, spread=True)
    out = at.deal(celled)
    for name, local in ((rank, F.rank()), (dense, F.dense_rank())):
        if name:
            out = out.withColumn(name, local.over(w).cast("bigint"))
    out = at.attach(out, offsets)
    for name, offset in ((rank, "__rows"), (dense, "__values")):
        if name:
            out = out.withColumn(name, F.col(name) + F.coalesce(F.col(offset), F.lit(0)))
    return out.select(*df.columns, *[n for n in (rank, dense) if n])


def with_running_sum(df: DataFrame, value: str, order: Sequence[str], keys: Sequence[str] = (), name: str = "running",
                     rows: bool = False, cells: int | None = None) -> DataFrame:
    """Adds ``sum(value) over (partition by keys order by order)``: rows that tie
    in ``order`` have the sum through the last of them (RANGE, the SQL default).

    ``rows=True`` sums row by row (ROWS); ``order`` must then tell rows apart.
    NULL values are passed over; the sum is NULL before the first value. Sums of
    doubles depend on the cells in their last digits: use integers or decimals.
    """
    at = Cells(df, keys, order, cells)
    if at.even:
        w = at.plain_window()
        return df.withColumn(name, F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow) if rows else w))
    celled = at.of(df)
    sums = at.of_cut_groups(celled).groupBy(*at.keys, "__cell").agg(F.sum(value).alias("__sum"))
    offsets = sums.select(*at.keys, "__cell", F.sum("__sum").over(at.before()).alias("__before"), F.col("__sum").alias("__whole"))
    if rows:
        local = F.sum(value).over(at.window().rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out = at.attach(celled.withColumn("__local", local), offsets)
        own = F.col("__local")
    else:
        out = at.attach(at.deal(celled).withColumn("__local", F.sum(value).over(at.window(spread=True))), offsets)
        # Rows equal to a bound tie: each has the whole of its cell.
        own = F.when(F.col("__cell") % 2 == 1, F.col("__whole")).otherwise(F.col("__local"))
    kind = sums.schema["__sum"].dataType
    total = F.when(own.isNotNull() | F.col("__before").isNotNull(),
                   (F.coalesce(own, F.lit(0)) + F.coalesce(F.col("__before"), F.lit(0))).cast(kind))
    return out.withColumn(name, total).select(*df.columns, name)


def with_neighbours(df: DataFrame, value: str, order: Sequence[str], columns: dict[str, int | tuple[int, object]],
                    keys: Sequence[str] = (), cells: int | None = None) -> DataFrame:
    """Adds ``lag(value, offset, default) over (partition by keys order by
    order)`` for each of ``columns`` ({name: offset} or {name: (offset,
    default)}); a negative offset leads. ``order`` must tell a group's rows apart.

    All columns share the exchange of the rows. The first (last) rows of a cell
    take their value from the last (first) rows of the cells around it, of which
    no more than the largest offset leave a cell."""
    asked = {name: x if isinstance(x, tuple) else (x, None) for name, x in columns.items()}
    if not all(offset for offset, _ in asked.values()):
        raise ValueError("an offset counts rows back, or on if negative; it is not 0")
    kind = df.schema[value].dataType
    at = Cells(df, keys, order, cells)
    if at.even:
        w = at.plain_window()
        return df.select("*", *[F.lag(value, offset, default).over(w).cast(kind).alias(name) for name, (offset, default) in asked.items()])
    celled = at.of(df)
    cut, w = at.of_cut_groups(celled), at.window()
    cell_keys = [*at.keys, "__cell"]
    around = cut.groupBy(*cell_keys).agg(F.count(F.lit(1)).alias("__size"))
    for side, back in (("__before", True), ("__after", False)):
        most = max([offset if back else -offset for offset, _ in asked.values()])
        if most > 0:
            # The rows nearest to the border, the nearest first: a limit by group, applied before the exchange too.
            from_border = F.row_number().over(at.window(back))
            ends = cut.withColumn("__at", from_border).filter(F.col("__at") <= most)
            pair = F.struct("__at", F.col(value).alias("__value"))
            tails = ends.groupBy(*cell_keys).agg(F.sort_array(F.collect_list(pair)).alias("__tail"))
            # Each of the cells around holds a row or more, so the nearest `most` of them will do.
            c = F.col("__cell")
            near = Window.partitionBy(*at.keys).orderBy(c.asc() if back else c.desc()).rowsBetween(-most, -1)
            carried = F.slice(F.flatten(F.reverse(F.collect_list("__tail").over(near))), 1, most)
            around = join_null_safe(around, tails.select(*cell_keys, carried.alias(side)), cell_keys)
    local = {f"__local{i}": F.lag(value, offset).over(w) for i, (offset, _) in enumerate(asked.values())}
    # Whether a leading row is in the cell: what a group of one cell goes by, as it has no size here.
    there = {f"__there{i}": F.coalesce(F.lead(F.lit(True), -offset).over(w), F.lit(False))
             for i, (offset, _) in enumerate(asked.values()) if offset < 0}
    windows = {"__row": F.row_number().over(w), **local, **there}
    out = at.attach(celled.select("*", *[c.alias(n) for n, c in windows.items()]), around)
    made = []
    for i, (name, (offset, default)) in enumerate(asked.items()):
        far = abs(offset)
        place = F.col("__row") if offset > 0 else F.col("__size") - F.col("__row") + 1       # from that border, 1 is next to it
        held, index = ("__before" if offset > 0 else "__after"), (F.lit(far) - place).cast("int")
        outside = F.when(F.coalesce(F.size(held), F.lit(0)) > index, F.get(held, index)["__value"]).otherwise(F.lit(default).cast(kind))
        inside = F.col("__row") > far if offset > 0 else F.col(f"__there{i}")
        made.append(F.when(inside, F.col(f"__local{i}")).otherwise(outside).alias(name))
    return out.select(*df.columns, *made)


def with_lag(df: DataFrame, value: str, order: Sequence[str], keys: Sequence[str] = (), name: str = "previous",
             offset: int = 1, default=None, cells: int | None = None) -> DataFrame:
    """Adds ``lag(value, offset, default)``; see ``with_neighbours``."""
    if offset < 1:
        raise ValueError("offset counts rows and begins at 1")
    return with_neighbours(df, value, order, {name: (offset, default)}, keys, cells)


def with_lead(df: DataFrame, value: str, order: Sequence[str], keys: Sequence[str] = (), name: str = "next",
              offset: int = 1, default=None, cells: int | None = None) -> DataFrame:
    """As ``with_lag``, from the rows behind."""
    if offset < 1:
        raise ValueError("offset counts rows and begins at 1")
    return with_neighbours(df, value, order, {name: (-offset, default)}, keys, cells)


def select_ranks(df: DataFrame, value: str, wanted: DataFrame, keys: Sequence[str] = (),
                 cells: int | None = None, limit: int = SELECT_ROWS) -> DataFrame:
    """The values at given places of each group: ``wanted`` has the keys and
    ``rank`` (0 is the smallest value); adds ``value``. ``value`` has no NULLs.

    A histogram by cell tells which cell holds a rank. A cell of one value
    answers at once; of the others only their rows are sorted. Where such a cell
    has more than ``limit`` rows it is cut into cells itself."""
    keys = list(keys)
    at = Cells(df, keys, [value], cells)
    celled = at.of(df)
    histogram = celled.groupBy(*keys, "__cell").agg(
        F.count(F.lit(1)).alias("__n"), F.min(value).alias("__least"), F.max(value).alias("__most"))
    histogram = histogram.withColumn("__start", F.coalesce(F.sum("__n").over(at.before()), F.lit(0)))
    spot = join_null_safe(wanted, histogram, keys, "inner") if keys else wanted.crossJoin(F.broadcast(histogram))  # a row a cell
    spot = written(spot.filter((F.col("rank") >= F.col("__start")) & (F.col("rank") < F.col("__start") + F.col("__n"))), "rank-cells")
    known = spot.filter(F.col("__least") == F.col("__most")).select(*keys, "rank", F.col("__least").alias("value"))
    open_ = spot.filter(F.col("__least") != F.col("__most"))
    largest = open_.agg(F.max("__n")).first()[0]
    if largest is None:
        return known
    cell_keys = [*keys, "__cell"]
    places = open_.select(*cell_keys, F.col("rank").alias("__rank"), (F.col("rank") - F.col("__start")).alias("rank"))
    rows = join_null_safe(celled.select(*cell_keys, value), places.select(*cell_keys).distinct(), cell_keys, "left_semi")
    deeper = f"__cell{sum(k.startswith('__cell') for k in keys)}"
    rows, places = rows.withColumnRenamed("__cell", deeper), places.withColumnRenamed("__cell", deeper)
    inner = [*keys, deeper]
    if largest > limit and len(at.bounds):
        # Both are small beside df; written, so that plans do not grow with the rounds.
        rows, places = written(rows, "cell-rows"), written(places, "cell-ranks")
        found = written(select_ranks(rows, value, places.select(*inner, "rank").distinct(), inner, cells, limit), "ranks")
    else:
        nth = F.row_number().over(Window.partitionBy(*inner).orderBy(value)).cast("bigint") - 1
        found = rows.select(*inner, F.col(value).alias("value"), nth.alias("rank"))
    picked = join_null_safe(places, found.select(*inner, "rank", "value"), [*inner, "rank"], "inner")
    return known.unionByName(picked.select(*keys, F.col("__rank").alias("rank"), "value"))


def percentiles(df: DataFrame, value: str, ps: Sequence[float], names: Sequence[str], keys: Sequence[str] = (),
                cells: int | None = None, limit: int = SELECT_ROWS) -> DataFrame:
    """Exact interpolated percentiles (``percentile_cont``) as doubles, one row a
    group; NULL values are passed over, a group without others has NULLs.

    No state grows with the number of distinct values: ranks are selected by
    ``select_ranks``, then each percentile lies between its two neighbours."""
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("__v"))
    sizes = rows.groupBy(*keys).agg(F.count("__v").alias("__size"))
    place = F.col("__p") * (F.col("__size") - 1)
    each = F.explode(F.array(*[F.lit(float(p)) for p in dict.fromkeys(ps)])).alias("__p")
    asked = sizes.filter("__size > 0").select(*keys, "__size", each)
    asked = asked.select(*keys, "__p", F.floor(place).alias("__low"), (place - F.floor(place)).alias("__part"))
    pairs = asked.select(*keys, "__p", "__part", F.explode(F.array(F.col("__low"), F.ceil(F.col("__low") + F.col("__part")))).alias("rank"))
    found = select_ranks(rows.filter("__v is not null"), "__v", pairs.select(*keys, "rank").distinct(), keys, cells, limit)
    near = join_null_safe(pairs.distinct(), found, [*keys, "rank"], "inner")
    # Both neighbours are NaN-free sums of two products only where they differ.
    low, high, part = F.min("value"), F.max("value"), F.max("__part")
    between = F.when(low == high, low).otherwise(low * (1 - part) + high * part)
    values = near.groupBy(*keys, "__p").agg(between.alias("__value"))
    wide = values.groupBy(*keys).agg(*[F.max(F.when(F.col("__p") == float(p), F.col("__value"))).alias(n) for p, n in zip(ps, names)])
    return (join_null_safe(sizes, wide, keys) if keys else sizes.crossJoin(F.broadcast(wide))).select(*keys, *names)
