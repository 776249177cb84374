"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to ``BITS`` bits by its own quantiles over all rows
(strings by their first seven bytes, in order), so that cells hold similar
counts. The cell's index on the Hilbert curve orders the rows; equal indexes
are ordered by doc_id, text hash and size. The order is cut into runs whose
counts differ by one at most (law "rows"): a shard covers a compact region of
the metadata space, and the minimum and maximum of each dimension in its files
let readers skip most of them.

The order is global without a single-task sort: rows of numbers only are range
partitioned, written, and ranked within their partition; the partitions' counts
give the ranks' offsets. Only built-in functions are used. Null metadata and
null texts have a place of their own (below all others, and size 1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import keep

BITS = 4
SHARDS = 8
#: Dimension name -> its value as a number, from the columns of documents.
DIMENSIONS = ("lang", "source", "size", "doc_id")


def _number(name: str, kind: str) -> Column:
    """A column as a number that keeps its order; null becomes -1 or lower."""
    if kind != "string":
        return F.coalesce(F.col(name).cast("double"), F.lit(-1.0))
    head = F.rpad(F.hex(F.substring(F.encode(F.col(name), "UTF-8"), 1, 7)), 14, "0")
    return F.coalesce(F.conv(head, 16, 10).cast("double"), F.lit(-1.0))


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Index on the Hilbert curve of a cell given by one coordinate of ``bits``
    bits for each of n dimensions.

    From the highest bit on, the coordinates' bits form an n-bit corner; entry
    point e and direction d of the current subcube turn it into a step w of the
    n-bit Gray code. All of it is one fold over the bit levels."""
    n = len(cells)
    full = (1 << n) - 1

    def rotate(x: Column, by: Column) -> Column:         # n-bit rotation to the left
        by = F.pmod(by, F.lit(n))
        return F.call_function("shiftleft", x, by).bitwiseOR(F.call_function("shiftright", x, F.lit(n) - by)).bitwiseAND(full)

    def bit_or(parts: list[Column]) -> Column:
        out = parts[0]
        for p in parts[1:]:
            out = out.bitwiseOR(p)
        return out

    def table(f) -> Column:
        return F.array(*(F.lit(f(w)) for w in range(1 << n)))

    gray = lambda w: w ^ (w >> 1)
    ones = lambda w: (~w & (w + 1)).bit_length() - 1  # noqa: E731  trailing ones
    step_of = table({gray(w): w for w in range(1 << n)}.__getitem__)
    entry = table(lambda w: 0 if w == 0 else gray(2 * ((w - 1) // 2)))
    turn = table(lambda w: 0 if w == 0 else ones(w - 1 if w % 2 == 0 else w) % n)
    start = F.struct(F.lit(0).alias("e"), F.lit(0).alias("d"), F.lit(0).cast("long").alias("h"))

    def step(s: Column, level: Column) -> Column:
        corner = bit_or([F.call_function("shiftleft", F.call_function("shiftright", c, level).bitwiseAND(1), F.lit(k)) for k, c in enumerate(cells)])
        w = F.element_at(step_of, rotate(corner.bitwiseXOR(s["e"]), F.lit(n) - s["d"] - 1) + 1)
        return F.struct(
            s["e"].bitwiseXOR(rotate(F.element_at(entry, w + 1), s["d"] + 1)).alias("e"),
            F.pmod(s["d"] + F.element_at(turn, w + 1) + 1, F.lit(n)).alias("d"),
            F.call_function("shiftleft", s["h"], F.lit(n)).bitwiseOR(w.cast("long")).alias("h"))

    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), start, step, lambda s: s["h"])


def ordered(docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, the dimensions' cells, hilbert) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = [d for d in dimensions if d not in ("size", "doc_id")]
    rows = docs.select(F.col("doc_id").cast("long"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), *own)
    kinds = dict(rows.dtypes)
    rows = rows.select("doc_id", "size", "text_crc32", *(_number(d, kinds[d]).alias(f"v_{d}") for d in dimensions))
    rows = keep(rows, "metadata")
    # 2 ** bits - 1 quantiles for each dimension, whatever the rows.
    cuts = rows.agg(*(F.percentile_approx(f"v_{d}", [k / (1 << bits) for k in range(1, 1 << bits)], 10_000).alias(d) for d in dimensions)).first()
    cell = lambda d: F.size(F.filter(F.array(*map(F.lit, cuts[d] or [0.0])), lambda q: q < F.col(f"v_{d}")))
    rows = rows.select("doc_id", "size", "text_crc32", *(cell(d).alias(f"cell_{d}") for d in dimensions))
    return rows.withColumn("hilbert", hilbert_index([F.col(f"cell_{d}") for d in dimensions], bits))


def shards(docs: DataFrame, count: int = SHARDS, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert) of every row."""
    order = ["hilbert", "doc_id", "text_crc32", "size"]
    rows = ordered(docs, dimensions, bits).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = keep(rows.select("doc_id", "size", "text_crc32", "hilbert", F.spark_partition_id().alias("part")), "ranged")
    counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # A row for each range partition; their number does not follow the rows.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(every).alias("total"))
    rank = F.col("offset") + F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    rows = rows.join(F.broadcast(counts), "part").withColumn("rank", rank)
    # The first total % count shards hold one row more.
    small, big = F.expr(f"total div {count}"), F.col("total") % count
    edge = big * (small + 1)
    shard = F.when(F.col("rank") < edge, F.expr(f"rank div ((total div {count}) + 1)")).otherwise(
        big + F.floor((F.col("rank") - edge) / F.greatest(small, F.lit(1))))
    first = F.col("shard") * small + F.least(F.col("shard").cast("long"), big)
    return rows.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("rank") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert")
