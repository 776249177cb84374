"""How five document filters act on one another, for every order in which they can be applied.

A document's failures are a mask of five bits, and with its two labels they
decide what happens to it in each of the 120 orders: at which step it goes, and
at which later steps it fails again. So a class (mask, good, toxic) is one big
integer of 64-bit fields, six for each of the 600 steps. The documents of a part
are the sum of their classes' integers; a field counts documents of the part, so
it never reaches 2 ** 64 and never carries into the next one. The sum is
unpacked once a part.

Filters, by what fails: A under 100 words; B 100 * distinct words < 80 * words;
C 100 * capitals A-Z > 10 * code points; D holds one of ``#$%&*|``; E the same
text as any smaller doc_id, table-wide, removed or not. Words are
``[^\\x20\\x09-\\x0D]+``, case-sensitive; whole texts are used. A null text is an
empty one (and equals it for E); a null lang is the part "". A null doc_id has
no smaller one, is none, and has no labels. Rows that repeat a doc_id each count;
of equal texts all rows of the smallest doc_id pass E. A document is good (toxic)
if any of its label rows says so. Very long texts are one row's work in the JVM.
An empty table gives no rows. Other columns are not read.

Only digests of texts are shuffled, combined before each exchange: equal texts
meet as one minimum, classes as counts, at most 128 a part.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import batch, keep, tune

FILTERS = "ABCDE"
FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
ORDERS = ["".join(p) for p in permutations(FILTERS)]
RESULT = "part string, filter_order string, step int, " + ", ".join(f"{f} long" for f in FIELDS) + ", shapley long"


def text_failures(text: Column) -> Column:
    """Mask of the failures that a text shows by itself (A to D: bits 0 to 3)."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    failures = (n < 100, 100 * distinct < 80 * n, 100 * capitals.cast("long") > 10 * F.length(text).cast("long"), text.rlike(r"[#$%&*|]"))
    mask = F.lit(0)
    for bit, fails in enumerate(failures):
        mask = mask + F.when(fails, 1 << bit).otherwise(0)
    return mask


def classes(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents counted by part, mask, good and toxic: at most 128 rows a part."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digests = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                          text_failures(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("h"))
    digests = keep(digests, "digests")
    # Repeated rows become one, so neither join has a hot key: (h, id) and id are then of few rows each.
    rows = digests.filter("id is not null").groupBy("id", "h", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = digests.groupBy("h").agg(F.min("id").alias("id")).filter("id is not null").withColumn("first", F.lit(True))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = rows.join(first, ["h", "id"], "left").join(marks, "id", "left")
    full = F.col("mask") + F.when(F.col("first").isNull(), 1 << 4).otherwise(0)
    rows = rows.select("part", full.alias("mask"), *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")), "n")
    unnamed = digests.filter("id is null").select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"), F.lit(1).cast("long").alias("n"))
    return rows.unionByName(unnamed).groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=128)
def packed(mask: int, good: bool, toxic: bool) -> int:
    """What happens to one document of a class at all 600 steps, a 64-bit field for each count."""
    fields = []
    for order in ORDERS:
        before = 0
        for letter in order:
            bit = 1 << FILTERS.index(letter)
            fails, gone = bool(mask & bit), bool(mask & before)
            removed = fails and not gone
            fields += [not fails and not gone, removed, fails and gone, mask == bit, removed and good, removed and toxic]
            before |= bit
    return int.from_bytes(np.array(fields, "<u8").tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    """Counts of all steps: (order, step, field)."""
    size = len(ORDERS) * len(FILTERS) * len(FIELDS)
    return np.frombuffer(total.to_bytes(8 * size, "little"), "<u8").astype(np.int64).reshape(len(ORDERS), len(FILTERS), len(FIELDS))


def _audited(rows: pa.Table) -> pa.Table:
    part = rows.column("part")[0].as_py()
    total = sum(n * packed(m, g, t) for m, g, t, n in zip(*(rows.column(c).to_pylist() for c in ("mask", "good", "toxic", "n"))))
    counts = unpacked(total)
    letters = np.array([[FILTERS.index(x) for x in order] for order in ORDERS])
    shapley = [int(counts[:, :, 1][letters == k].sum()) for k in range(len(FILTERS))]
    steps = len(FILTERS)
    return pa.Table.from_batches([batch(RESULT, (
        [part] * len(ORDERS) * steps, [o for o in ORDERS for _ in range(steps)], list(range(1, steps + 1)) * len(ORDERS),
        *counts.reshape(-1, len(FIELDS)).T, [shapley[k] for k in letters.ravel().tolist()]))])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """600 rows a part, zeros included."""
    tune(docs.sparkSession)
    return classes(docs, labels).groupBy("part").applyInArrow(_audited, RESULT)


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
failed AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM texts),
marks AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
kinds AS (
  SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders5 AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l)
    JOIN letters d ON d.l NOT IN (a.l, b.l, c.l) JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS l, left(filter_order, step - 1) AS before
          FROM orders5, range(1, 6) r(step)),
outcomes AS (
  SELECT part, filter_order, step, l, n, good, toxic, fails = l AS only_it, contains(fails, l) AS now,
    before <> '' AND regexp_matches(fails, '[' || before || 'x]') AS gone
  FROM kinds, steps),
counted AS (
  SELECT part, filter_order, step, l,
    coalesce(sum(n) FILTER (WHERE NOT now AND NOT gone), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE now AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE now AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE only_it), 0) AS unique_fails,
    coalesce(sum(n) FILTER (WHERE now AND NOT gone AND good), 0) AS good_lost,
    coalesce(sum(n) FILTER (WHERE now AND NOT gone AND toxic), 0) AS toxic_lost
  FROM outcomes GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley
FROM counted"""
