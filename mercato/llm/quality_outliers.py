"""Quality rules: robust multivariate outliers by the minimum covariance determinant.

Base rules fail texts with too few words or too many words in repeated
three-word windows. The rest is judged by a vector of transformed statistics
(``FEATURES``). Per language and source, the location and scatter of the densest
three quarters of the documents are estimated: from median and MAD, C-steps
take the documents of smallest Mahalanobis distance and estimate anew, which
never raises the determinant; a reweighting step with all documents within the
97.5 % distance ends it. A document farther out than the ``TAIL`` quantile of
the chi-square law is rejected.

Most documents repeat no line and no words, and those that do repeat a little.
These two statistics are judged by their non-zero part: 0 stays 0, others count
from the median of the non-zero values on, in units of their quartiles' spread
(at least ``ZERO``). The part is that of the estimate's level or the next wider
one with ``MIN_PART`` such documents. Where there is none, or the level of the
estimate has but one, a text counts from 0 on in units of ZERO: among clean
texts one that is extreme in repeats alone is an outlier.

Groups with fewer than ``MIN_GROUP`` documents take the estimate of their
language, and languages with fewer that of all documents. Each estimate is made
of sums over all rows of its group: Spark aggregates them partially, so a source
may hold any share of the rows, and no group is gathered. Scatter matrices get
the variances of ``FLOOR`` added: most documents have no symbols or repeated
lines at all, and a plain covariance would be singular. The floors of the
repeats are one unit of their scale.

Null languages and sources are groups of their own. Null and empty texts have
no words and fail the base rules. Repeated rows are judged each.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import batch, keep, no_cycles, tune

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
MIN_WORDS, REPEATED = 50, 50        # base rules: words at least; per cent of words repeated at most
FEATURES = ("word_length", "symbols", "lines", "repeats")
FLOOR = (0.05, 0.35, 1.0, 1.0)      # standard deviations added to the scatter
INFLATED = (2, 3)                   # features that are 0 in most documents, judged by their non-zero part
ZERO = 0.6                          # least unit of these, and the unit where no non-zero part is known
MIN_PART = 20                       # documents that a non-zero part is known from
CORE = 0.75                         # share of a group that the determinant is taken of
STEPS = 4
MIN_GROUP = 80
TAIL = 1e-3

STATS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def statistics(text: str | None) -> tuple[int, int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0, 0
    found = text.encode("utf-8", "replace").split()
    n = len(found)
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return n, chars, symbols, len(lines), len(lines) - len(set(lines)), repeated_words(found)


def repeated_words(found: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more."""
    n, known = len(found), {}
    if n < 4:
        return 0
    x = np.fromiter((known.setdefault(w, len(known)) for w in found), np.int64, n)
    size = len(known)
    first = x[:-1] * size + x[1:]
    if size > 2_000_000:                       # keeps the code of three words within 63 bits
        _, first = np.unique(first, return_inverse=True)
    code = first[:-1] * size + x[2:]
    order = np.argsort(code)
    same = code[order][1:] == code[order][:-1]
    on = np.zeros(n - 2, bool)
    on[order[1:]] = same
    on[order[:-1]] |= same
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k:n - 2 + k] |= on
    return int(hit.sum())


def _statistics(batches):
    for b in batches:
        with no_cycles():
            rows = [statistics(t) for t in b.column(3).to_pylist()]
        yield batch(f"doc_id long, lang string, source string, {STATS}",
                    [*(b.column(k).to_pylist() for k in range(3)), *(list(zip(*rows)) or [[]] * 6)])


def chi_square_tail(x: float, k: int) -> float:
    """P(chi-square with an even number k of degrees of freedom > x)."""
    return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))


def chi_square_quantile(tail: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_tail(mid, k) > tail else (low, mid)
    return low


def consistency(share: float, k: int) -> float:
    """What the scatter of the inner ``share`` of normal vectors is multiplied by."""
    return share / (1 - chi_square_tail(chi_square_quantile(1 - share, k), k + 2))


def _inverted(batches, floor: tuple[float, ...], factor: float):
    """Sums of a group's inner rows -> its location and inverse scatter, as columns."""
    k = len(floor)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    schema = estimate_schema(k)
    for b in batches:
        rows = []
        for r in b.to_pylist():
            mean = np.array([r[f"m{i}"] for i in range(k)])
            cov = np.zeros((k, k))
            for i, j in pairs:
                cov[i, j] = cov[j, i] = r[f"s{i}_{j}"] - mean[i] * mean[j]
            inverse = np.linalg.inv(factor * cov + np.diag(np.square(floor)))
            rows.append((r["key"], *mean.tolist(), *(float(inverse[i, j]) for i, j in pairs)))
        yield batch(schema, list(zip(*rows)) if rows else [[]] * (1 + k + len(pairs)))


def estimate_schema(k: int) -> str:
    return ", ".join(["key string", *(f"m{i} double" for i in range(k)), *(f"w{i}_{j} double" for i in range(k) for j in range(i, k))])


def distance(k: int) -> Column:
    """Squared Mahalanobis distance of f0.. from the estimate's columns."""
    d = [F.col(f"f{i}") - F.col(f"m{i}") for i in range(k)]
    return sum(((1.0 if i == j else 2.0) * F.col(f"w{i}_{j}") * d[i] * d[j] for i in range(k) for j in range(i, k)), F.lit(0.0))


def minimum_covariance(rows: DataFrame, floor: tuple[float, ...], core: float = CORE, steps: int = STEPS) -> DataFrame:
    """The reweighted estimate of each ``key`` over the vectors f0.. of its rows."""
    k = len(floor)

    def estimate(inner: DataFrame, factor: float, name: str) -> DataFrame:
        sums = [F.avg(f"f{i}").alias(f"m{i}") for i in range(k)]
        sums += [F.avg(F.col(f"f{i}") * F.col(f"f{j}")).alias(f"s{i}_{j}") for i in range(k) for j in range(i, k)]
        return keep(inner.groupBy("key").agg(*sums).mapInArrow(lambda it: _inverted(it, floor, factor), estimate_schema(k)), name)

    middle = rows.groupBy("key").agg(*(F.percentile_approx(f"f{i}", 0.5).alias(f"m{i}") for i in range(k)))
    spread = rows.join(middle, "key").groupBy("key").agg(
        *(F.first(f"m{i}").alias(f"m{i}") for i in range(k)),
        *((1 / (F.pow(1.4826 * F.percentile_approx(F.abs(F.col(f"f{i}") - F.col(f"m{i}")), 0.5), F.lit(2)) + floor[i] ** 2)).alias(f"w{i}_{i}") for i in range(k)))
    found = keep(spread.select("key", *(f"m{i}" for i in range(k)), *((F.col(f"w{i}_{j}") if i == j else F.lit(0.0)).alias(f"w{i}_{j}") for i in range(k) for j in range(i, k))), "start")
    factor = consistency(core, k)
    for _ in range(steps):
        far = rows.join(found, "key").select("key", *(f"f{i}" for i in range(k)), distance(k).alias("d2"))
        cut = far.groupBy("key").agg(F.percentile_approx("d2", core, 10_000).alias("cut"))
        found = estimate(far.join(cut, "key").where("d2 <= cut"), factor, "core")
    near = rows.join(found, "key").where(distance(k) <= chi_square_quantile(0.025, k))
    return estimate(near, consistency(0.975, k), "reweighted")


def non_zero_parts(levels: DataFrame) -> DataFrame:
    """Per ``key`` the count n and the quartiles q of each inflated feature's non-zero values."""
    some = {i: F.when(F.col(f"f{i}") > 0, F.col(f"f{i}")) for i in INFLATED}
    return levels.groupBy("key").agg(*(a for i, v in some.items() for a in (
        F.count(v).alias(f"n{i}"), F.percentile_approx(v, [0.25, 0.5, 0.75], 10_000).alias(f"q{i}"))))


def unit_of(i: int) -> tuple[Column, Column]:
    """Where an inflated feature counts from and its unit, from a group's level ``at`` (0 source,
    1 language, 2 all) and the parts n{i}_{level}, q{i}_{level}."""
    n = [F.coalesce(f"n{i}_{k}", F.lit(0)) for k in range(3)]
    lone = F.element_at(F.array(*n), F.col("at") + 1) <= 1
    q = F.coalesce(*(F.when((F.col("at") <= k) & (n[k] >= MIN_PART), F.col(f"q{i}_{k}")) for k in range(3)))
    q = F.when(~lone, q)
    return (F.coalesce(q[1], F.lit(0.0)).alias(f"from{i}"),
            F.greatest(F.coalesce((q[2] - q[0]) / 1.349, F.lit(ZERO)), F.lit(ZERO)).alias(f"unit{i}"))


def scaled(i: int) -> Column:
    f = F.col(f"f{i}")
    return F.when(f > 0, F.greatest(F.lit(0.0), f - F.col(f"from{i}")) / F.col(f"unit{i}")).when(f == 0, 0.0) if i in INFLATED else f


def share_log(part: Column, whole: Column) -> Column:
    """About the log of the per cent where it is small; grows without bound towards 100 %."""
    return F.log1p(100 * part / whole) - F.log(1 - part / whole)


def judged(docs: DataFrame, min_group: int = MIN_GROUP, tail: float = TAIL) -> DataFrame:
    """Statistics, base_failed, the squared distance and kept of every row of ``docs``."""
    tune(docs.sparkSession)
    text = docs.select(F.col("doc_id").cast("long"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), F.col("text").cast("string"))
    rows = text.mapInArrow(_statistics, f"doc_id long, lang string, source string, {STATS}")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    rows = keep(rows.withColumn("base_failed", failed), "statistics")
    n = F.col("n_words")
    vector = (F.log(F.col("word_chars") / n), F.log1p(100 * F.col("n_symbols") / n),
              share_log(F.col("n_dup_lines"), F.greatest("n_lines", F.lit(1))), share_log(F.col("n_repeat_words"), n))
    k = len(vector)
    every = rows.where("NOT base_failed").select("doc_id", "lang", "source", *(v.alias(f"f{i}") for i, v in enumerate(vector)))

    own, lang = F.concat_ws("\0", F.lit("s"), "lang", "source"), F.concat_ws("\0", F.lit("l"), "lang")
    sources = every.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_source"))
    langs = sources.groupBy("lang").agg(F.sum("n_source").alias("n_lang"))
    # Which estimate a (lang, source) takes, and which rows each estimate is made of.
    at = F.when(F.col("n_source") >= min_group, 0).when(F.col("n_lang") >= min_group, 1).otherwise(2)
    takes = sources.join(langs, "lang").select("lang", "source", own.alias("key0"), lang.alias("key1"), F.lit("all").alias("key2"), at.alias("at"))
    # The non-zero parts of the three levels, and from these the scale of each (lang, source).
    some = every.where(" OR ".join(f"f{i} > 0" for i in INFLATED))
    parts = keep(non_zero_parts(some.select(F.explode(F.array(own, lang, F.lit("all"))).alias("key"), *(f"f{i}" for i in INFLATED))), "parts")
    for level in range(3):
        takes = takes.join(parts.select(F.col("key").alias(f"key{level}"), *(F.col(f"{c}{i}").alias(f"{c}{i}_{level}") for i in INFLATED for c in "nq")), f"key{level}", "left")
    key = F.element_at(F.array("key0", "key1", "key2"), F.col("at") + 1)
    takes = keep(takes.select("lang", "source", key.alias("key"), *(c for i in INFLATED for c in unit_of(i))), "takes")
    used = takes.select(F.col("key").alias("used")).distinct()
    levels = takes.select("lang", "source", *(f"{c}{i}" for i in INFLATED for c in ("from", "unit")), F.explode(F.array(own, lang, F.lit("all"))).alias("used")).join(used, "used")
    vectors = every.join(levels.withColumnRenamed("used", "key"), ["lang", "source"]).select("key", *(scaled(i).alias(f"f{i}") for i in range(k)))
    found = minimum_covariance(keep(vectors, "vectors"), FLOOR)
    cut = chi_square_quantile(tail, k)
    out = rows.select("*", *(F.when(~F.col("base_failed"), v).alias(f"f{i}") for i, v in enumerate(vector)))
    out = out.join(takes, ["lang", "source"], "left").join(found, "key", "left")
    out = out.withColumns({f"f{i}": scaled(i) for i in INFLATED}).withColumn("d2", F.when(~F.col("base_failed"), distance(k)))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & F.coalesce(F.col("d2") <= cut, F.lit(True))).alias("kept"), "d2")
