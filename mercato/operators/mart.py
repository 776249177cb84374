"""Weekly sales mart operators (week 5): exploration, shares and the
before/after comparison around a baseline week.

Input: the clean weekly sales table (``operators.cleaning.clean_weekly_sales``)
with week_date, week_number, month_number, calendar_year, region, platform,
segment, customer_type, age_band, demographic, transactions, sales,
avg_transaction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.dates import day_name_of, month_name_of
from mercato.functions.numeric import round_ratio

# Fixed values of the case study (defaults of the parameters below).
BASELINE_WEEK = "2020-06-15"
BASELINE_YEAR = 2020
WEEK_SERIES = (1, 53)
PREVIEW_ROWS = 10
RETAIL = "Retail"
SHOPIFY = "Shopify"
CLEAN_KEY = ("week_date", "region", "platform", "segment", "customer_type")


def preview(clean: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows in key order (a distributed top-n)."""
    return clean.orderBy(*CLEAN_KEY).limit(n)


def weekday_names(clean: DataFrame) -> DataFrame:
    days = clean.select(F.dayofweek("week_date").alias("_dow")).distinct()
    return days.select(day_name_of("_dow", "upper").alias("day_of_week"))


def missing_weeks(clean: DataFrame, lo: int = WEEK_SERIES[0], hi: int = WEEK_SERIES[1]) -> DataFrame:
    """Week numbers lo..hi absent from the data.

    NULL week numbers are ignored (a NOT IN list with a NULL would return
    nothing). The distinct week numbers are at most 53 rows."""
    spark = clean.sparkSession
    series = spark.range(lo, hi + 1).select(F.col("id").alias("missing_week_numbers"))
    seen = (clean.select(F.col("week_number").cast("bigint").alias("missing_week_numbers"))
            .filter(F.col("missing_week_numbers").isNotNull()).distinct())
    return (series.join(F.broadcast(seen), on="missing_week_numbers", how="left_anti")
            .orderBy("missing_week_numbers"))


def txn_by_year(clean: DataFrame) -> DataFrame:
    return (clean.groupBy("calendar_year").agg(F.sum("transactions").alias("total_transaction"))
            .orderBy("calendar_year"))


def sales_by_region_month(clean: DataFrame) -> DataFrame:
    """Sales per region and month name (month names of all years together)."""
    g = clean.groupBy("region", "month_number").agg(F.sum("sales").alias("total_sales"))
    return (g.select("region", month_name_of("month_number").alias("months"), "total_sales")
            .orderBy("region", "months"))


def platform_rows(clean: DataFrame) -> DataFrame:
    """Number of rows with a transactions value per platform (a count, not a sum)."""
    return (clean.groupBy("platform").agg(F.count("transactions").alias("total_no_transaction"))
            .orderBy("platform"))


def _share(col: str, value: str) -> F.Column:
    part = F.sum(F.when(F.col(col) == value, F.col("sales")))
    return round_ratio(part * 100, F.sum("sales"), 2)


def platform_share(clean: DataFrame, retail: str = RETAIL, shopify: str = SHOPIFY) -> DataFrame:
    g = (clean.groupBy("calendar_year", "month_number")
         .agg(_share("platform", retail).alias("retail_sales"),
              _share("platform", shopify).alias("shopify_sales")))
    return (g.select("calendar_year", month_name_of("month_number", "upper").alias("months"),
                     "retail_sales", "shopify_sales")
            .orderBy("calendar_year", "months"))


def demographic_share(clean: DataFrame) -> DataFrame:
    return (clean.groupBy("calendar_year")
            .agg(_share("demographic", "Couples").alias("couple_sales"),
                 _share("demographic", "Families").alias("family_sales"),
                 _share("demographic", "unknown").alias("unknown_sales"))
            .orderBy("calendar_year"))


def retail_contribution(clean: DataFrame, platform: str = RETAIL) -> DataFrame:
    """Sales of one platform by age band and demographic, and their share."""
    r = clean.filter(F.col("platform") == platform)
    total = r.agg(F.sum("sales").alias("_total"))  # one row
    g = r.groupBy("age_band", "demographic").agg(F.sum("sales").alias("subtotal"))
    return (g.crossJoin(F.broadcast(total))
            .select("age_band", "demographic", "subtotal",
                    round_ratio(F.col("subtotal") * 100, F.col("_total"), 2).alias("percentage_contribution"))
            .orderBy(F.desc("subtotal"), "age_band", "demographic"))


def avg_transaction_size(clean: DataFrame) -> DataFrame:
    """Average of the row averages next to the proper sum(sales)/sum(transactions).

    avg_transaction holds cents exactly, so the average of averages is also
    rounded exactly."""
    cents = F.round(F.col("avg_transaction") * 100).cast("bigint")
    return (clean.groupBy("calendar_year", "platform")
            .agg(round_ratio(F.sum(cents), F.count(cents) * 100, 2).alias("avg_avg_transactions"),
                 round_ratio(F.sum("sales"), F.sum("transactions"), 2).alias("proper_avg_transactions"))
            .orderBy("calendar_year", "platform"))


def baseline_week(clean: DataFrame, baseline: str = BASELINE_WEEK) -> DataFrame:
    """Distinct week number(s) of the baseline date: one row, or none when
    the date is absent (week_number is a function of week_date)."""
    day = F.lit(baseline).cast("date")
    # calendar_year = year(week_date) in the clean table, so the extra
    # predicate changes nothing but lets the scan read one year partition.
    return (clean.filter((F.col("week_date") == day) & (F.col("calendar_year") == F.year(day)))
            .select(F.col("week_number").alias("_base_week")).distinct())


def before_after(clean: DataFrame, n: int, by: Sequence[str] = (), baseline: str = BASELINE_WEEK,
                 year: int | None = None) -> DataFrame:
    """Sales of the ``n`` weeks before the baseline week and of the ``n``
    weeks from it on, with the percentage change.

    before = weeks w-n .. w-1, after = weeks w .. w+n-1 of every row's
    week_number (all years unless ``year`` is given). With no baseline row the
    result is one all-NULL row without ``by`` and no rows with it. The
    baseline is a one-row broadcast; sales are partially aggregated right
    after the join, so raw rows never cross the network.
    """
    rows = clean if year is None else clean.filter(F.col("calendar_year") == year)
    j = rows.crossJoin(F.broadcast(baseline_week(clean, baseline)))
    wk, base = F.col("week_number"), F.col("_base_week")
    before = F.sum(F.when(wk.between(base - n, base - 1), F.col("sales"))).alias("before_changes")
    after = F.sum(F.when(wk.between(base, base + n - 1), F.col("sales"))).alias("after_changes")
    g = j.groupBy(*by).agg(before, after) if by else j.agg(before, after)
    pct = round_ratio((F.col("after_changes") - F.col("before_changes")) * 100, F.col("before_changes"), 2)
    return g.select(*by, "before_changes", "after_changes", pct.alias("pct_change"))


def before_after_cuts(clean: DataFrame, n: int, dims: Sequence[str], baseline: str = BASELINE_WEEK,
                      year: int | None = None) -> DataFrame:
    """``before_after`` by each of ``dims`` in one pass (the bonus question
    compares all its cuts): one scan, one broadcast, one partially aggregated
    shuffle with grouping sets, instead of one job per cut.

    Output: dimension, value (as text), before_changes, after_changes,
    pct_change; one row per (dimension, value), as the separate statements.
    """
    rows = clean if year is None else clean.filter(F.col("calendar_year") == year)
    j = rows.crossJoin(F.broadcast(baseline_week(clean, baseline)))
    wk, base = F.col("week_number"), F.col("_base_week")
    g = j.groupingSets([[d] for d in dims], *dims).agg(
        F.sum(F.when(wk.between(base - n, base - 1), F.col("sales"))).alias("before_changes"),
        F.sum(F.when(wk.between(base, base + n - 1), F.col("sales"))).alias("after_changes"),
        *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    dimension = F.coalesce(*[F.when(F.col(f"_g_{d}") == 0, F.lit(d)) for d in dims])
    value = F.coalesce(*[F.when(F.col(f"_g_{d}") == 0, F.col(d).cast("string")) for d in dims])
    pct = round_ratio((F.col("after_changes") - F.col("before_changes")) * 100, F.col("before_changes"), 2)
    return g.select(dimension.alias("dimension"), value.alias("value"), "before_changes",
                    "after_changes", pct.alias("pct_change"))
