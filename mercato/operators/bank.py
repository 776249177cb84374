"""Retail bank operators (week 4): node allocation and customer transactions.

Inputs: ``nodes(customer_id, region_id, node_id, start_date, end_date)`` with
``9999-12-31`` marking an open allocation, ``regions(region_id,
region_name)``, ``txns(customer_id, txn_date, txn_type, txn_amount)``.
Months are month-of-year numbers, so the same month of different years
falls together, as in the case study.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.dates import month_name_of
from mercato.functions.exact import exact_avg, exact_sum
from mercato.functions.numeric import round_ratio
from mercato.functions.text import dollars, money_text
from mercato.operators.distinct import distinct_bitmaps, distinct_counts
from mercato.operators.ordered import percentiles, with_neighbours, with_running_sum

# Fixed values of the case study (defaults of the parameters below).
OPEN_END = "9999-12-31"
PERCENTILES = (0.5, 0.8, 0.95)
PERCENTILE_NAMES = ("median", "percentile_80th", "percentile_95th")
GROWTH_THRESHOLD = 5


# ---- A. customer nodes --------------------------------------------------------------
def distinct_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.agg(F.countDistinct("node_id").alias("nodes"))


def nodes_by_region(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    return (nodes.join(regions, on="region_id").groupBy("region_name")
            .agg(F.countDistinct("node_id").alias("no_of_nodes")))


def customers_by_region(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    return (nodes.join(regions, on="region_id").groupBy("region_name")
            .agg(F.countDistinct("customer_id").alias("no_of_customers")))


def _closed(nodes: DataFrame, open_end: str) -> DataFrame:
    return nodes.filter(F.col("end_date") != F.lit(open_end).cast("date")).withColumn(
        "days", F.datediff("end_date", "start_date"))


def realloc_avg_days(nodes: DataFrame, open_end: str = OPEN_END) -> DataFrame:
    """Average whole days of a closed allocation, rounded half up (exact)."""
    c = _closed(nodes, open_end)
    return c.agg(round_ratio(F.sum("days"), F.count("days"), 0).alias("reallocation_avg_time"))


def realloc_percentiles(nodes: DataFrame, regions: DataFrame, open_end: str = OPEN_END,
                        ps: Sequence[float] = PERCENTILES,
                        names: Sequence[str] = PERCENTILE_NAMES,
                        digits: int | None = None, approx_accuracy: int | None = None) -> DataFrame:
    """Exact interpolated percentiles (percentile_cont) of closed-allocation
    days per region. The aggregate keeps a value -> count map per region and
    merges partial maps, so a large region does not gather its rows.

    ``approx_accuracy`` opts into ``percentile_approx`` (a mergeable sketch of
    bounded size, returning observed values, not interpolated ones) for
    metrics with very many distinct values."""
    c = _closed(nodes, open_end).join(regions, on="region_id")
    if approx_accuracy is None:
        p = F.percentile("days", list(ps))
    else:
        p = F.percentile_approx("days", list(ps), approx_accuracy).cast("array<double>")
    g = c.groupBy("region_name").agg(p.alias("_p"))
    cols = []
    for i, name in enumerate(names):
        v = F.col("_p")[i]
        cols.append((F.round(v, digits) if digits is not None else v).alias(name))
    return g.select("region_name", *cols)


def amount_percentiles(txns: DataFrame, value: str = "price", ps: Sequence[float] = PERCENTILES,
                       names: Sequence[str] = PERCENTILE_NAMES, **how) -> DataFrame:
    """Exact interpolated percentiles of a continuous amount per region: ranks
    are selected by distributed histograms, so no state holds the values."""
    return percentiles(txns, value, ps, names, ["region_name"], **how)


def exact_amounts(txns: DataFrame, value: str = "price") -> DataFrame:
    """Total and average of a continuous amount per region, to the last bit the
    same for any order and partitioning of the rows."""
    return txns.groupBy("region_name").agg(exact_sum(value).alias("total"), exact_avg(value).alias("average"))


def allocation_bitmaps(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    """Customers and nodes of each region and start year as bitmaps (a table to write once)."""
    n = nodes.join(regions, on="region_id").withColumn("start_year", F.year("start_date"))
    return distinct_bitmaps(n, ["customer_id", "node_id"], ["region_name", "start_year"])


def allocation_rollup(bitmaps: DataFrame) -> DataFrame:
    """Distinct customers and nodes by region and year, region, year, and in
    total, all from the table of bitmaps; ``level`` numbers these four."""
    levels = (["region_name", "start_year"], ["region_name"], ["start_year"], [])
    return distinct_counts(bitmaps, {"customer_id": "no_of_customers", "node_id": "no_of_nodes"}, levels)


# ---- B. customer transactions ---------------------------------------------------------
def txn_totals(txns: DataFrame) -> DataFrame:
    """Count and ``$ 1,234,567`` total per transaction type, most frequent first."""
    return (txns.groupBy("txn_type")
            .agg(F.count("txn_type").alias("txn_type_count"),
                 money_text(F.sum("txn_amount")).alias("total_amount"))
            .orderBy(F.desc("txn_type_count"), "txn_type"))


def deposit_averages(txns: DataFrame, deposit: str = "deposit") -> DataFrame:
    """Rounded average deposit count per customer and ``$`` average of the
    per-customer average deposit (an average of averages, as asked)."""
    per_customer = (txns.filter(F.col("txn_type") == deposit).groupBy("customer_id")
                    .agg(F.count("txn_type").alias("cnt"), F.avg("txn_amount").alias("amt")))
    return per_customer.agg(
        round_ratio(F.sum("cnt"), F.count("cnt"), 0).alias("deposit_count"),
        dollars(F.avg("amt"), 2).alias("deposit_amt"),
    )


def active_months(txns: DataFrame, min_deposits: int = 1, exact: int = 1,
                  grain: str = "month") -> DataFrame:
    """Customers per month with more than ``min_deposits`` deposits and
    exactly ``exact`` withdrawals or exactly ``exact`` purchases.

    ``grain="month"`` keys on the month of the year, as the case study does
    (the same month of different years falls together);
    ``grain="year_month"`` keeps years apart and adds ``calendar_year``."""
    keys = ["months"] if grain == "month" else ["calendar_year", "months"]
    t = txns.withColumn("months", F.month("txn_date")).withColumn("calendar_year", F.year("txn_date"))
    kind = F.col("txn_type")
    per = t.groupBy("customer_id", *keys).agg(
        F.count(F.when(kind == "deposit", 1)).alias("d"),
        F.count(F.when(kind == "withdrawal", 1)).alias("w"),
        F.count(F.when(kind == "purchase", 1)).alias("p"),
    )
    ok = per.filter((F.col("d") > min_deposits) & ((F.col("w") == exact) | (F.col("p") == exact)))
    g = ok.groupBy(*keys).agg(F.count("customer_id").alias("customer_count"))
    name = month_name_of("months", "upper")
    extra = [] if grain == "month" else [F.col("calendar_year").cast("bigint").alias("calendar_year")]
    return g.orderBy(*keys).select(*extra, name.alias("month_name"), "customer_count")


def _monthly_net(txns: DataFrame) -> DataFrame:
    signed = F.when(F.col("txn_type") == "deposit", F.col("txn_amount")).otherwise(-F.col("txn_amount"))
    return txns.groupBy("customer_id", F.month("txn_date").cast("bigint").alias("month")).agg(
        F.sum(signed).alias("amount"))


def closing_balance(txns: DataFrame, ordered: bool = True) -> DataFrame:
    """Running balance per customer at each month with transactions.

    The window runs over one customer's months (at most 12 rows), after the
    aggregate has reduced the transactions."""
    net = _monthly_net(txns)
    w = Window.partitionBy("customer_id").orderBy("month")
    out = net.select("customer_id", "month", F.sum("amount").over(w).alias("closing_balance"))
    return out.orderBy("customer_id", "month") if ordered else out


def _growth_share(balances: DataFrame, threshold: int, absolute: bool) -> DataFrame:
    w = Window.partitionBy("customer_id").orderBy("month")
    prev = F.lag("closing_balance").over(w)
    g = balances.select("customer_id", "closing_balance", prev.alias("prev"))
    denom = F.abs(F.col("prev")) if absolute else F.col("prev")
    # 100 * (cb - prev) / prev > threshold, compared exactly in integers;
    # a zero previous balance gives no ratio.
    diff = (F.col("closing_balance") - F.col("prev")).cast("decimal(38,0)") * 100
    grew = F.when(denom != 0, (diff - denom * threshold) * F.signum(denom) > 0)
    # Every customer with transactions has a balance, and the rows already lie
    # by customer: one scan and one exchange give both counts.
    each = g.groupBy("customer_id").agg(F.max(grew).alias("grew")).filter("customer_id IS NOT NULL")
    grown, everyone = F.count(F.when(F.col("grew"), 1)), F.count(F.lit(1))
    return each.agg(((grown * 100).cast("double") / F.nullif(everyone, F.lit(0)).cast("double")).alias("percentage_customer"))


def growth_share(txns: DataFrame, threshold: int = GROWTH_THRESHOLD) -> DataFrame:
    """As written: share of customers with a month whose *monthly net* grew by
    more than ``threshold`` percent over the previous month's net (the
    "closing balance" there is partitioned by customer and month)."""
    net = _monthly_net(txns).withColumnRenamed("amount", "closing_balance")
    return _growth_share(net, threshold, absolute=False)


def growth_share_fixed(txns: DataFrame, threshold: int = GROWTH_THRESHOLD) -> DataFrame:
    """Share of customers whose running closing balance grew by more than
    ``threshold`` percent of the previous balance's size in some month."""
    return _growth_share(closing_balance(txns, ordered=False), threshold, absolute=True)


def running_balance(txns: DataFrame, **how) -> DataFrame:
    """Balance of a region through each transaction's day, a row for each
    transaction: a running sum at row grain over groups of any size."""
    t = txns.select("region_name", "txn_id", "txn_date", "amount")
    return with_running_sum(t, "amount", ["txn_date"], ["region_name"], "balance", **how)


def neighbouring_amounts(txns: DataFrame, **how) -> DataFrame:
    """Each transaction with the previous amount of its region, the one three
    before (0 where there is none) and the next one, by day and transaction."""
    t = txns.select("region_name", "txn_id", "txn_date", "amount")
    columns = {"previous": 1, "third_before": (3, 0), "next": -1}
    return with_neighbours(t, "amount", ["txn_date", "txn_id"], columns, ["region_name"], **how)
