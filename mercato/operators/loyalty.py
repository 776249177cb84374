"""Restaurant loyalty operators (week 1): spend, visits, favourites, points.

Inputs: ``sales(customer_id, order_date, product_id)``,
``menu(product_id, product_name, price)``, ``members(customer_id, join_date)``.
``tie`` names extra sales columns that make "first" / "top" choices
deterministic where the case study leaves ties open.

Where a statement starts with the inner join ``sales ⋈ menu``, ``menu`` may
be None: ``sales`` is then the already joined (priced) fact with
product_name and price, e.g. a table written once by ``priced_sales``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.ordered import with_ranks
from mercato.operators.ranking import first_by, rank_distinct
from mercato.operators.skew import skew_join

# Fixed values of the case study (defaults of the parameters below).
SPECIAL_PRODUCT = "sushi"
SPECIAL_MULTIPLIER = 20
BASE_MULTIPLIER = 10
FIRST_WEEK_DAYS = 6
POINTS_CUTOFF = "2021-02-01"


def priced_sales(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """``sales ⋈ menu`` (inner): every sale with its product name and price."""
    # menu is a dimension: the planner broadcasts it only when its estimated
    # or measured size is under spark.sql.autoBroadcastJoinThreshold.
    return sales.join(menu, on="product_id", how="inner")


def _priced(sales: DataFrame, menu: DataFrame | None) -> DataFrame:
    return sales if menu is None else priced_sales(sales, menu)


def total_spend(sales: DataFrame, menu: DataFrame | None) -> DataFrame:
    """Money spent per customer."""
    return (_priced(sales, menu).groupBy("customer_id")
            .agg(F.sum("price").alias("total_amount"))
            .orderBy(F.desc("total_amount"), "customer_id"))


def visits(sales: DataFrame) -> DataFrame:
    """Distinct visit days per customer (planned as two partial aggregates)."""
    return (sales.groupBy("customer_id")
            .agg(F.countDistinct("order_date").alias("visits"))
            .orderBy(F.desc("visits"), "customer_id"))


def first_item(sales: DataFrame, menu: DataFrame, tie: Sequence[str] = ("product_id",)) -> DataFrame:
    """First product each customer bought (earliest day, then ``tie``)."""
    if tuple(tie) == ("product_id",):
        # Two hash aggregates: the least product of each day, then that of the first day.
        days = sales.groupBy("customer_id", "order_date").agg(F.min("product_id").alias("product_id"))
        first = days.groupBy("customer_id").agg(
            F.coalesce(F.min_by("product_id", "order_date"), F.min("product_id")).alias("product_id"))
    else:
        first = first_by(sales, "customer_id", ["order_date", *tie])
    return first.join(menu, on="product_id").select(
        "customer_id", F.col("product_name").alias("first_product"))


def top_item_by_customer(sales: DataFrame, menu: DataFrame, k: int = 1,
                         priced: DataFrame | None = None) -> DataFrame:
    """The k most bought products overall (ties by product_id), and how often
    each customer bought them. ``priced`` (``sales ⋈ menu``, if already
    written) saves the join for the overall count."""
    ranked = priced if priced is not None else priced_sales(sales, menu)
    counts = ranked.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "product_id").limit(k).select("product_id")
    bought = sales.join(top, on="product_id", how="left_semi")
    per_customer = bought.groupBy("customer_id", "product_id").agg(
        F.count(F.lit(1)).alias("purchase_count"))
    return (per_customer.join(menu, on="product_id")
            .select("customer_id", "product_name", "purchase_count")
            .orderBy(F.desc("purchase_count"), "customer_id"))


def favourite_item(sales: DataFrame, menu: DataFrame | None) -> DataFrame:
    """Most bought product name(s) per customer, ties kept."""
    # ranked by count(product_name), reported as count(product_id), as written
    counts = _priced(sales, menu).groupBy("customer_id", "product_name").agg(
        F.count("product_id").alias("order_count"), F.count("product_name").alias("_by_name"))
    # The window holds a customer's menu items, not the sales.
    rank = F.rank().over(Window.partitionBy("customer_id").orderBy(F.desc("_by_name")))
    return counts.withColumn("_rank", rank).filter("_rank = 1").select("customer_id", "product_name", "order_count")


def _of_members(per_day: DataFrame, members: DataFrame, after: bool) -> DataFrame:
    """Rows already reduced to a customer's days, joined with the members and
    cut at the join day. The join takes no raw sales: a customer with any share
    of the rows brings at most a row for each day (and product)."""
    joined = per_day.join(members, on="customer_id", how="inner")
    cond = F.col("order_date") >= F.col("join_date") if after else F.col("order_date") < F.col("join_date")
    return joined.filter(cond)


def first_after_join(sales: DataFrame, menu: DataFrame | None, members: DataFrame,
                     tie: Sequence[str] = ("product_id",)) -> DataFrame:
    """First purchase on or after the join day, one row per member."""
    bought = _priced(sales, menu).select("customer_id", "order_date", *tie, "product_name").distinct()
    j = _of_members(bought, members, after=True)
    first = first_by(j, "customer_id", ["order_date", *tie], carry=["join_date", "product_name"])
    return first.select("customer_id", "join_date", "order_date", "product_name")


def last_before_join(sales: DataFrame, menu: DataFrame | None, members: DataFrame) -> DataFrame:
    """Every item of the last purchase day before joining."""
    bought = _priced(sales, menu).groupBy("customer_id", "order_date", "product_name").agg(F.count(F.lit(1)).alias("n"))
    before = _of_members(bought, members, after=False)
    # A customer_id out of an inner join is never NULL: plain equality will do.
    last = before.groupBy("customer_id").agg(F.max("order_date").alias("order_date"))
    items = before.join(last, on=["customer_id", "order_date"])
    each = items.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))
    return each.select("customer_id", "join_date", "order_date", "product_name")


def before_join_totals(sales: DataFrame, menu: DataFrame | None, members: DataFrame) -> DataFrame:
    """Items and money spent before joining."""
    days = _priced(sales, menu).groupBy("customer_id", "order_date").agg(
        F.count("product_id").alias("items"), F.sum("price").alias("amount"))
    return _of_members(days, members, after=False).groupBy("customer_id").agg(
        F.sum("items").alias("total_item"), F.sum("amount").alias("total_amount"))


def points(sales: DataFrame, menu: DataFrame | None, special: str = SPECIAL_PRODUCT,
           hi: int = SPECIAL_MULTIPLIER, lo: int = BASE_MULTIPLIER) -> DataFrame:
    """Points: ``hi`` per unit of price for the special product, else ``lo``."""
    pts = F.when(F.col("product_name") == special, F.col("price") * hi).otherwise(F.col("price") * lo)
    return (_priced(sales, menu).groupBy("customer_id")
            .agg(F.sum(pts).alias("total_points")).orderBy("customer_id"))


def first_week_points(sales: DataFrame, menu: DataFrame | None, members: DataFrame,
                      special: str = SPECIAL_PRODUCT, days: int = FIRST_WEEK_DAYS,
                      cutoff: str = POINTS_CUTOFF, hi: int = SPECIAL_MULTIPLIER,
                      lo: int = BASE_MULTIPLIER) -> DataFrame:
    """Member points before ``cutoff``: ``hi`` for the special product or any
    order from the join day to ``days`` later (both ends included)."""
    is_special = F.coalesce(F.col("product_name") == special, F.lit(False))
    per_day = _priced(sales, menu).filter(F.col("order_date") < F.lit(cutoff).cast("date")).groupBy(
        "customer_id", "order_date", is_special.alias("_special")).agg(F.sum("price").alias("amount"))
    j = per_day.join(members, on="customer_id")
    bonus = F.col("_special") | F.col("order_date").between(F.col("join_date"), F.date_add("join_date", days))
    pts = F.when(bonus, F.col("amount") * hi).otherwise(F.col("amount") * lo)
    return j.groupBy("customer_id").agg(F.sum(pts).alias("reward_points"))


def membership_flag(sales: DataFrame, menu: DataFrame | None, members: DataFrame,
                    ordered: bool = True) -> DataFrame:
    """Every sale with ``Y`` when made on or after joining, else ``N``
    (non-members compare with NULL and get ``N``), by customer and day. Raw
    sales meet the members, so a hot customer's are dealt over many tasks."""
    j = skew_join(_priced(sales, menu), members, "customer_id", "left")
    flag = F.when(F.col("order_date") >= F.col("join_date"), "Y").otherwise("N")
    out = j.select("customer_id", "order_date", "product_name", "price", flag.alias("membership"))
    return out.orderBy("customer_id", "order_date") if ordered else out


def member_ranking(sales: DataFrame, menu: DataFrame | None, members: DataFrame) -> DataFrame:
    """As ``membership_flag`` plus the dense rank of the order day among the
    customer's member days; NULL for non-member rows."""
    priced = _priced(sales, menu)
    member_days = _of_members(priced.select("customer_id", "order_date").distinct(), members, after=True)
    ranks = rank_distinct(member_days.select("customer_id", "order_date"), "customer_id", "order_date", "ranking")
    # The member rows are those of a ranked day: one join of the raw sales gives flag and rank.
    ranked = skew_join(priced, ranks, ["customer_id", "order_date"], "left")
    return ranked.select("customer_id", "order_date", "product_name", "price",
                         F.when(F.col("ranking").isNotNull(), "Y").otherwise("N").alias("membership"),
                         F.col("ranking").cast("bigint").alias("ranking"))


def sale_ranks(sales: DataFrame, carry: Sequence[str] = (), **how) -> DataFrame:
    """Every sale with the rank and the dense rank of its day among its
    customer's sales, latest first, whatever share of the rows the customer holds."""
    s = sales.select("customer_id", "order_date", "product_id", *carry)
    return with_ranks(s, ["order_date"], ["customer_id"], "day_rank", "day_dense_rank", descending=True, **how)
