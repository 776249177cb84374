"""Food delivery operators (week 2): pizza metrics, runner experience,
ingredients, pricing and ratings.

Inputs are the cleaned tables: ``orders`` from ``clean_customer_orders``
(order_id, customer_id, pizza_id, exclusions, extras, order_time) and
``runs`` from ``clean_runner_orders`` (order_id, runner_id, pickup_time,
distance, duration, cancellation, is_delivered).

Where a statement of the case study answers something other than its own
question, the function computes the statement as written and a ``*_fixed``
sibling computes the question.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.dates import day_name_of, minute_boundaries, tsql_week
from mercato.functions.numeric import int_div, round_ratio
from mercato.functions.text import dollars, rounded_text
from mercato.operators.ordered import with_ranks
from mercato.operators.ranking import ties_at_max

# Fixed values of the case study (defaults of the parameters below).
VEGETARIAN = "Vegetarian"
MEATLOVERS = "MEATLOVERS"
WEEKDAY_SHIFT_DAYS = 2
MIN_PICKUP_MINUTES = 1
PRICE_BY_PIZZA = {1: 12}
OTHER_PIZZA_PRICE = 10
EXTRA_FEE = 1
PAY_PER_KM = 0.30
RATINGS_ROWS = [
    (1, 1, 101, 4),
    (1, 2, 102, 3),
    (2, 3, 102, 4),
    (2, 4, 103, 5),
    (1, 5, 101, 3),
    (2, 6, 104, 4),
    (1, 7, 103, 5),
    (2, 8, 105, 4),
]
RATINGS_SCHEMA = T.StructType([
    T.StructField("runner_id", T.IntegerType()),
    T.StructField("order_id", T.IntegerType()),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("rating", T.IntegerType()),
])


def _delivered_by_distance(runs: DataFrame) -> DataFrame:
    # "distance != 0": NULL (cancelled) distances fail the test too.
    return runs.filter(F.col("distance") != 0)


def _price(price_by_id: dict[int, int], other: int) -> Column:
    out = F.lit(other)
    for pid, p in price_by_id.items():
        out = F.when(F.col("pizza_id") == pid, p).otherwise(out)
    return out


# ---- A. pizza metrics -------------------------------------------------------
def pizza_count(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count(F.lit(1)).alias("pizza_orders_count"))


def unique_orders(orders: DataFrame) -> DataFrame:
    return orders.agg(F.countDistinct("order_id").alias("unique_order"))


def successful_orders(runs: DataFrame) -> DataFrame:
    return (_delivered_by_distance(runs).groupBy("runner_id")
            .agg(F.count("order_id").alias("success_orders")))


def delivered_by_type(orders: DataFrame, runs: DataFrame, names: DataFrame) -> DataFrame:
    """Delivered pizzas per pizza name."""
    per_pizza = (orders.join(_delivered_by_distance(runs).select("order_id"), on="order_id")
                 .groupBy("pizza_id").agg(F.count("pizza_id").alias("n")))
    return (per_pizza.join(names.select("pizza_id", "pizza_name"), on="pizza_id")
            .groupBy("pizza_name").agg(F.sum("n").alias("total_pizza_order")))


def type_pivot(orders: DataFrame, names: DataFrame, vegetarian: str = VEGETARIAN,
               meatlovers: str = MEATLOVERS) -> DataFrame:
    """Vegetarian and Meatlovers pizzas per customer. Names compare without
    regard to case, as under a case-blind collation."""
    j = orders.join(names, on="pizza_id")
    name = F.upper("pizza_name")
    return j.groupBy("customer_id").agg(
        F.count(F.when(name == vegetarian.upper(), 1)).alias("vegetarian_count"),
        F.count(F.when(name == meatlovers.upper(), 1)).alias("meatlovers_count"),
    )


def max_pizzas_in_order(orders: DataFrame) -> DataFrame:
    """Order(s) with the most pizzas, ties kept (a global rank = 1)."""
    per_order = orders.groupBy("order_id").agg(F.count("pizza_id").alias("total_pizza"))
    return ties_at_max(per_order, None, "total_pizza")


def changes_per_customer(orders: DataFrame) -> DataFrame:
    changed = (F.col("exclusions") != "") | (F.col("extras") != "")
    unchanged = (F.col("exclusions") == "") & (F.col("extras") == "")
    return (orders.groupBy("customer_id")
            .agg(F.count(F.when(changed, 1)).alias("changes"),
                 F.count(F.when(unchanged, 1)).alias("no_changes"))
            .orderBy("customer_id"))


def both_changes(orders: DataFrame, runs: DataFrame) -> DataFrame:
    """As written: the cancellation must be SQL NULL, so runs whose
    cancellation text was cleaned to '' are not counted."""
    r = runs.filter(F.col("cancellation").isNull()).select("order_id")
    return _count_both(orders, r)


def both_changes_fixed(orders: DataFrame, runs: DataFrame) -> DataFrame:
    """Pizzas with exclusions and extras among delivered runs."""
    return _count_both(orders, runs.filter(F.col("is_delivered")).select("order_id"))


def _count_both(orders: DataFrame, run_ids: DataFrame) -> DataFrame:
    both = orders.filter((F.col("exclusions") != "") & (F.col("extras") != ""))
    return both.join(run_ids, on="order_id").agg(F.count(F.lit(1)).alias("new_pizza"))


def hourly_volume(orders: DataFrame) -> DataFrame:
    return (orders.groupBy(F.hour("order_time").cast("bigint").alias("hour_of_day"))
            .agg(F.count("order_id").alias("pizza_count")).orderBy("hour_of_day"))


def hour_of_day(orders: DataFrame) -> DataFrame:
    """The hour of every pizza's order time (the bare projections of A9)."""
    return orders.select(F.hour("order_time").cast("bigint").alias("hour_of_day"))


def weekday_volume(orders: DataFrame, shift_days: int = WEEKDAY_SHIFT_DAYS) -> DataFrame:
    """Pizzas per weekday name of ``order_time + shift_days`` (the case study
    shifts by 2 days, which relabels every weekday; pass 0 for true names)."""
    dow = F.dayofweek(F.date_add(F.to_date("order_time"), shift_days))
    g = orders.groupBy(dow.alias("_dow")).agg(F.count("order_id").alias("total_pizzas_ordered"))
    return g.select(day_name_of("_dow").alias("day_of_week"), "total_pizzas_ordered")


def order_size_ranks(orders: DataFrame, **how) -> DataFrame:
    """Every order ranked by its number of pizzas, the largest first: the whole
    table in one order, where most orders tie with a good part of all others."""
    sizes = orders.groupBy("order_id").agg(F.count("pizza_id").alias("pizzas"))
    return with_ranks(sizes, ["pizzas"], rank="size_rank", dense="size_dense_rank", descending=True, **how)


# ---- B. runner and customer experience ------------------------------------------
def signups_per_week(runners: DataFrame) -> DataFrame:
    return (runners.groupBy(tsql_week("registration_date").alias("registration_week"))
            .agg(F.count("runner_id").alias("no_of_runners")))


def _order_times(orders: DataFrame) -> DataFrame:
    # An order's rows lie together, so the partial aggregate leaves about one row each to exchange.
    return orders.groupBy("order_id", "order_time").agg(F.count("order_time").alias("n_pizza"))


def _delivered_pickups(runs: DataFrame, key: str, carry: tuple[str, ...] = ()) -> DataFrame:
    return (_delivered_by_distance(runs).groupBy(F.col(key).alias("order_id"), "pickup_time", *carry)
            .agg(F.count(F.lit(1)).alias("n_run")))


def _pickup_times(orders: DataFrame, runs: DataFrame, run_key: str,
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per (order_id, order_time, pickup_time, *carry) of the join,
    with the joined row count. Both sides are reduced to distinct tuples
    before the shuffle; the join then yields each combination once."""
    pickups = _delivered_pickups(runs, run_key, carry)
    if run_key != "order_id":
        # Joining on a low-cardinality run column (runner_id, as written) puts
        # all runs under a few keys. Only orders whose id equals such a key can
        # match, so the pizza rows are cut to them before anything shuffles;
        # AQE then sees a tiny side and broadcasts it instead of shuffling the
        # runs into hot keys.
        keys = _delivered_by_distance(runs).select(F.col(run_key).alias("order_id")).distinct()
        orders = orders.join(keys, on="order_id", how="left_semi")
    j = _order_times(orders).join(pickups, on="order_id")
    return j.select(
        "order_id", "order_time", "pickup_time", *carry,
        (F.col("n_pizza") * F.col("n_run")).alias("pizzas_ordered"),
        minute_boundaries("order_time", "pickup_time").cast("bigint").alias("time_taken"),
    )


def pickup_avg(orders: DataFrame, runs: DataFrame, min_minutes: int = MIN_PICKUP_MINUTES) -> DataFrame:
    """As written: orders are joined to runs on ``order_id = runner_id`` and
    one overall average is returned."""
    t = _pickup_times(orders, runs, "runner_id").filter(F.col("time_taken") > min_minutes)
    return t.agg(F.avg("time_taken").alias("avg_time"))


def pickup_avg_fixed(orders: DataFrame, runs: DataFrame, min_minutes: int = MIN_PICKUP_MINUTES) -> DataFrame:
    """Average minutes from order to pickup per runner (join on order_id)."""
    t = _pickup_times(orders, runs, "order_id", carry=("runner_id",)).filter(F.col("time_taken") > min_minutes)
    return t.groupBy("runner_id").agg(F.avg("time_taken").alias("avg_time"))


def prep_vs_size(orders: DataFrame, runs: DataFrame, min_minutes: int = MIN_PICKUP_MINUTES) -> DataFrame:
    """As written (join on ``order_id = runner_id``): average minutes to
    pickup by number of pizzas."""
    t = _pickup_times(orders, runs, "runner_id").filter(F.col("time_taken") > min_minutes)
    return t.groupBy("pizzas_ordered").agg(F.avg("time_taken").alias("avg_time"))


def prep_vs_size_fixed(orders: DataFrame, runs: DataFrame, min_minutes: int = MIN_PICKUP_MINUTES) -> DataFrame:
    t = _pickup_times(orders, runs, "order_id").filter(F.col("time_taken") > min_minutes)
    return t.groupBy("pizzas_ordered").agg(F.avg("time_taken").alias("avg_time"))


def avg_distance(orders: DataFrame, runs: DataFrame) -> DataFrame:
    """Average distance per customer, weighted by pizza rows as written.
    Orders are reduced to (order, customer, pizzas) before the join."""
    per_order = orders.groupBy("order_id", "customer_id").agg(F.count(F.lit(1)).alias("n"))
    j = per_order.join(_delivered_by_distance(runs).select("order_id", "distance"), on="order_id")
    return j.groupBy("customer_id").agg(
        (F.sum(F.col("distance") * F.col("n")) / F.sum("n")).alias("distance"))


def duration_range(runs: DataFrame) -> DataFrame:
    r = runs.filter(F.col("duration") > 0)
    return r.agg((F.max("duration") - F.min("duration")).cast("bigint").alias("time_diff"))


def speed_per_delivery(runs: DataFrame) -> DataFrame:
    """``<km/h rounded to 2 decimals>km/hr`` per runner and order."""
    # a zero duration gives no speed instead of failing the job (ANSI)
    speed = F.avg(F.try_divide(F.col("distance") * 60, F.col("duration")))
    return (_delivered_by_distance(runs).groupBy("runner_id", "order_id")
            .agg(F.concat(rounded_text(speed), F.lit("km/hr")).alias("avg_speed")))


def success_percent(runs: DataFrame) -> DataFrame:
    """As written: ``100 * delivered / runs`` in integer arithmetic (truncated)."""
    ok = F.sum(F.when(F.col("is_delivered"), 1).otherwise(0))
    return runs.groupBy("runner_id").agg(int_div(ok * 100, F.count(F.lit(1))).alias("success_percent"))


def success_percent_fixed(runs: DataFrame) -> DataFrame:
    """Delivered share per runner in percent, rounded half up to a whole number."""
    ok = F.sum(F.when(F.col("is_delivered"), 1).otherwise(0))
    return runs.groupBy("runner_id").agg(round_ratio(ok * 100, F.count(F.lit(1)), 0).alias("success_percent"))


# ---- C. ingredients -----------------------------------------------------------
def recipe_toppings(recipes: DataFrame, toppings: DataFrame, names: DataFrame) -> DataFrame:
    """Standard toppings of each pizza (recipes hold one topping id per row)."""
    j = recipes.join(toppings, recipes.toppings == toppings.topping_id).join(names, on="pizza_id")
    return j.select("pizza_name", "topping_name")


# ---- D. pricing and ratings -----------------------------------------------------
def _order_revenue(orders: DataFrame, price_by_id: dict[int, int], other: int) -> DataFrame:
    """Per order: pizzas, revenue and pizzas with extras (one partial
    aggregate keyed by order_id, which the join below reuses)."""
    return orders.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_price(price_by_id, other)).alias("amount"),
        F.sum(F.when(F.col("extras") != "", 1).otherwise(0)).alias("with_extras"),
    )


def _delivered_revenue(orders, runs, price_by_id, other) -> DataFrame:
    rev = _order_revenue(orders, price_by_id, other)
    return rev.join(_delivered_by_distance(runs).select("order_id", "distance"), on="order_id")


def revenue(orders: DataFrame, runs: DataFrame, price_by_id: dict[int, int] | None = None,
            other: int = OTHER_PIZZA_PRICE) -> DataFrame:
    j = _delivered_revenue(orders, runs, PRICE_BY_PIZZA if price_by_id is None else price_by_id, other)
    return j.agg(F.sum("amount").alias("amount"))


def revenue_with_extras(orders: DataFrame, runs: DataFrame, price_by_id: dict[int, int] | None = None,
                        other: int = OTHER_PIZZA_PRICE, extra_fee: int = EXTRA_FEE) -> DataFrame:
    j = _delivered_revenue(orders, runs, PRICE_BY_PIZZA if price_by_id is None else price_by_id, other)
    total = F.sum("amount") + F.sum("with_extras") * extra_fee
    return j.agg(dollars(total).alias("total"))


def rate_delivered(orders: DataFrame, runs: DataFrame, rating: Column | None = None) -> DataFrame:
    """Ratings table with one row per delivered order; ``rating`` is an
    expression over order_id/runner_id/customer_id (default: 1-5 by order id)."""
    rating = rating if rating is not None else (F.col("order_id") % 5 + 1)
    customers = orders.select("order_id", "customer_id").distinct()
    delivered = runs.filter(F.col("is_delivered")).select("order_id", "runner_id")
    j = delivered.join(customers, on="order_id")
    return j.select(
        F.col("runner_id").cast("bigint").alias("runner_id"),
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        rating.cast("int").alias("rating"),
    )


def ratings_table(spark: SparkSession, rows=None) -> DataFrame:
    """The ratings table loaded from literal rows (the case study's eight)."""
    return spark.createDataFrame(rows if rows is not None else RATINGS_ROWS, RATINGS_SCHEMA)


def order_summary(orders: DataFrame, runs: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row per rated order with times, speed and pizza count.

    Orders are reduced to one row per (order, customer, order_time) with a
    pizza count before the joins; averages are weighted by that count, which
    gives the same result as joining every pizza row.
    """
    per_order = orders.groupBy("order_id", "customer_id", "order_time").agg(
        F.count("pizza_id").alias("n"))
    r = runs.select("order_id", "runner_id", "pickup_time", "duration", "distance")
    j = per_order.join(r, on="order_id").join(ratings.select("order_id", "rating"), on="order_id")
    speed = F.try_divide(60 * F.col("distance"), F.col("duration"))
    keys = ["customer_id", "order_id", "runner_id", "rating", "order_time", "pickup_time", "duration"]
    g = j.groupBy(*keys).agg(
        (F.sum(speed * F.col("n")) / F.sum(F.when(speed.isNotNull(), F.col("n")))).alias("_speed"),
        F.sum("n").alias("num_pizza"),
    )
    return g.select(
        "customer_id", "order_id", "runner_id", "rating", "order_time", "pickup_time",
        minute_boundaries("order_time", "pickup_time").cast("bigint").alias("time_order_pickup"),
        "duration", F.round("_speed", 1).alias("avg_speed"), "num_pizza",
    ).orderBy("customer_id", "order_id")


def profit(orders: DataFrame, runs: DataFrame, price_by_id: dict[int, int] | None = None,
           other: int = OTHER_PIZZA_PRICE, per_km: float = PAY_PER_KM) -> DataFrame:
    """As written: the distance of an order is paid once per pizza row."""
    j = _delivered_revenue(orders, runs, PRICE_BY_PIZZA if price_by_id is None else price_by_id, other)
    left = F.sum("amount") - F.sum(F.col("distance") * F.col("n")) * per_km
    return j.agg(dollars(left, 2).alias("total_price"))


def profit_fixed(orders: DataFrame, runs: DataFrame, price_by_id: dict[int, int] | None = None,
                 other: int = OTHER_PIZZA_PRICE, per_km: float = PAY_PER_KM) -> DataFrame:
    """Revenue minus the runner fee paid once per delivered order."""
    j = _delivered_revenue(orders, runs, PRICE_BY_PIZZA if price_by_id is None else price_by_id, other)
    left = F.sum("amount") - F.sum("distance") * per_km
    return j.agg(dollars(left, 2).alias("total_price"))
