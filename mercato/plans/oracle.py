"""Independent DuckDB SQL for every registered query.

Each statement derives the case-study inputs from the driver tables with
its own SQL (the same rules as ``sources.fixtures``), then answers the
question in its own DuckDB formulation (QUALIFY, FILTER and HAVING clauses,
USING and ANTI joins), independent of the Spark operators. Views ``region nation
customer supplier part orders lineitem`` are expected to exist.

Comparison rules: integer results are BIGINT (DuckDB sums are HUGEINT),
ratios rounded "to d digits" are computed exactly with integer arithmetic
(``_rr``), and every output column carries the same name as in Spark.
"""

from __future__ import annotations

# Fixed stand-ins, as in plans.registry.
SPECIAL = "PROMO"
CUTOFF = "2018-01-01"
VEG = "ASIA"
MEAT = "america"


def _rr(num: str, den: str, digits: int = 2) -> str:
    """Exact round(num / den, digits), half away from zero, as DOUBLE."""
    s = 10 ** digits
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"NULLIF(CAST(({den}) AS HUGEINT), 0)"
    step = "1" if digits == 0 else f"0.{'0' * (digits - 1)}1"
    whole = f"(sign({n}) * sign({d}) * ((abs({n}) * {2 * s} + abs({d})) // (2 * abs({d}))))"
    # exact decimal, then its text to DOUBLE (correctly rounded at any size)
    return f"CAST(CAST(CAST({whole} AS DECIMAL(38, 0)) * {step} AS VARCHAR) AS DOUBLE)"


def _d(col: str) -> str:
    return f"CAST({col} + INTERVAL 20 YEAR AS DATE)"


ADAPTERS = f"""
sales AS (
  SELECT o.o_custkey AS customer_id, {_d('o.o_orderdate')} AS order_date,
         l.l_partkey AS product_id, l.l_orderkey, l.l_linenumber
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
menu AS (
  SELECT p_partkey AS product_id, p_type AS product_name, CAST(p_size AS BIGINT) AS price FROM part),
members AS (
  SELECT c_custkey AS customer_id, DATE '2017-01-01' + CAST(c_custkey % 365 AS INTEGER) AS join_date
  FROM customer WHERE c_custkey % 3 <> 0),
co_raw AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey % 2 + 1 AS pizza_id,
    CASE l.l_returnflag WHEN 'N' THEN 'null' WHEN 'A' THEN '' WHEN 'R' THEN '2, 6' END AS exclusions,
    CASE WHEN l.l_linestatus = 'O' THEN NULL WHEN l.l_quantity < 10 THEN 'null'
         WHEN l.l_quantity < 20 THEN '' ELSE '1' END AS extras,
    strftime(o.o_orderdate + to_seconds(o.o_orderkey * 37 % 86400), '%Y-%m-%d %H:%M:%S') AS order_time
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
co AS (
  SELECT order_id, customer_id, pizza_id,
    if(exclusions = 'null', '', exclusions) AS exclusions,
    coalesce(nullif(extras, 'null'), '') AS extras,
    CAST(order_time AS TIMESTAMP) AS order_time
  FROM co_raw),
ro_raw AS (
  SELECT o_orderkey AS order_id, o_orderkey % 10 + 1 AS runner_id,
    CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE strftime(o_orderdate + to_seconds(o_orderkey * 37 % 86400)
         + to_seconds(30 + o_custkey % 1500), '%Y-%m-%d %H:%M:%S') END AS pickup_time,
    CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE CAST(o_custkey % 25 + 1 AS VARCHAR)
         || CASE o_orderkey % 3 WHEN 0 THEN 'km' WHEN 1 THEN ' km' ELSE '' END END AS distance,
    CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE CAST(o_custkey % 30 + 10 AS VARCHAR)
         || CASE o_orderkey % 4 WHEN 0 THEN ' mins' WHEN 1 THEN 'minutes' WHEN 2 THEN ' minute' ELSE '' END END AS duration,
    CASE WHEN o_orderstatus = 'P'
         THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Restaurant Cancellation' ELSE 'Customer Cancellation' END
         ELSE CASE o_orderkey % 3 WHEN 0 THEN 'null' WHEN 1 THEN '' ELSE NULL END END AS cancellation
  FROM orders),
ro AS (
  -- the number in front of the dirty texts, thousands separators taken out
  SELECT order_id, runner_id,
    TRY_CAST(nullif(pickup_time, 'null') AS TIMESTAMP) AS pickup_time,
    TRY_CAST(replace(regexp_extract(trim(distance), '^[-+]?[0-9.,]+'), ',', '') AS DOUBLE) AS distance,
    TRY_CAST(replace(regexp_extract(trim(duration), '^[-+]?[0-9,]+'), ',', '') AS INTEGER) AS duration,
    if(cancellation IN ('null', ''), '', cancellation) AS cancellation,
    coalesce(TRY_CAST(replace(regexp_extract(trim(distance), '^[-+]?[0-9.,]+'), ',', '') AS DOUBLE), 0) <> 0
      AS is_delivered
  FROM ro_raw),
runners AS (
  SELECT s_suppkey AS runner_id, DATE '2021-01-01' + CAST(s_suppkey % 28 AS INTEGER) AS registration_date
  FROM supplier),
pizza_names AS (SELECT CAST(r_regionkey AS BIGINT) AS pizza_id, r_name AS pizza_name FROM region),
pizza_toppings AS (SELECT CAST(n_nationkey AS BIGINT) AS topping_id, n_name AS topping_name FROM nation),
pizza_recipes AS (SELECT CAST(n_regionkey AS BIGINT) AS pizza_id, CAST(n_nationkey AS BIGINT) AS toppings FROM nation),
ratings AS (
  SELECT r.runner_id, r.order_id, c.customer_id, CAST(r.order_id % 5 + 1 AS INTEGER) AS rating
  FROM ro r JOIN (SELECT DISTINCT order_id, customer_id FROM co) c ON r.order_id = c.order_id
  WHERE r.is_delivered),
regions AS (SELECT r_regionkey AS region_id, r_name AS region_name FROM region),
customer_nodes AS (
  SELECT o.o_custkey AS customer_id, n.n_regionkey AS region_id,
    CAST(o.o_orderkey % 5 + 1 AS INTEGER) AS node_id,
    {_d('o.o_orderdate')} AS start_date,
    COALESCE({_d('LEAD(o.o_orderdate) OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey)')},
             DATE '9999-12-31') AS end_date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
customer_transactions AS (
  SELECT o_custkey AS customer_id, {_d('o_orderdate')} AS txn_date,
    CASE o_orderstatus WHEN 'F' THEN 'deposit' WHEN 'O' THEN 'purchase' WHEN 'P' THEN 'withdrawal' END AS txn_type,
    CAST(round(o_totalprice) AS BIGINT) AS txn_amount
  FROM orders),
weekly_sales AS (
  SELECT strftime(wk, '%-d/%-m/%y') AS week_date, region, platform, segment, customer_type,
         COUNT(*) AS transactions, CAST(SUM(amount) AS BIGINT) AS sales
  FROM (
    -- every order moves to ISO week 10 + (week - 1) % 31 of its ISO year
    SELECT CAST(date_trunc('week', make_date(isoyear({_d('o.o_orderdate')}), 1, 4)) AS DATE)
        + CAST(7 * (9 + (weekofyear({_d('o.o_orderdate')}) - 1) % 31) AS INTEGER) AS wk,
      r.r_name AS region,
      CASE WHEN o.o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'Shopify' ELSE 'Retail' END AS platform,
      CASE c.c_mktsegment WHEN 'BUILDING' THEN 'C1' WHEN 'HOUSEHOLD' THEN 'F2' WHEN 'MACHINERY' THEN 'C3'
           WHEN 'FURNITURE' THEN 'F4' ELSE 'null' END AS segment,
      CASE c.c_custkey % 3 WHEN 0 THEN 'New' WHEN 1 THEN 'Existing' ELSE 'Guest' END AS customer_type,
      CAST(round(o.o_totalprice) AS BIGINT) AS amount
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey) t
  GROUP BY wk, region, platform, segment, customer_type),
cws AS (
  SELECT d AS week_date, CAST(weekofyear(d) AS BIGINT) AS week_number, CAST(month(d) AS BIGINT) AS month_number,
    CAST(year(d) AS BIGINT) AS calendar_year, region, platform, segment, customer_type,
    coalesce(MAP {{'1': 'Young Adults', '2': 'Middle Aged', '3': 'Retirees', '4': 'Retirees'}}[right(segment, 1)],
             'unknown') AS age_band,
    coalesce(MAP {{'C': 'Couples', 'F': 'Families'}}[left(segment, 1)], 'unknown') AS demographic,
    transactions, sales, {_rr('sales', 'transactions', 2)} AS avg_transaction
  FROM (SELECT *, CAST(strptime(week_date, '%d/%m/%y') AS DATE) AS d FROM weekly_sales) w)"""


def _sql(body: str, ctes: str = "") -> str:
    extra = f",\n{ctes}" if ctes else ""
    return f"WITH {ADAPTERS.strip()}{extra}\n{body.strip()}"


# ---- loyalty -----------------------------------------------------------------------------
_flags = """
flagged AS (
  SELECT customer_id, order_date, product_name, price,
    CASE WHEN coalesce(order_date >= join_date, false) THEN 'Y' ELSE 'N' END AS membership
  FROM sales JOIN menu USING (product_id) LEFT JOIN members USING (customer_id))"""

LOYALTY = {
    "diner_total_spend": _sql("""
SELECT customer_id, CAST(sum(price) AS BIGINT) AS total_amount
FROM sales JOIN menu USING (product_id) GROUP BY customer_id"""),
    "diner_visits": _sql("""
SELECT customer_id, count(DISTINCT order_date) AS visits FROM sales GROUP BY customer_id"""),
    "diner_first_item": _sql("""
SELECT customer_id, product_name AS first_product
FROM (SELECT customer_id, product_id FROM sales
      QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date, product_id) = 1) f
JOIN menu USING (product_id)"""),
    "diner_top_item_by_customer": _sql("""
SELECT customer_id, product_name, count(*) AS purchase_count
FROM sales JOIN best USING (product_id) JOIN menu USING (product_id)
GROUP BY customer_id, product_name""", """
best AS (SELECT product_id FROM sales JOIN menu USING (product_id)
         GROUP BY product_id ORDER BY count(*) DESC, product_id LIMIT 1)"""),
    "diner_favourite_item": _sql("""
SELECT customer_id, product_name, count(product_id) AS order_count
FROM sales JOIN menu USING (product_id)
GROUP BY customer_id, product_name
QUALIFY rank() OVER (PARTITION BY customer_id ORDER BY count(product_name) DESC) = 1"""),
    "diner_first_after_join": _sql("""
SELECT customer_id, join_date, order_date, product_name
FROM sales JOIN members USING (customer_id) JOIN menu USING (product_id)
WHERE order_date >= join_date
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date, product_id) = 1"""),
    "diner_last_before_join": _sql("""
SELECT customer_id, join_date, order_date, product_name
FROM sales JOIN members USING (customer_id) JOIN menu USING (product_id)
WHERE order_date < join_date
QUALIFY order_date = max(order_date) OVER (PARTITION BY customer_id)"""),
    "diner_before_join_totals": _sql("""
SELECT customer_id, count(product_id) AS total_item, CAST(sum(price) AS BIGINT) AS total_amount
FROM sales JOIN members USING (customer_id) JOIN menu USING (product_id)
WHERE order_date < join_date GROUP BY customer_id"""),
    "diner_points": _sql(f"""
SELECT customer_id, CAST(sum(price * if(product_name = '{SPECIAL}', 20, 10)) AS BIGINT) AS total_points
FROM sales JOIN menu USING (product_id) GROUP BY customer_id"""),
    "diner_first_week_points": _sql(f"""
SELECT customer_id,
  CAST(sum(price * if(product_name = '{SPECIAL}' OR date_diff('day', join_date, order_date) BETWEEN 0 AND 6, 20, 10))
       AS BIGINT) AS reward_points
FROM sales JOIN members USING (customer_id) JOIN menu USING (product_id)
WHERE order_date < DATE '{CUTOFF}' GROUP BY customer_id"""),
    "diner_membership_flag": _sql("SELECT * FROM flagged", _flags),
    "diner_sale_ranks": _sql("""
SELECT customer_id, order_date, product_id, l_orderkey, l_linenumber,
  rank() OVER w AS day_rank, dense_rank() OVER w AS day_dense_rank
FROM sales WINDOW w AS (PARTITION BY customer_id ORDER BY order_date DESC)"""),
    "diner_member_ranking": _sql("""
SELECT customer_id, order_date, product_name, price, membership,
  CAST(if(membership = 'Y', dense_rank() OVER (PARTITION BY customer_id, membership ORDER BY order_date), NULL)
       AS BIGINT) AS ranking
FROM flagged""", _flags),
}

# ---- delivery -------------------------------------------------------------------------------
_DELIVERED = "ro.distance <> 0"


def _pickup_minutes(key: str, extra: str = "") -> str:
    """Distinct (order, order time, pickup time) of the pizza/run join, with minutes."""
    return f"""
SELECT co.order_id, co.order_time, ro.pickup_time, {extra}
  count(co.order_time) AS n, date_diff('minute', co.order_time, ro.pickup_time) AS mins
FROM co JOIN ro ON co.order_id = ro.{key}
WHERE {_DELIVERED}
GROUP BY ALL"""


DELIVERY = {
    "pizza_clean_orders": _sql("SELECT * FROM co"),
    "pizza_clean_runs": _sql("SELECT * FROM ro"),
    "pizza_a1_count": _sql("SELECT count(*) AS pizza_orders_count FROM co"),
    "pizza_a2_orders": _sql("SELECT count(DISTINCT order_id) AS unique_order FROM co"),
    "pizza_a3_success": _sql("""
SELECT runner_id, CAST(count_if(distance <> 0) AS BIGINT) AS success_orders
FROM ro GROUP BY runner_id HAVING count_if(distance <> 0) > 0"""),
    "pizza_a4_by_type": _sql(f"""
SELECT pizza_name, count(*) AS total_pizza_order
FROM co JOIN ro USING (order_id) JOIN pizza_names USING (pizza_id)
WHERE {_DELIVERED} GROUP BY 1"""),
    "pizza_a5_pivot": _sql(f"""
SELECT customer_id,
  count(*) FILTER (WHERE pizza_name ILIKE '{VEG}') AS vegetarian_count,
  count(*) FILTER (WHERE pizza_name ILIKE '{MEAT}') AS meatlovers_count
FROM co JOIN pizza_names USING (pizza_id) GROUP BY customer_id"""),
    "pizza_a6_max_order": _sql("""
SELECT order_id, count(pizza_id) AS total_pizza FROM co GROUP BY order_id
QUALIFY total_pizza = max(total_pizza) OVER ()"""),
    "pizza_a6_order_ranks": _sql("""
SELECT order_id, pizzas, rank() OVER w AS size_rank, dense_rank() OVER w AS size_dense_rank
FROM (SELECT order_id, count(pizza_id) AS pizzas FROM co GROUP BY order_id) WINDOW w AS (ORDER BY pizzas DESC)"""),
    "pizza_a7_changes": _sql("""
SELECT customer_id,
  count(*) FILTER (WHERE exclusions <> '' OR extras <> '') AS changes,
  count(*) FILTER (WHERE exclusions = '' AND extras = '') AS no_changes
FROM co GROUP BY customer_id"""),
    "pizza_a8_both": _sql("""
SELECT count(*) AS new_pizza FROM co JOIN ro USING (order_id)
WHERE exclusions <> '' AND extras <> '' AND cancellation IS NULL"""),
    "pizza_a8_both_fixed": _sql("""
SELECT count(*) AS new_pizza FROM co JOIN ro USING (order_id)
WHERE exclusions <> '' AND extras <> '' AND is_delivered"""),
    "pizza_a9_hourly": _sql("""
SELECT CAST(extract(hour FROM order_time) AS BIGINT) AS hour_of_day, count(order_id) AS pizza_count
FROM co GROUP BY 1"""),
    "pizza_a9_hour_rows": _sql("SELECT CAST(hour(order_time) AS BIGINT) AS hour_of_day FROM co"),
    "pizza_a10_weekday": _sql("""
SELECT strftime(order_time + INTERVAL 2 DAY, '%A') AS day_of_week, count(order_id) AS total_pizzas_ordered
FROM co GROUP BY 1"""),
    "pizza_a10_weekday_fixed": _sql("""
SELECT strftime(order_time, '%A') AS day_of_week, count(order_id) AS total_pizzas_ordered
FROM co GROUP BY 1"""),
    # %U numbers Sunday-started weeks from 0 before the first Sunday; week 1
    # must hold January 1, so years not starting on a Sunday are shifted by one.
    "pizza_b1_signups": _sql("""
SELECT CAST(CAST(strftime(registration_date, '%U') AS INTEGER)
            + if(dayofweek(date_trunc('year', registration_date)) = 0, 0, 1) AS BIGINT) AS registration_week,
       count(runner_id) AS no_of_runners
FROM runners GROUP BY 1"""),
    "pizza_b2_pickup_avg": _sql("SELECT avg(mins) AS avg_time FROM p WHERE mins > 1",
                                "p AS (" + _pickup_minutes("runner_id") + ")"),
    "pizza_b2_pickup_avg_fixed": _sql(
        "SELECT runner_id, avg(mins) AS avg_time FROM p WHERE mins > 1 GROUP BY runner_id",
        "p AS (" + _pickup_minutes("order_id", "ro.runner_id,") + ")"),
    "pizza_b3_prep_vs_size": _sql(
        "SELECT n AS pizzas_ordered, avg(mins) AS avg_time FROM p WHERE mins > 1 GROUP BY n",
        "p AS (" + _pickup_minutes("runner_id") + ")"),
    "pizza_b3_prep_vs_size_fixed": _sql(
        "SELECT n AS pizzas_ordered, avg(mins) AS avg_time FROM p WHERE mins > 1 GROUP BY n",
        "p AS (" + _pickup_minutes("order_id") + ")"),
    "pizza_b4_distance": _sql(f"""
SELECT customer_id, avg(distance) AS distance FROM co JOIN ro USING (order_id)
WHERE {_DELIVERED} GROUP BY customer_id"""),
    "pizza_b5_range": _sql("""
SELECT CAST(max(duration) - min(duration) AS BIGINT) AS time_diff FROM ro WHERE duration > 0"""),
    "pizza_b6_speed": _sql("""
SELECT runner_id, order_id,
  rtrim(rtrim(printf('%.2f', round(avg(60 * distance / duration), 2)), '0'), '.') || 'km/hr' AS avg_speed
FROM ro WHERE distance <> 0 GROUP BY runner_id, order_id"""),
    "pizza_b7_success_pct": _sql("""
SELECT runner_id, CAST(100 * count_if(coalesce(distance, 0) <> 0) // count(*) AS BIGINT) AS success_percent
FROM ro GROUP BY runner_id"""),
    "pizza_b7_success_pct_fixed": _sql("""
SELECT runner_id, round(100.0 * count_if(coalesce(distance, 0) <> 0) / count(*)) AS success_percent
FROM ro GROUP BY runner_id"""),
    "pizza_c1_recipe": _sql("""
SELECT pizza_name, topping_name
FROM pizza_recipes JOIN pizza_toppings ON topping_id = toppings JOIN pizza_names USING (pizza_id)"""),
    "pizza_d1_revenue": _sql(f"""
SELECT CAST(sum(if(pizza_id = 1, 12, 10)) AS BIGINT) AS amount
FROM co JOIN ro USING (order_id) WHERE {_DELIVERED}"""),
    "pizza_d2_revenue_extras": _sql(f"""
SELECT printf('$%d', CAST(sum(if(pizza_id = 1, 12, 10)) + count_if(extras <> '') AS BIGINT)) AS total
FROM co JOIN ro USING (order_id) WHERE {_DELIVERED}"""),
    "pizza_d3_ratings": _sql("SELECT * FROM ratings"),
    "pizza_d4_order_summary": _sql("""
SELECT customer_id, order_id, runner_id, rating, order_time, pickup_time,
  date_diff('minute', order_time, pickup_time) AS time_order_pickup, duration, avg_speed, num_pizza
FROM baskets JOIN trips USING (order_id) JOIN (SELECT order_id, rating FROM ratings) given USING (order_id)""", """
baskets AS (SELECT order_id, customer_id, order_time, count(pizza_id) AS num_pizza FROM co GROUP BY ALL),
trips AS (SELECT order_id, runner_id, pickup_time, duration, round(60 * distance / duration, 1) AS avg_speed FROM ro)"""),
    "pizza_d5_profit": _sql(f"""
SELECT '$' || rtrim(rtrim(CAST(CAST(round(sum(if(pizza_id = 1, 12, 10)) - 0.30 * sum(distance), 2)
  AS DECIMAL(38, 2)) AS VARCHAR), '0'), '.') AS total_price
FROM co JOIN ro USING (order_id) WHERE {_DELIVERED}"""),
    "pizza_d5_profit_fixed": _sql("""
SELECT '$' || rtrim(rtrim(CAST(CAST(round(sum(rev) - 0.30 * sum(distance), 2) AS DECIMAL(38, 2)) AS VARCHAR),
  '0'), '.') AS total_price
FROM (SELECT order_id, sum(if(pizza_id = 1, 12, 10)) AS rev FROM co GROUP BY order_id) o
JOIN ro USING (order_id) WHERE distance <> 0"""),
}

# ---- bank -------------------------------------------------------------------------------------
_monthly = """
monthly AS (
  SELECT customer_id, CAST(month(txn_date) AS BIGINT) AS month,
    sum(if(txn_type = 'deposit', txn_amount, -txn_amount)) AS net
  FROM customer_transactions GROUP BY ALL)"""


def _growth(balance: str, denom: str) -> str:
    return _sql(f"""
SELECT 100 * count(DISTINCT customer_id) FILTER (WHERE pct > 5)
       / (SELECT count(DISTINCT customer_id) FROM customer_transactions)::DOUBLE AS percentage_customer
FROM (SELECT customer_id,
        100 * (bal - lag(bal) OVER w) / nullif({denom}, 0) AS pct
      FROM (SELECT customer_id, month, {balance} AS bal FROM monthly) b
      WINDOW w AS (PARTITION BY customer_id ORDER BY month)) g""", _monthly)


# Every transaction with its region; purchases and withdrawals negative.
_region_txns = f"""
rt AS (
  SELECT r.r_name AS region_name, o.o_orderkey AS txn_id, {_d('o.o_orderdate')} AS txn_date, CAST(o.o_totalprice AS DOUBLE) AS price,
    CAST(if(o.o_orderstatus = 'F', round(o.o_totalprice), -round(o.o_totalprice)) AS BIGINT) AS amount
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _percentile(p: float, name: str) -> str:
    """percentile_cont by its definition, from numbered rows (i from 0, n in all)."""
    at = f"(CAST({p} AS DOUBLE) * (n - 1))"
    low, high = (f"max(price) FILTER (i = {f}{at})" for f in ("floor", "ceil"))
    part = f"max({at} - floor{at})"
    return f"CASE WHEN {low} = {high} THEN {low} ELSE {low} * (1 - {part}) + {high} * {part} END AS {name}"


BANK = {
    "bank_a1_nodes": _sql("SELECT count(DISTINCT node_id) AS nodes FROM customer_nodes"),
    "bank_a2_nodes_by_region": _sql("""
SELECT region_name, count(DISTINCT node_id) AS no_of_nodes
FROM customer_nodes JOIN regions USING (region_id) GROUP BY region_name"""),
    "bank_a3_customers_by_region": _sql("""
SELECT region_name, count(DISTINCT customer_id) AS no_of_customers
FROM customer_nodes JOIN regions USING (region_id) GROUP BY region_name"""),
    "bank_a4_realloc_days": _sql("""
SELECT round(avg(date_diff('day', start_date, end_date))) AS reallocation_avg_time
FROM customer_nodes WHERE end_date <> DATE '9999-12-31'"""),
    "bank_a5_realloc_percentiles": _sql("""
SELECT region_name, q[1] AS median, q[2] AS percentile_80th, q[3] AS percentile_95th
FROM (SELECT region_name, quantile_cont(date_diff('day', start_date, end_date), [0.5, 0.8, 0.95]) AS q
      FROM customer_nodes JOIN regions USING (region_id)
      WHERE end_date <> DATE '9999-12-31' GROUP BY region_name) t"""),
    "bank_a3_distinct_rollup": _sql("""
SELECT region_name, CAST(year(start_date) AS INTEGER) AS start_year,
  CAST(CASE grouping(region_name, year(start_date)) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS INTEGER) AS level,
  count(DISTINCT customer_id) AS no_of_customers, count(DISTINCT node_id) AS no_of_nodes
FROM customer_nodes JOIN regions USING (region_id) GROUP BY CUBE (region_name, year(start_date))"""),
    "bank_a5_amount_percentiles": _sql(f"""
SELECT region_name, {_percentile(0.5, 'median')}, {_percentile(0.8, 'percentile_80th')}, {_percentile(0.95, 'percentile_95th')}
FROM (SELECT region_name, price, count(*) OVER (PARTITION BY region_name) AS n,
        row_number() OVER (PARTITION BY region_name ORDER BY price) - 1 AS i FROM rt)
GROUP BY region_name""", _region_txns),
    # Units of 2 ** -64 hold every bit of an amount; their sum is a whole number.
    "bank_b2_exact_amounts": _sql("""
SELECT region_name, whole + part AS total, (whole + part) / n AS average
FROM (SELECT region_name, n, CAST(units // 18446744073709551616 AS DOUBLE) AS whole,
             CAST(units % 18446744073709551616 AS DOUBLE) / 18446744073709551616.0 AS part
      FROM (SELECT region_name, count(price) AS n, sum(CAST(price * 18446744073709551616.0::DOUBLE AS HUGEINT)) AS units
            FROM rt GROUP BY region_name))""", _region_txns),
    "bank_b4_running_balance": _sql("""
SELECT region_name, txn_id, txn_date, amount,
  CAST(sum(amount) OVER (PARTITION BY region_name ORDER BY txn_date) AS BIGINT) AS balance
FROM rt""", _region_txns),
    "bank_b5_neighbours": _sql("""
SELECT region_name, txn_id, txn_date, amount, lag(amount) OVER w AS previous, lag(amount, 3, 0) OVER w AS third_before,
  lead(amount) OVER w AS next
FROM rt WINDOW w AS (PARTITION BY region_name ORDER BY txn_date, txn_id)""", _region_txns),
    "bank_b1_txn_totals": _sql("""
SELECT txn_type, count(txn_type) AS txn_type_count,
  '$ ' || format('{:,}', CAST(sum(txn_amount) AS BIGINT)) AS total_amount
FROM customer_transactions GROUP BY txn_type"""),
    "bank_b2_deposit_avg": _sql("""
SELECT round(avg(n)) AS deposit_count, '$' || CAST(round(avg(a), 2) AS DECIMAL(38, 2)) AS deposit_amt
FROM (SELECT customer_id, count(*) AS n, avg(txn_amount) AS a FROM customer_transactions
      WHERE txn_type = 'deposit' GROUP BY customer_id) d"""),
    "bank_b3_active_months": _sql("""
SELECT upper(monthname(make_date(2000, m, 1))) AS month_name, count(*) AS customer_count
FROM (SELECT customer_id, month(txn_date) AS m FROM customer_transactions GROUP BY customer_id, m
      HAVING count_if(txn_type = 'deposit') > 1
         AND (count_if(txn_type = 'withdrawal') = 1 OR count_if(txn_type = 'purchase') = 1)) a
GROUP BY m"""),
    "bank_b4_closing_balance": _sql("""
SELECT customer_id, month, CAST(sum(net) OVER (PARTITION BY customer_id ORDER BY month) AS BIGINT) AS closing_balance
FROM monthly""", _monthly),
    # as written the "closing balance" is partitioned by customer and month: the monthly net
    "bank_b5_growth_pct": _growth("net", "lag(bal) OVER w"),
    "bank_b5_growth_pct_fixed": _growth("sum(net) OVER (PARTITION BY customer_id ORDER BY month)",
                                        "abs(lag(bal) OVER w)"),
}

# ---- sales mart -----------------------------------------------------------------------------------


def _pct_of_total(part: str) -> str:
    return _rr(f"100 * sum(sales) FILTER (WHERE {part})", "sum(sales)", 2)


def _before_after(n: int, by: str | None, year: int | None) -> str:
    keys = f"{by}, " if by else ""
    where = f"WHERE calendar_year = {year}" if year is not None else ""
    group = f"GROUP BY {by}" if by else ""
    return _sql(f"""
SELECT {keys}before_changes, after_changes,
  {_rr('100 * (after_changes - before_changes)', 'before_changes', 2)} AS pct_change
FROM (
  SELECT {keys}
    CAST(sum(sales) FILTER (WHERE week_number BETWEEN base - {n} AND base - 1) AS BIGINT) AS before_changes,
    CAST(sum(sales) FILTER (WHERE week_number BETWEEN base AND base + {n - 1}) AS BIGINT) AS after_changes
  FROM cws, (SELECT DISTINCT week_number AS base FROM cws WHERE week_date = DATE '2020-06-15') b
  {where} {group}) t""")


MART = {
    "mart_clean": _sql("SELECT * FROM cws"),
    "mart_preview": _sql("""
SELECT * FROM cws ORDER BY week_date, region, platform, segment, customer_type LIMIT 10"""),
    "mart_q1_weekday": _sql("SELECT DISTINCT upper(strftime(week_date, '%A')) AS day_of_week FROM cws"),
    "mart_q2_missing_weeks": _sql("""
SELECT w AS missing_week_numbers
FROM range(1, 54) t(w) ANTI JOIN (SELECT DISTINCT week_number FROM cws) s ON t.w = s.week_number"""),
    "mart_q3_txn_by_year": _sql("""
SELECT calendar_year, CAST(sum(transactions) AS BIGINT) AS total_transaction FROM cws GROUP BY 1"""),
    "mart_q4_region_month": _sql("""
SELECT region, strftime(week_date, '%B') AS months, CAST(sum(sales) AS BIGINT) AS total_sales
FROM cws GROUP BY 1, 2"""),
    "mart_q5_platform_rows": _sql("""
SELECT platform, count(transactions) AS total_no_transaction FROM cws GROUP BY 1"""),
    "mart_q6_platform_share": _sql(f"""
SELECT calendar_year, upper(strftime(week_date, '%B')) AS months,
  {_pct_of_total("platform = 'Retail'")} AS retail_sales,
  {_pct_of_total("platform = 'Shopify'")} AS shopify_sales
FROM cws GROUP BY 1, 2"""),
    "mart_q7_demographic_share": _sql(f"""
SELECT calendar_year,
  {_pct_of_total("demographic = 'Couples'")} AS couple_sales,
  {_pct_of_total("demographic = 'Families'")} AS family_sales,
  {_pct_of_total("demographic = 'unknown'")} AS unknown_sales
FROM cws GROUP BY 1"""),
    "mart_q8_retail_contribution": _sql(f"""
SELECT age_band, demographic, CAST(sum(sales) AS BIGINT) AS subtotal,
  {_rr('100 * sum(sales)', 'sum(sum(sales)) OVER ()', 2)} AS percentage_contribution
FROM cws WHERE platform = 'Retail' GROUP BY 1, 2"""),
    "mart_q9_avg_txn": _sql(f"""
SELECT calendar_year, platform,
  {_rr('sum(CAST(round(avg_transaction * 100) AS BIGINT))', '100 * count(avg_transaction)', 2)}
    AS avg_avg_transactions,
  {_rr('sum(sales)', 'sum(transactions)', 2)} AS proper_avg_transactions
FROM cws GROUP BY 1, 2"""),
    "mart_ba1_4w": _before_after(4, None, 2020),
    "mart_ba2_12w": _before_after(12, None, 2020),
    "mart_ba3_4w_by_year": _before_after(4, "calendar_year", None),
    "mart_ba3_12w_by_year": _before_after(12, "calendar_year", None),
}
for _dim in ("region", "platform", "age_band", "demographic", "customer_type"):
    MART[f"mart_bonus_{_dim}"] = _before_after(12, _dim, None)
    MART[f"mart_bonus_{_dim}_fixed"] = _before_after(12, _dim, 2020)


def oracle_sql() -> dict[str, str]:
    return {**LOYALTY, **DELIVERY, **BANK, **MART}
