"""Reference-shaped input tables derived from the driver's TPC-H-like tables.

The case studies ship no data, so their inputs (sales, menu, members, pizza
orders and runs, bank nodes and transactions, weekly sales) are derived from
``region nation customer supplier part orders lineitem`` with fixed rules.
Every derivation is a lazy DataFrame over the whole tables; nothing is
sampled or capped. The DuckDB oracle derives the same tables in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.dates import shift_years
from mercato.operators.ranking import next_time
from mercato.sources.tables import Tables

# Fixed values of the derivation rules.
YEAR_SHIFT = 20                      # order dates move from 1995-2001 to 2015-2021
MEMBER_EPOCH = "2017-01-01"          # members join on this day + custkey % 365
RUNNER_EPOCH = "2021-01-01"          # runners register on this day + suppkey % 28
OPEN_END = "9999-12-31"              # open customer node
FIRST_WEEK, N_WEEKS = 10, 31         # weekly sales are moved into ISO weeks 10..40 of their ISO year
SEGMENTS = {"BUILDING": "C1", "HOUSEHOLD": "F2", "MACHINERY": "C3", "FURNITURE": "F4"}
CUSTOMER_TYPES = ("New", "Existing", "Guest")  # by c_custkey % 3
SHOPIFY_PRIORITIES = ("4-NOT SPECIFIED", "5-LOW")


def _shifted(col: str) -> Column:
    return shift_years(col, YEAR_SHIFT)


def _plus_seconds(ts: Column, secs: Column) -> Column:
    return F.timestamp_add("SECOND", secs, ts)


def _text(ts: Column) -> Column:
    """Wall-clock text ``yyyy-MM-dd HH:mm:ss`` of a timestamp_ntz value; a
    plain cast, so no session time zone (or DST gap) enters."""
    return ts.cast("timestamp_ntz").cast("string")


class Fixtures:
    def __init__(self, tables: Tables):
        self.t = tables

    # ---- loyalty (week 1) -------------------------------------------------
    def sales(self) -> DataFrame:
        o = self.t.read("orders", "o_orderkey", "o_custkey", "o_orderdate")
        li = self.t.read("lineitem", "l_orderkey", "l_partkey", "l_linenumber")
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.col("o_custkey").alias("customer_id"),
            _shifted("o_orderdate").alias("order_date"),
            F.col("l_partkey").alias("product_id"),
            "l_orderkey", "l_linenumber",
        )

    def sales_fact(self) -> DataFrame:
        """Every sale with its product's name and price (NULL where the menu has none)."""
        menu = self.menu().withColumn("on_menu", F.lit(True))
        return self.sales().join(menu, on="product_id", how="left")

    def menu(self) -> DataFrame:
        return self.t.read("part", "p_partkey", "p_type", "p_size").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_name"),
            F.col("p_size").cast("bigint").alias("price"),
        )

    def members(self) -> DataFrame:
        c = self.t.read("customer", "c_custkey")
        return c.filter(F.col("c_custkey") % 3 != 0).select(
            F.col("c_custkey").alias("customer_id"),
            F.date_add(F.lit(MEMBER_EPOCH).cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("join_date"),
        )

    # ---- delivery (week 2) ------------------------------------------------
    @staticmethod
    def _order_time(o_orderdate: str = "o_orderdate", o_orderkey: str = "o_orderkey") -> Column:
        return _plus_seconds(F.col(o_orderdate), F.col(o_orderkey) * 37 % 86400)

    def customer_orders(self) -> DataFrame:
        """Raw, dirty pizza orders: one row per order line."""
        o = self.t.read("orders", "o_orderkey", "o_custkey", "o_orderdate")
        li = self.t.read("lineitem", "l_orderkey", "l_partkey", "l_quantity",
                         "l_returnflag", "l_linestatus")
        j = li.join(o, li.l_orderkey == o.o_orderkey)
        exclusions = (F.when(F.col("l_returnflag") == "N", "null")
                      .when(F.col("l_returnflag") == "A", "")
                      .when(F.col("l_returnflag") == "R", "2, 6"))
        extras = (F.when(F.col("l_linestatus") == "O", F.lit(None).cast("string"))
                  .when(F.col("l_quantity") < 10, "null")
                  .when(F.col("l_quantity") < 20, "")
                  .otherwise("1"))
        return j.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("l_partkey") % 2 + 1).alias("pizza_id"),
            exclusions.alias("exclusions"),
            extras.alias("extras"),
            _text(self._order_time()).alias("order_time"),
        )

    def runner_orders(self) -> DataFrame:
        """Raw, dirty runs: one row per order; status P means cancelled."""
        o = self.t.read("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        cancelled = F.col("o_orderstatus") == "P"
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        pickup = _text(_plus_seconds(self._order_time(), 30 + c % 1500))
        dist_unit = F.when(k % 3 == 0, "km").when(k % 3 == 1, " km").otherwise("")
        dur_unit = (F.when(k % 4 == 0, " mins").when(k % 4 == 1, "minutes")
                    .when(k % 4 == 2, " minute").otherwise(""))
        cancel_text = F.when(k % 2 == 0, "Restaurant Cancellation").otherwise("Customer Cancellation")
        cancel_other = F.when(k % 3 == 0, "null").when(k % 3 == 1, "").otherwise(F.lit(None).cast("string"))
        return o.select(
            k.alias("order_id"),
            (k % 10 + 1).alias("runner_id"),
            F.when(cancelled, "null").otherwise(pickup).alias("pickup_time"),
            F.when(cancelled, "null").otherwise(F.concat((c % 25 + 1).cast("string"), dist_unit)).alias("distance"),
            F.when(cancelled, "null").otherwise(F.concat((c % 30 + 10).cast("string"), dur_unit)).alias("duration"),
            F.when(cancelled, cancel_text).otherwise(cancel_other).alias("cancellation"),
        )

    def runners(self) -> DataFrame:
        s = self.t.read("supplier", "s_suppkey")
        return s.select(
            F.col("s_suppkey").alias("runner_id"),
            F.date_add(F.lit(RUNNER_EPOCH).cast("date"), (F.col("s_suppkey") % 28).cast("int")).alias("registration_date"),
        )

    def pizza_names(self) -> DataFrame:
        return self.t.read("region", "r_regionkey", "r_name").select(
            F.col("r_regionkey").cast("bigint").alias("pizza_id"), F.col("r_name").alias("pizza_name"))

    def pizza_toppings(self) -> DataFrame:
        return self.t.read("nation", "n_nationkey", "n_name").select(
            F.col("n_nationkey").cast("bigint").alias("topping_id"), F.col("n_name").alias("topping_name"))

    def pizza_recipes(self) -> DataFrame:
        return self.t.read("nation", "n_nationkey", "n_regionkey").select(
            F.col("n_regionkey").cast("bigint").alias("pizza_id"), F.col("n_nationkey").cast("bigint").alias("toppings"))

    # ---- bank (week 4) ----------------------------------------------------
    def regions(self) -> DataFrame:
        return self.t.read("region", "r_regionkey", "r_name").select(
            F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name"))

    def customer_nodes(self) -> DataFrame:
        """One node allocation per order; it ends when the customer's next
        order (by order date, then order key) starts, else stays open."""
        o = self.t.read("orders", "o_orderkey", "o_custkey", "o_orderdate")
        c = self.t.read("customer", "c_custkey", "c_nationkey")
        n = self.t.read("nation", "n_nationkey", "n_regionkey")
        cn = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_regionkey")
        j = o.join(cn, o.o_custkey == cn.c_custkey)
        j = next_time(j, "o_custkey", "o_orderdate", "o_orderkey", "next_orderdate")
        return j.select(
            F.col("o_custkey").alias("customer_id"),
            F.col("n_regionkey").alias("region_id"),
            (F.col("o_orderkey") % 5 + 1).cast("int").alias("node_id"),
            _shifted("o_orderdate").alias("start_date"),
            F.coalesce(_shifted("next_orderdate"), F.lit(OPEN_END).cast("date")).alias("end_date"),
        )

    def customer_transactions(self) -> DataFrame:
        o = self.t.read("orders", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
        kind = (F.when(F.col("o_orderstatus") == "F", "deposit")
                .when(F.col("o_orderstatus") == "O", "purchase")
                .when(F.col("o_orderstatus") == "P", "withdrawal"))
        return o.select(
            F.col("o_custkey").alias("customer_id"),
            _shifted("o_orderdate").alias("txn_date"),
            kind.alias("txn_type"),
            F.round("o_totalprice").cast("bigint").alias("txn_amount"),
        )

    def region_transactions(self) -> DataFrame:
        """Every transaction with its own id and its customer's region: five
        regions, so each holds a fifth of all rows. Withdrawals and purchases
        are signed negative; ``price`` is the amount before rounding."""
        o = self.t.read("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
        c = self.t.read("customer", "c_custkey", "c_nationkey")
        n = self.t.read("nation", "n_nationkey", "n_regionkey")
        r = self.t.read("region", "r_regionkey", "r_name")
        geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
        home = c.join(geo, c.c_nationkey == geo.n_nationkey).select("c_custkey", "r_name")
        amount = F.round("o_totalprice").cast("bigint")
        return o.join(home, o.o_custkey == home.c_custkey).select(
            F.col("r_name").alias("region_name"), F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("txn_id"),
            _shifted("o_orderdate").alias("txn_date"), F.when(F.col("o_orderstatus") == "F", amount).otherwise(-amount).alias("amount"),
            F.col("o_totalprice").cast("double").alias("price"))

    # ---- sales mart (week 5) ----------------------------------------------
    def weekly_sales(self) -> DataFrame:
        """Raw weekly sales: week text ``d/M/yy``, one row per week and cut.

        Every order counts. The case study's year has weeks without sales, so
        an order of ISO week w moves to week FIRST_WEEK + (w - 1) % N_WEEKS of
        the same ISO year."""
        o = self.t.read("orders", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
        c = self.t.read("customer", "c_custkey", "c_nationkey", "c_mktsegment")
        n = self.t.read("nation", "n_nationkey", "n_regionkey")
        r = self.t.read("region", "r_regionkey", "r_name")
        geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
        cust = c.join(geo, c.c_nationkey == geo.n_nationkey)
        j = o.join(cust, o.o_custkey == cust.c_custkey)
        monday = F.date_trunc("week", _shifted("o_orderdate")).cast("date")
        iso_year = F.year(F.date_add(monday, 3))
        first_monday = F.date_trunc("week", F.make_date(iso_year, F.lit(1), F.lit(4))).cast("date")
        week = F.date_add(first_monday, (FIRST_WEEK - 1 + (F.weekofyear(monday) - 1) % N_WEEKS) * 7)
        segment = F.lit("null")
        for name, code in reversed(SEGMENTS.items()):
            segment = F.when(F.col("c_mktsegment") == name, code).otherwise(segment)
        ctype = (F.when(F.col("c_custkey") % 3 == 0, CUSTOMER_TYPES[0])
                 .when(F.col("c_custkey") % 3 == 1, CUSTOMER_TYPES[1])
                 .otherwise(CUSTOMER_TYPES[2]))
        platform = F.when(F.col("o_orderpriority").isin(*SHOPIFY_PRIORITIES), "Shopify").otherwise("Retail")
        g = (j.select(week.alias("wk"), F.col("r_name").alias("region"), platform.alias("platform"),
                      segment.alias("segment"), ctype.alias("customer_type"),
                      F.round("o_totalprice").cast("bigint").alias("amount"))
             .groupBy("wk", "region", "platform", "segment", "customer_type")
             .agg(F.count(F.lit(1)).alias("transactions"), F.sum("amount").alias("sales")))
        return g.select(
            F.date_format("wk", "d/M/yy").alias("week_date"),
            "region", "platform", "segment", "customer_type", "transactions", "sales",
        )
