"""Registered queries: each key of SURVEY §2.1 (plus ``*_fixed`` siblings)
maps to ``f(spark, sf_dir) -> DataFrame`` over the whole driver tables.

The fixture stand-ins replace literals that do not occur in the derived
data: special product ``PROMO`` for ``sushi``, points cutoff ``2018-01-01``
for ``2021-02-01``, and the pizza labels ``ASIA`` / ``america`` for
``Vegetarian`` / ``MEATLOVERS``. Everything else uses the case study's
own values (the operator defaults).
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from mercato.functions import dates, numeric, text
from mercato.operators import bank, cleaning, delivery, distinct, loyalty, mart, ranking
from mercato.session import session_key, shared_dir
from mercato.sources import fixtures
from mercato.sources.catalog import Catalog, fingerprint
from mercato.sources.fixtures import Fixtures
from mercato.sources.tables import Tables

# Fixed stand-ins for the fixture data (see FIXTURES.md).
SPECIAL_STAND_IN = "PROMO"
CUTOFF_STAND_IN = "2018-01-01"
VEGETARIAN_STAND_IN = "ASIA"
MEATLOVERS_STAND_IN = "america"


# Source tables the derived tables read; their files key the catalog.
SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
# Modules that hold the derivation rules; their code keys the catalog too.
RULES = (fixtures, bank, cleaning, delivery, distinct, ranking, dates, numeric, text)


def source_key(spark: SparkSession, sf_dir: str) -> str:
    """Fingerprint of the source files and of the derivation rules."""
    tables = Tables(spark, sf_dir)
    return fingerprint(spark, [tables.path(t) for t in SOURCES], [inspect.getsource(m) for m in RULES])


class Inputs:
    """Reference-shaped inputs of one data directory.

    Small projections (menu, members, runners, pizza names...) stay lazy.
    The derived tables that cost joins, windows or parsing are written once
    per data directory (``sources.catalog``) where the session names a shared
    folder, as the case study keeps its cleaned tables; otherwise, or with
    ``materialize`` off, they are lazy plans and nothing is written.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True, key: str | None = None):
        key = key or source_key(spark, sf_dir)
        self.fx = Fixtures(Tables(spark, sf_dir, key))
        self.catalog = Catalog(spark, key) if materialize and shared_dir(spark) else None

    def __getattr__(self, name):
        return getattr(self.fx, name)

    def _kept(self, name: str, build, partition_by=()) -> DataFrame:
        if self.catalog is None:
            return build()
        return self.catalog.table(name, build, partition_by)

    def sales_fact(self) -> DataFrame:
        """The loyalty fact joined once with its menu (a denormalised star), written once."""
        return self._kept("sales_fact", self.fx.sales_fact)

    def sales(self) -> DataFrame:
        return self.sales_fact().select("customer_id", "order_date", "product_id", "l_orderkey", "l_linenumber")

    def priced_sales(self) -> DataFrame:
        return self.sales_fact().where("on_menu").drop("on_menu")

    def orders(self) -> DataFrame:
        return self._kept("customer_orders_clean",
                          lambda: cleaning.clean_customer_orders(self.fx.customer_orders()))

    def runs(self) -> DataFrame:
        return self._kept("runner_orders_clean",
                          lambda: cleaning.clean_runner_orders(self.fx.runner_orders()))

    def ratings(self) -> DataFrame:
        return self._kept("ratings", lambda: delivery.rate_delivered(self.orders(), self.runs()))

    def customer_nodes(self) -> DataFrame:
        return self._kept("customer_nodes", self.fx.customer_nodes)

    def allocation_bitmaps(self) -> DataFrame:
        return self._kept("allocation_bitmaps", lambda: bank.allocation_bitmaps(self.customer_nodes(), self.regions()))

    def region_transactions(self) -> DataFrame:
        return self._kept("region_transactions", self.fx.region_transactions)

    def clean_sales(self) -> DataFrame:
        return self._kept("clean_weekly_sales",
                          lambda: cleaning.clean_weekly_sales(self.fx.weekly_sales()),
                          partition_by=("calendar_year",))

    def prepare(self) -> None:
        """Write every kept table now (otherwise the first query does it).

        Independent tables are written by concurrent jobs. Ratings and bitmaps
        read others of them, so they form a second phase."""
        for phase in ((self.sales_fact, self.orders, self.runs, self.customer_nodes, self.clean_sales, self.region_transactions),
                      (self.ratings, self.allocation_bitmaps)):
            with ThreadPoolExecutor(max_workers=len(phase)) as pool:
                for f in [pool.submit(b) for b in phase]:
                    f.result()


Query = Callable[[SparkSession, str], DataFrame]


# One Inputs per (session, data directory, fingerprint): its opened tables are
# reused by every query of the session until a source file changes.
_INPUTS: dict[tuple[str, str, str], Inputs] = {}


def inputs_for(spark: SparkSession, sf_dir: str) -> Inputs:
    files = source_key(spark, sf_dir)
    key = (session_key(spark), sf_dir, files)
    if key not in _INPUTS:
        _INPUTS[key] = Inputs(spark, sf_dir, key=files)
    return _INPUTS[key]


def _q(fn: Callable[[Inputs], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(inputs_for(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _loyalty() -> dict[str, Query]:
    L = loyalty
    # Statements that begin with sales ⋈ menu read the priced fact (menu=None).
    return {
        "diner_total_spend": _q(lambda i: L.total_spend(i.priced_sales(), None)),
        "diner_visits": _q(lambda i: L.visits(i.sales())),
        "diner_first_item": _q(lambda i: L.first_item(i.sales(), i.menu())),
        "diner_top_item_by_customer": _q(lambda i: L.top_item_by_customer(i.sales(), i.menu(),
                                                                      priced=i.priced_sales())),
        "diner_favourite_item": _q(lambda i: L.favourite_item(i.priced_sales(), None)),
        "diner_first_after_join": _q(lambda i: L.first_after_join(i.priced_sales(), None, i.members())),
        "diner_last_before_join": _q(lambda i: L.last_before_join(i.priced_sales(), None, i.members())),
        "diner_before_join_totals": _q(lambda i: L.before_join_totals(i.priced_sales(), None, i.members())),
        "diner_points": _q(lambda i: L.points(i.priced_sales(), None, special=SPECIAL_STAND_IN)),
        "diner_first_week_points": _q(lambda i: L.first_week_points(
            i.priced_sales(), None, i.members(), special=SPECIAL_STAND_IN, cutoff=CUTOFF_STAND_IN)),
        "diner_membership_flag": _q(lambda i: L.membership_flag(i.priced_sales(), None, i.members())),
        "diner_member_ranking": _q(lambda i: L.member_ranking(i.priced_sales(), None, i.members())),
        "diner_sale_ranks": _q(lambda i: L.sale_ranks(i.sales(), ["l_orderkey", "l_linenumber"])),
    }


def _delivery() -> dict[str, Query]:
    D = delivery
    return {
        "pizza_clean_orders": _q(lambda i: i.orders()),
        "pizza_clean_runs": _q(lambda i: i.runs()),
        "pizza_a1_count": _q(lambda i: D.pizza_count(i.orders())),
        "pizza_a2_orders": _q(lambda i: D.unique_orders(i.orders())),
        "pizza_a3_success": _q(lambda i: D.successful_orders(i.runs())),
        "pizza_a4_by_type": _q(lambda i: D.delivered_by_type(i.orders(), i.runs(), i.pizza_names())),
        "pizza_a5_pivot": _q(lambda i: D.type_pivot(i.orders(), i.pizza_names(),
                                                    VEGETARIAN_STAND_IN, MEATLOVERS_STAND_IN)),
        "pizza_a6_max_order": _q(lambda i: D.max_pizzas_in_order(i.orders())),
        "pizza_a6_order_ranks": _q(lambda i: D.order_size_ranks(i.orders())),
        "pizza_a7_changes": _q(lambda i: D.changes_per_customer(i.orders())),
        "pizza_a8_both": _q(lambda i: D.both_changes(i.orders(), i.runs())),
        "pizza_a8_both_fixed": _q(lambda i: D.both_changes_fixed(i.orders(), i.runs())),
        "pizza_a9_hourly": _q(lambda i: D.hourly_volume(i.orders())),
        "pizza_a9_hour_rows": _q(lambda i: D.hour_of_day(i.orders())),
        "pizza_a10_weekday": _q(lambda i: D.weekday_volume(i.orders())),
        "pizza_a10_weekday_fixed": _q(lambda i: D.weekday_volume(i.orders(), shift_days=0)),
        "pizza_b1_signups": _q(lambda i: D.signups_per_week(i.runners())),
        "pizza_b2_pickup_avg": _q(lambda i: D.pickup_avg(i.orders(), i.runs())),
        "pizza_b2_pickup_avg_fixed": _q(lambda i: D.pickup_avg_fixed(i.orders(), i.runs())),
        "pizza_b3_prep_vs_size": _q(lambda i: D.prep_vs_size(i.orders(), i.runs())),
        "pizza_b3_prep_vs_size_fixed": _q(lambda i: D.prep_vs_size_fixed(i.orders(), i.runs())),
        "pizza_b4_distance": _q(lambda i: D.avg_distance(i.orders(), i.runs())),
        "pizza_b5_range": _q(lambda i: D.duration_range(i.runs())),
        "pizza_b6_speed": _q(lambda i: D.speed_per_delivery(i.runs())),
        "pizza_b7_success_pct": _q(lambda i: D.success_percent(i.runs())),
        "pizza_b7_success_pct_fixed": _q(lambda i: D.success_percent_fixed(i.runs())),
        "pizza_c1_recipe": _q(lambda i: D.recipe_toppings(i.pizza_recipes(), i.pizza_toppings(), i.pizza_names())),
        "pizza_d1_revenue": _q(lambda i: D.revenue(i.orders(), i.runs())),
        "pizza_d2_revenue_extras": _q(lambda i: D.revenue_with_extras(i.orders(), i.runs())),
        "pizza_d3_ratings": _q(lambda i: i.ratings()),
        "pizza_d4_order_summary": _q(lambda i: D.order_summary(i.orders(), i.runs(), i.ratings())),
        "pizza_d5_profit": _q(lambda i: D.profit(i.orders(), i.runs())),
        "pizza_d5_profit_fixed": _q(lambda i: D.profit_fixed(i.orders(), i.runs())),
    }


def _bank() -> dict[str, Query]:
    B = bank
    return {
        "bank_a1_nodes": _q(lambda i: B.distinct_nodes(i.customer_nodes())),
        "bank_a2_nodes_by_region": _q(lambda i: B.nodes_by_region(i.customer_nodes(), i.regions())),
        "bank_a3_customers_by_region": _q(lambda i: B.customers_by_region(i.customer_nodes(), i.regions())),
        "bank_a4_realloc_days": _q(lambda i: B.realloc_avg_days(i.customer_nodes())),
        "bank_a5_realloc_percentiles": _q(lambda i: B.realloc_percentiles(
            i.customer_nodes(), i.regions())),
        "bank_a3_distinct_rollup": _q(lambda i: B.allocation_rollup(i.allocation_bitmaps())),
        "bank_a5_amount_percentiles": _q(lambda i: B.amount_percentiles(i.region_transactions())),
        "bank_b1_txn_totals": _q(lambda i: B.txn_totals(i.customer_transactions())),
        "bank_b2_deposit_avg": _q(lambda i: B.deposit_averages(i.customer_transactions())),
        "bank_b2_exact_amounts": _q(lambda i: B.exact_amounts(i.region_transactions())),
        "bank_b3_active_months": _q(lambda i: B.active_months(i.customer_transactions())),
        "bank_b4_closing_balance": _q(lambda i: B.closing_balance(i.customer_transactions())),
        "bank_b4_running_balance": _q(lambda i: B.running_balance(i.region_transactions())),
        "bank_b5_neighbours": _q(lambda i: B.neighbouring_amounts(i.region_transactions())),
        "bank_b5_growth_pct": _q(lambda i: B.growth_share(i.customer_transactions())),
        "bank_b5_growth_pct_fixed": _q(lambda i: B.growth_share_fixed(i.customer_transactions())),
    }


BONUS_DIMENSIONS = ("region", "platform", "age_band", "demographic", "customer_type")


def _mart() -> dict[str, Query]:
    M = mart
    out: dict[str, Query] = {
        "mart_clean": _q(lambda i: i.clean_sales()),
        "mart_preview": _q(lambda i: M.preview(i.clean_sales())),
        "mart_q1_weekday": _q(lambda i: M.weekday_names(i.clean_sales())),
        "mart_q2_missing_weeks": _q(lambda i: M.missing_weeks(i.clean_sales())),
        "mart_q3_txn_by_year": _q(lambda i: M.txn_by_year(i.clean_sales())),
        "mart_q4_region_month": _q(lambda i: M.sales_by_region_month(i.clean_sales())),
        "mart_q5_platform_rows": _q(lambda i: M.platform_rows(i.clean_sales())),
        "mart_q6_platform_share": _q(lambda i: M.platform_share(i.clean_sales())),
        "mart_q7_demographic_share": _q(lambda i: M.demographic_share(i.clean_sales())),
        "mart_q8_retail_contribution": _q(lambda i: M.retail_contribution(i.clean_sales())),
        "mart_q9_avg_txn": _q(lambda i: M.avg_transaction_size(i.clean_sales())),
        "mart_ba1_4w": _q(lambda i: M.before_after(i.clean_sales(), 4, year=M.BASELINE_YEAR)),
        "mart_ba2_12w": _q(lambda i: M.before_after(i.clean_sales(), 12, year=M.BASELINE_YEAR)),
        "mart_ba3_4w_by_year": _q(lambda i: M.before_after(i.clean_sales(), 4, by=["calendar_year"])),
        "mart_ba3_12w_by_year": _q(lambda i: M.before_after(i.clean_sales(), 12, by=["calendar_year"])),
    }
    for dim in BONUS_DIMENSIONS:
        out[f"mart_bonus_{dim}"] = _q(lambda i, d=dim: M.before_after(i.clean_sales(), 12, by=[d]))
        out[f"mart_bonus_{dim}_fixed"] = _q(
            lambda i, d=dim: M.before_after(i.clean_sales(), 12, by=[d], year=M.BASELINE_YEAR))
    return out


def queries() -> dict[str, Query]:
    return {**_loyalty(), **_delivery(), **_bank(), **_mart()}
