"""The case-study tables as Spark SQL temp views, under their own names.

Users of the case studies' SQL can run their statements on Spark SQL against
these views (with the dialect fixes of SURVEY §2.3); the operators remain the
tested, scale-reviewed path.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from mercato.plans.registry import Inputs


def register_views(spark: SparkSession, sf_dir: str, materialize: bool = True) -> list[str]:
    """Create or replace temp views for every case-study table; returns their names."""
    i = Inputs(spark, sf_dir, materialize=materialize)
    views = {
        # loyalty
        "sales": i.sales, "menu": i.menu, "members": i.members,
        # delivery: raw (dirty) and cleaned
        "customer_orders_raw": i.customer_orders, "runner_orders_raw": i.runner_orders,
        "customer_orders": i.orders, "runner_orders": i.runs, "runners": i.runners,
        "pizza_names": i.pizza_names, "pizza_toppings": i.pizza_toppings,
        "pizza_recipes": i.pizza_recipes, "ratings": i.ratings,
        # bank
        "regions": i.regions, "customer_nodes": i.customer_nodes,
        "customer_transactions": i.customer_transactions,
        # sales mart: raw and clean
        "weekly_sales": i.weekly_sales, "clean_weekly_sales": i.clean_sales,
    }
    for name, build in views.items():
        build().createOrReplaceTempView(name)
    return list(views)
