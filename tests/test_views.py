"""Statements written in Spark SQL against the registered views give the
operators' answers."""
from frames import rows
from mercato.operators import bank, delivery, loyalty, mart
from mercato.plans.registry import Inputs
from mercato.plans.views import register_views

SF = "/root/testdata/sf0.001"


def test_sql_on_views_equals_operators(spark):
    names = register_views(spark, SF)
    assert "clean_weekly_sales" in names and "runner_orders" in names
    i = Inputs(spark, SF)
    q1 = spark.sql("""
        SELECT s.customer_id, sum(m.price) AS total_amount
        FROM sales s JOIN menu m ON s.product_id = m.product_id
        GROUP BY s.customer_id ORDER BY total_amount DESC""")
    assert rows(q1) == rows(loyalty.total_spend(i.sales(), i.menu()))
    a3 = spark.sql("""
        SELECT runner_id, count(order_id) AS success_orders
        FROM runner_orders WHERE distance != 0 GROUP BY runner_id""")
    assert rows(a3) == rows(delivery.successful_orders(i.runs()))
    a2 = spark.sql("""
        SELECT r.region_name, count(DISTINCT c.node_id) AS no_of_nodes
        FROM customer_nodes c JOIN regions r ON r.region_id = c.region_id
        GROUP BY r.region_name""")
    assert rows(a2) == rows(bank.nodes_by_region(i.customer_nodes(), i.regions()))
    q3 = spark.sql("""
        SELECT calendar_year, sum(transactions) AS total_transaction
        FROM clean_weekly_sales GROUP BY calendar_year ORDER BY calendar_year""")
    assert rows(q3) == rows(mart.txn_by_year(i.clean_sales()))
    ba = spark.sql("""
        SELECT sum(IF(c.week_number BETWEEN b.w - 4 AND b.w - 1, c.sales, NULL)) AS before_changes,
               sum(IF(c.week_number BETWEEN b.w AND b.w + 3, c.sales, NULL)) AS after_changes
        FROM clean_weekly_sales c
        CROSS JOIN (SELECT DISTINCT week_number AS w FROM clean_weekly_sales
                    WHERE week_date = DATE'2020-06-15') b
        WHERE c.calendar_year = 2020""")
    want = mart.before_after(i.clean_sales(), 4, year=2020).select("before_changes", "after_changes")
    assert rows(ba) == rows(want)
