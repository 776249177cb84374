"""A customer holding a third of all sales: results equal the plain window
formulation, and each join on the customer either is split by AQE or takes
rows that are already reduced to a customer's days."""
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from frames import rows
from mercato.operators import loyalty as L

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _data(spark, n=60000):
    sales = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 197 + 1).alias("customer_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("order_date"),
        (F.col("id") % 50).alias("product_id"))
    menu = spark.range(50).select(F.col("id").alias("product_id"),
                                  F.concat(F.lit("p"), F.col("id")).alias("product_name"),
                                  (F.col("id") % 9 + 1).alias("price"))
    members = spark.range(198).select(F.col("id").alias("customer_id"),
                                      F.lit("2021-01-01").cast("date").alias("join_date"))
    return sales, menu, members


def _customer_joins(df):
    """For each sort-merge join on customer_id alone in the final plan: whether
    it is split for skew, and whether an aggregate feeds its left side."""
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].split("\n")
    depth = [m.start() if (m := re.search(r"[+:]- ", x)) else -1 for x in lines]
    out = []
    for i, x in enumerate(lines):
        if re.search(r"SortMergeJoin(\(skew=true\))? \[customer_id#\d+L?\], ", x):
            below = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            first = [j for j in range(i + 1, below) if depth[j] == depth[i + 1]]
            left = lines[first[0]:first[1] if len(first) > 1 else below]
            out.append(("skew=true" in x, any("HashAggregate" in y for y in left)))
    return out


@pytest.mark.parametrize("name", ["first_after_join", "last_before_join", "before_join_totals", "first_week_points", "member_ranking"])
def test_hot_customer_joins_take_no_raw_rows_into_one_task(spark, skew_conf, name):
    sales, menu, members = _data(spark, 100000)
    hot = F.when(F.rand(1) < 0.8, F.lit(0)).otherwise(F.col("customer_id"))
    joins = _customer_joins(getattr(L, name)(sales.withColumn("customer_id", hot.cast("long")), menu, members))
    assert joins and all(split or reduced for split, reduced in joins)


def test_hot_customer_results(spark, skew_conf):
    sales, menu, members = _data(spark)
    members = members.withColumn("join_date", F.lit("2020-06-01").cast("date"))
    j = sales.join(menu, "product_id").join(members, "customer_id")
    before, after = j.filter("order_date < join_date"), j.filter("order_date >= join_date")
    w = Window.partitionBy("customer_id").orderBy(F.desc("order_date"))
    last = before.withColumn("r", F.dense_rank().over(w)).filter("r = 1")
    assert rows(L.last_before_join(sales, menu, members)) == rows(last.select("customer_id", "join_date", "order_date", "product_name"))
    totals = before.groupBy("customer_id").agg(F.count("product_id").alias("total_item"), F.sum("price").alias("total_amount"))
    assert rows(L.before_join_totals(sales, menu, members)) == rows(totals)
    w = Window.partitionBy("customer_id").orderBy("order_date", "product_id")
    first = after.withColumn("r", F.row_number().over(w)).filter("r = 1")
    assert rows(L.first_after_join(sales, menu, members)) == rows(first.select("customer_id", "join_date", "order_date", "product_name"))
    double = (F.col("product_name") == "p3") | F.expr("order_date BETWEEN join_date AND join_date + 6")
    points = j.filter("order_date < DATE'2021-02-01'").groupBy("customer_id").agg(
        F.sum(F.when(double, F.col("price") * 20).otherwise(F.col("price") * 10)).alias("reward_points"))
    assert rows(L.first_week_points(sales, menu, members, special="p3")) == rows(points)


def test_hot_customer_ranking_and_first(spark, skew_conf):
    sales, menu, members = _data(spark)
    ranked = L.member_ranking(sales, menu, members.withColumn("join_date", F.lit("2020-06-01").cast("date")))
    w = Window.partitionBy("customer_id", "membership").orderBy("order_date")
    flagged = L.membership_flag(sales, menu, members.withColumn("join_date", F.lit("2020-06-01").cast("date")))
    ref = flagged.withColumn("ranking", F.when(F.col("membership") == "Y", F.dense_rank().over(w)).cast("bigint"))
    assert rows(ranked) == rows(ref)
    first = rows(L.first_item(sales, menu))
    wf = Window.partitionBy("customer_id").orderBy("order_date", "product_id")
    ref_first = (sales.withColumn("rn", F.row_number().over(wf)).filter("rn = 1").join(menu, "product_id")
                 .select("customer_id", F.col("product_name").alias("first_product")))
    assert first == rows(ref_first)
