"""Salted joins and bitmap counts against the plain forms."""
import pytest
from pyspark.sql import functions as F

from frames import rows
from mercato.operators import loyalty as L
from mercato.operators.distinct import distinct_bitmaps, distinct_counts
from mercato.operators.skew import hot_keys, skew_join


@pytest.fixture()
def plain_conf(spark):
    """No adaptive execution, no broadcast, and no left side so small that a hot key doesn't matter."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def hot(spark, n=20_000):
    """80 % of the rows under one key, some under NULL."""
    key = F.when(F.col("id") % 10 < 8, 7).when(F.col("id") % 50 == 9, None).otherwise(F.col("id") % 500).cast("long")
    return spark.range(n).select(key.alias("k"), (F.col("id") % 3).alias("k2"), "id")


def per_task(df):
    return sorted(r["n"] for r in df.filter("id >= 0").groupBy(F.spark_partition_id().alias("p")).agg(F.count("id").alias("n")).collect())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_the_plain_join(plain_conf, how):
    left = hot(plain_conf, 3000)
    right = plain_conf.range(0, 300, 2).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    right = right.union(right.filter("k < 20")).union(plain_conf.sql("select cast(null as bigint), 'none'"))
    right = right.union(plain_conf.sql("select 7, 'seven'"))
    for on, r in ((["k"], right), (["k", "k2"], right.withColumn("k2", F.col("k") % 3))):
        assert rows(skew_join(left, r, on, how, parts=8)) == rows(left.join(r, on, how))


def test_largest_task_is_near_the_median(plain_conf):
    left, right = hot(plain_conf), plain_conf.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain, salted = (per_task(j) for j in (left.join(right, "k", "left"), skew_join(left, right, "k", "left", parts=64)))
    assert plain[-1] > 16_000 and salted[-1] < 3 * 20_000 / 8 and salted[-1] < 2.5 * salted[len(salted) // 2]
    assert list(hot_keys(left, ["k"], 64).values()) == [53]           # 16,000 of 19,600 rows


def test_no_hot_key_and_empty_sides(plain_conf):
    even = plain_conf.range(100).select(F.col("id").alias("k"), "id")
    assert hot_keys(even, ["k"], 8) == {} == hot_keys(even.limit(0), ["k"], 8)
    assert rows(skew_join(even, even.limit(0), "k", "left").select("k")) == rows(even.select("k"))
    assert skew_join(even.limit(0), even.withColumnRenamed("id", "v"), "k").collect() == []
    with pytest.raises(ValueError):
        skew_join(even, even, "k", "full")


def test_a_small_right_side_is_joined_plainly(spark):
    plan = skew_join(hot(spark), spark.range(5).select(F.col("id").alias("k")), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" not in plan


def test_membership_under_a_hot_customer(plain_conf):
    """80 % of the sales on one customer: the flag and the ranking deal them over the tasks."""
    s = plain_conf
    sales = hot(s).select(F.col("k").alias("customer_id"), F.expr("date_add(date'2021-01-01', cast(id % 200 as int))").alias("order_date"),
                          (F.col("id") % 5).alias("product_id"), "id").filter("customer_id is not null")
    menu = s.range(5).select(F.col("id").alias("product_id"), F.concat(F.lit("p"), "id").alias("product_name"), F.lit(3).alias("price"))
    members = s.range(0, 400).select(F.col("id").alias("customer_id"), F.expr("date_add(date'2021-01-01', cast(id as int))").alias("join_date"))
    priced = L.priced_sales(sales, menu).drop("id")
    want = priced.join(members, "customer_id", "left").selectExpr(
        "customer_id", "order_date", "product_name", "price", "if(order_date >= join_date, 'Y', 'N') membership")
    flagged = L.membership_flag(priced, None, members, ordered=False)
    assert rows(flagged) == rows(want)
    sizes = per_task(flagged.withColumn("id", F.length("membership")))
    assert sizes[-1] < 3 * sum(sizes) / 8
    ranked = L.member_ranking(priced, None, members)
    sizes = per_task(ranked.withColumn("id", F.coalesce("ranking", F.lit(1))))
    assert sizes[-1] < 3 * sum(sizes) / 8
    want.createOrReplaceTempView("flagged_sales")
    assert rows(ranked) == rows(s.sql("""select *, case when membership = 'Y' then cast(dense_rank() over (
        partition by customer_id, membership order by order_date) as bigint) end ranking from flagged_sales"""))


def test_bitmap_counts_equal_count_distinct(spark):
    df = spark.range(5000).selectExpr(
        "if(id % 7 = 0, null, concat('r', id % 3)) r", "cast(2019 + id % 4 as int) y",
        "case when id % 11 = 0 then null when id % 13 = 0 then -(id % 50) else id * 7919 % 100000 end c", "id % 5 n").union(
        spark.sql("select 'only nulls', 2000, cast(null as bigint), 1L"))
    maps = distinct_bitmaps(df, ["c", "n"], ["r", "y"])
    levels = [["r", "y"], ["r"], ["y"], []]
    got = distinct_counts(maps, {"c": "customers", "n": "nodes"}, levels)
    for number, level in enumerate(levels):
        want = df.groupBy(*level).agg(F.countDistinct("c").alias("customers"), F.countDistinct("n").alias("nodes"))
        assert rows(got.filter(F.col("level") == number), *level, "customers", "nodes") == rows(want)
    assert distinct_counts(distinct_bitmaps(df.limit(0), ["c"], ["r"]), {"c": "x"}, [["r"]]).collect() == []
