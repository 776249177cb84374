"""The skew-safe helpers give the same rows as the plain window functions."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from frames import rows
from mercato.operators.ranking import first_by, next_time, rank_distinct, ties_at_max


def _data(spark, n=400, seed=7):
    rnd = random.Random(seed)
    # one hot key with a third of the rows
    data = [(0 if i % 3 == 0 else rnd.randint(1, 20), rnd.randint(0, 15), i, rnd.randint(0, 4)) for i in range(n)]
    return spark.createDataFrame(data, "k long, t long, o long, v long")


def test_first_by_matches_row_number(spark):
    df = _data(spark)
    w = Window.partitionBy("k").orderBy("t", "o")
    ref = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("k", "t", "o", "v")
    assert rows(first_by(df, "k", ["t", "o"], carry=["v"])) == rows(ref)


def test_ties_at_max_matches_rank(spark):
    df = _data(spark)
    w = Window.partitionBy("k").orderBy(F.desc("t"))
    ref = df.withColumn("r", F.rank().over(w)).filter("r = 1").drop("r")
    assert rows(ties_at_max(df, "k", "t"), *ref.columns) == rows(ref)
    wg = Window.orderBy(F.desc("v"))
    refg = df.withColumn("r", F.rank().over(wg)).filter("r = 1").drop("r")
    assert rows(ties_at_max(df, None, "v"), *refg.columns) == rows(refg)


def test_rank_distinct_matches_dense_rank(spark):
    df = _data(spark)
    ref = df.select("k", "t", F.dense_rank().over(Window.partitionBy("k").orderBy("t")).alias("r")).distinct()
    assert rows(rank_distinct(df, "k", "t", "r")) == rows(ref)


def test_next_time_matches_lead(spark):
    df = _data(spark)
    ref = df.withColumn("nx", F.lead("t").over(Window.partitionBy("k").orderBy("t", "o")))
    assert rows(next_time(df, "k", "t", "o", "nx"), *ref.columns) == rows(ref)


def test_next_time_fine_grained_hot_key(spark):
    rnd = random.Random(11)
    data = [(0 if i % 3 == 0 else rnd.randint(1, 30), rnd.randint(0, 10**6), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k long, t long, o long").repartition(7)
    ref = df.withColumn("nx", F.lead("t").over(Window.partitionBy("k").orderBy("t", "o")))
    assert rows(next_time(df, "k", "t", "o", "nx"), *ref.columns) == rows(ref)


def test_first_by_orders_nulls_last(spark):
    df = spark.createDataFrame([(1, None, 5), (1, 3, 7), (2, None, 1)], "k long, t long, v long")
    assert rows(first_by(df, "k", ["t"], carry=["v"])) == [(1, 3, 7), (2, None, 1)]


def test_helpers_keep_null_keys_like_windows(spark):
    df = spark.createDataFrame([(None, 1, 1, 2), (None, 2, 2, 2), (1, 5, 3, 1), (1, None, 4, 9), (None, 2, 5, 0)],
                               "k long, t long, o long, v long")
    w = Window.partitionBy("k").orderBy(F.desc("v"))
    ref = df.withColumn("r", F.rank().over(w)).filter("r = 1").drop("r")
    assert rows(ties_at_max(df, "k", "v"), *ref.columns) == rows(ref)
    timed = df.where("t IS NOT NULL")
    lead_ref = timed.withColumn("nx", F.lead("t").over(Window.partitionBy("k").orderBy("t", "o")))
    assert rows(next_time(timed, "k", "t", "o", "nx"), *lead_ref.columns) == rows(lead_ref)
    dr = df.select("k", "t", F.dense_rank().over(
        Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last())).alias("r")).distinct()
    assert rows(rank_distinct(df, "k", "t", "r")) == rows(dr)
