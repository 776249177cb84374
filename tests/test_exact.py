"""Exact sums equal math.fsum, in whatever order and partitioning the rows come."""
import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mercato.functions.exact import exact_avg, exact_sum

rnd = random.Random(9)
GROUPS = {
    "cents": [round(rnd.uniform(-1e4, 1e4), 2) for _ in range(3000)],
    "wide": [rnd.uniform(-1, 1) * 10.0 ** rnd.randrange(-15, 30) for _ in range(3000)],
    "cancels": [s * x for x in (rnd.uniform(1e18, 1e19) for _ in range(500)) for s in (1, -1)] + [0.1],
    "negative": [-rnd.random() for _ in range(1000)],
    "zero": [1e16, -1e16, 0.0, -0.0],
    "tie": [2.0 ** 53, 1.0, 2.0 ** -60],
    "one": [-1e-17],
}


def sums(df):
    return {r.g: (r.s, r.a) for r in df.groupBy("g").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).collect()}


def test_equals_fsum_in_any_order(spark):
    rows = [(g, x) for g, xs in GROUPS.items() for x in xs]
    want = {g: (math.fsum(xs), math.fsum(xs) / len(xs)) for g, xs in GROUPS.items()}
    for n in (1, 3, 17):
        rnd.shuffle(rows)
        assert sums(spark.createDataFrame(rows, "g string, x double").repartition(n)) == want
    assert [tuple(r) for r in spark.createDataFrame(rows, "g string, x double").where("g = 'tie'").agg(exact_sum("x")).collect()] == [(2.0 ** 53 + 2,)]


def test_nulls_and_special_values(spark):
    inf, nan = math.inf, math.nan
    rows = [("none", None), ("some", None), ("some", 1.5), ("inf", inf), ("inf", 1.0), ("nan", nan), ("nan", 2.0), ("both", inf), ("both", -inf)]
    got = sums(spark.createDataFrame(rows, "g string, x double"))
    assert got["none"] == (None, None) and got["some"] == (1.5, 1.5) and got["inf"][0] == inf
    assert math.isnan(got["nan"][0]) and math.isnan(got["both"][0])
    empty = spark.createDataFrame([], "g string, x double")
    assert sums(empty) == {} and empty.agg(exact_sum("x").alias("s")).first().s is None


@pytest.mark.parametrize("x", [1e-40, 1e40])
def test_values_out_of_range_fail(spark, x):
    df = spark.createDataFrame([(x,)], "x double")
    with pytest.raises(PySparkException):
        df.agg(exact_sum("x")).collect()
    assert df.agg(exact_sum("x", -210, 180).alias("s")).first().s == x


def test_partial_aggregates_and_no_python(spark):
    plan = spark.range(10).select((F.col("id") / 3).alias("x")).groupBy().agg(exact_sum("x"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Python" not in plan
