"""Properties from the test strategy: exact rounding against Decimal, last
running balance = sum of signed amounts, one row per key from first_by."""
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from mercato.functions import round_ratio
from mercato.operators import bank
from mercato.plans.registry import Inputs

SF = "/root/testdata/sf0.001"


def test_round_ratio_equals_decimal_half_up(spark):
    rnd = random.Random(5)
    pairs = []
    for _ in range(3000):
        b = rnd.choice([rnd.randint(1, 40), rnd.randint(1, 10**9)]) * rnd.choice([1, -1])
        a = rnd.choice([rnd.randint(-10**6, 10**6), rnd.randint(-10**15, 10**15), b * rnd.randint(0, 9) // 8])
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a long, b long")
    for digits in (0, 1, 2):
        got = {(r.a, r.b): r.r for r in df.select("a", "b", round_ratio("a", "b", digits).alias("r")).collect()}
        q = Decimal(1).scaleb(-digits)
        for a, b in pairs:
            want = float((Decimal(a) / Decimal(b)).quantize(q, rounding=ROUND_HALF_UP))
            assert got[(a, b)] == want, (a, b, digits)


def test_last_running_balance_is_sum_of_nets(spark):
    txns = Inputs(spark, SF, materialize=False).customer_transactions()
    last = bank.closing_balance(txns).groupBy("customer_id").agg(
        F.max_by("closing_balance", "month").alias("last"))
    signed = F.when(F.col("txn_type") == "deposit", F.col("txn_amount")).otherwise(-F.col("txn_amount"))
    total = txns.groupBy("customer_id").agg(F.sum(signed).alias("total"))
    assert last.join(total, "customer_id").filter(F.col("last") != F.col("total")).count() == 0
    assert last.count() == total.count()
