import datetime as dt

import pytest

from frames import rows
from mercato.operators import bank as B

D = dt.date


@pytest.fixture(scope="module")
def nodes(spark):
    n = spark.createDataFrame([
        (1, 1, 1, D(2020, 1, 1), D(2020, 1, 11)),
        (1, 1, 2, D(2020, 1, 11), D(2020, 1, 31)),
        (1, 1, 3, D(2020, 1, 31), D(9999, 12, 31)),
        (2, 2, 1, D(2020, 1, 1), D(2020, 1, 4)),
        (2, 2, 4, D(2020, 1, 4), D(9999, 12, 31)),
    ], "customer_id long, region_id int, node_id int, start_date date, end_date date")
    r = spark.createDataFrame([(1, "Asia"), (2, "Europe")], "region_id int, region_name string")
    return n, r


def test_node_counts(nodes):
    n, r = nodes
    assert B.distinct_nodes(n).first()[0] == 4
    assert rows(B.nodes_by_region(n, r)) == [("Asia", 3), ("Europe", 2)]
    assert rows(B.customers_by_region(n, r)) == [("Asia", 1), ("Europe", 1)]


def test_realloc_days_open_rows_left_out(nodes):
    n, _ = nodes
    # closed: 10, 20, 3 days -> 11.0
    assert B.realloc_avg_days(n).first()[0] == 11.0


def test_percentiles_interpolated(nodes):
    n, r = nodes
    got = {x.region_name: x for x in B.realloc_percentiles(n, r).collect()}
    assert got["Asia"].median == 15.0 and got["Asia"].percentile_80th == 18.0
    assert abs(got["Asia"].percentile_95th - 19.5) < 1e-9
    assert got["Europe"].median == 3.0


@pytest.fixture(scope="module")
def txns(spark):
    return spark.createDataFrame([
        (1, D(2020, 1, 2), "deposit", 100), (1, D(2020, 1, 5), "deposit", 50), (1, D(2020, 1, 9), "purchase", 20),
        (1, D(2020, 2, 1), "deposit", 200),
        (1, D(2020, 3, 1), "withdrawal", 500),
        (2, D(2020, 1, 3), "deposit", 10), (2, D(2020, 2, 3), "withdrawal", 10), (2, D(2020, 3, 3), "deposit", 40),
        (3, D(2020, 1, 3), "deposit", 70),
        (3, D(2021, 1, 3), "deposit", 30), (3, D(2021, 1, 4), "withdrawal", 5),
    ], "customer_id long, txn_date date, txn_type string, txn_amount long")


def test_txn_totals_and_deposit_avg(txns):
    assert rows(B.txn_totals(txns)) == [("deposit", 7, "$ 500"), ("purchase", 1, "$ 20"),
                                        ("withdrawal", 3, "$ 515")]
    r = B.deposit_averages(txns).first()
    # deposits per customer: 3, 2, 2 -> 2.33 -> 2 ; averages 116.67, 25, 50 -> 63.89
    assert r.deposit_count == 2.0 and r.deposit_amt == "$63.89"


def test_active_months_merges_years(txns):
    # January holds customer 1 (2 deposits + 1 purchase) and customer 3 (2020 and 2021 together)
    assert rows(B.active_months(txns)) == [("JANUARY", 2)]


def test_closing_balance_running(txns):
    got = rows(B.closing_balance(txns))
    assert [g for g in got if g[0] == 1] == [(1, 1, 130), (1, 2, 330), (1, 3, -170)]
    assert [g for g in got if g[0] == 2] == [(2, 1, 10), (2, 2, 0), (2, 3, 40)]


def test_growth_share_zero_previous_gives_no_error(txns):
    # as written: monthly nets. c1: 130 -> 200 (+53%) -> -500 ; c2: 10 -> -10 -> 40 ; c3: 95 only
    assert B.growth_share(txns).first()[0] == pytest.approx(100 * 1 / 3)
    # fixed: running balance, |prev|. c1: 130 -> 330 grows ; c2: 10 -> 0 -> 40 (prev 0 skipped)
    assert B.growth_share_fixed(txns).first()[0] == pytest.approx(100 * 1 / 3)


def test_active_months_year_grain_keeps_years_apart(txns):
    got = rows(B.active_months(txns, grain="year_month"))
    assert got == [(2020, "JANUARY", 1)]  # customer 3 has one deposit in each year


def test_percentiles_approx_opt_in(nodes):
    n, r = nodes
    got = {x.region_name: x for x in B.realloc_percentiles(n, r, approx_accuracy=10000).collect()}
    # observed values, not interpolated: Asia's days are 10 and 20
    assert got["Asia"].median in (10.0, 20.0) and got["Europe"].median == 3.0
