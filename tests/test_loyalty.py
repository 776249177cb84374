"""Loyalty operators on the case study's own published sample (customers
A, B, C; sushi / curry / ramen) with its well-known answers."""
import datetime as dt

import pytest

from frames import rows
from mercato.operators import loyalty as L

D = dt.date


@pytest.fixture(scope="module")
def diner(spark):
    sales = spark.createDataFrame([
        ("A", D(2021, 1, 1), 1), ("A", D(2021, 1, 1), 2), ("A", D(2021, 1, 7), 2),
        ("A", D(2021, 1, 10), 3), ("A", D(2021, 1, 11), 3), ("A", D(2021, 1, 11), 3),
        ("B", D(2021, 1, 1), 2), ("B", D(2021, 1, 2), 2), ("B", D(2021, 1, 4), 1),
        ("B", D(2021, 1, 11), 1), ("B", D(2021, 1, 16), 3), ("B", D(2021, 2, 1), 3),
        ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 7), 3),
    ], "customer_id string, order_date date, product_id long")
    menu = spark.createDataFrame([(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)],
                                 "product_id long, product_name string, price long")
    members = spark.createDataFrame([("A", D(2021, 1, 7)), ("B", D(2021, 1, 9))],
                                    "customer_id string, join_date date")
    return sales, menu, members


def test_total_spend(diner):
    s, m, _ = diner
    assert rows(L.total_spend(s, m)) == [("A", 76), ("B", 74), ("C", 36)]


def test_visits(diner):
    s, _, _ = diner
    assert rows(L.visits(s)) == [("A", 4), ("B", 6), ("C", 2)]


def test_first_item_tie_broken_by_product(diner):
    s, m, _ = diner
    assert rows(L.first_item(s, m)) == [("A", "sushi"), ("B", "curry"), ("C", "ramen")]


def test_top_item_by_customer(diner):
    s, m, _ = diner
    assert rows(L.top_item_by_customer(s, m)) == [("A", "ramen", 3), ("B", "ramen", 2), ("C", "ramen", 3)]


def test_favourite_item_keeps_ties(diner):
    s, m, _ = diner
    assert rows(L.favourite_item(s, m)) == [
        ("A", "ramen", 3), ("B", "curry", 2), ("B", "ramen", 2), ("B", "sushi", 2), ("C", "ramen", 3)]


def test_first_after_and_last_before_join(diner):
    s, m, mem = diner
    assert rows(L.first_after_join(s, m, mem)) == [
        ("A", D(2021, 1, 7), D(2021, 1, 7), "curry"), ("B", D(2021, 1, 9), D(2021, 1, 11), "sushi")]
    assert rows(L.last_before_join(s, m, mem)) == [
        ("A", D(2021, 1, 7), D(2021, 1, 1), "curry"), ("A", D(2021, 1, 7), D(2021, 1, 1), "sushi"),
        ("B", D(2021, 1, 9), D(2021, 1, 4), "sushi")]


def test_before_join_totals(diner):
    s, m, mem = diner
    assert rows(L.before_join_totals(s, m, mem)) == [("A", 2, 25), ("B", 3, 40)]


def test_points(diner):
    s, m, _ = diner
    assert rows(L.points(s, m)) == [("A", 860), ("B", 940), ("C", 360)]


def test_first_week_points_edges(diner):
    s, m, mem = diner
    assert rows(L.first_week_points(s, m, mem)) == [("A", 1370), ("B", 820)]


def test_first_week_window_is_closed_both_ends(spark):
    menu = spark.createDataFrame([(1, "x", 1)], "product_id long, product_name string, price long")
    mem = spark.createDataFrame([("A", D(2021, 1, 1))], "customer_id string, join_date date")
    sales = spark.createDataFrame(
        [("A", D(2021, 1, d), 1) for d in (1, 7, 8)] + [("A", D(2020, 12, 31), 1)],
        "customer_id string, order_date date, product_id long")
    # day 0 and day 6 earn 20, day 7 and the day before joining earn 10
    assert rows(L.first_week_points(sales, menu, mem)) == [("A", 60)]


def test_membership_flag_and_ranking(diner):
    s, m, mem = diner
    flag = L.membership_flag(s, m, mem)
    assert flag.count() == 15
    assert rows(flag.filter("customer_id = 'C'"), "membership") == [("N",)] * 3
    rk = rows(L.member_ranking(s, m, mem), "customer_id", "order_date", "product_name", "ranking")
    a = [r for r in rk if r[0] == "A"]
    assert [r[3] for r in a] == [None, None, 1, 2, 3, 3]
    b = [r for r in rk if r[0] == "B"]
    assert [r[3] for r in b] == [None, None, None, 1, 2, 3]


def test_priced_fact_path_equals_two_table_path(diner):
    s, m, mem = diner
    p = L.priced_sales(s, m)
    pairs = [
        (L.total_spend(s, m), L.total_spend(p, None)),
        (L.favourite_item(s, m), L.favourite_item(p, None)),
        (L.first_after_join(s, m, mem), L.first_after_join(p, None, mem)),
        (L.last_before_join(s, m, mem), L.last_before_join(p, None, mem)),
        (L.before_join_totals(s, m, mem), L.before_join_totals(p, None, mem)),
        (L.points(s, m), L.points(p, None)),
        (L.first_week_points(s, m, mem), L.first_week_points(p, None, mem)),
        (L.membership_flag(s, m, mem), L.membership_flag(p, None, mem)),
        (L.member_ranking(s, m, mem), L.member_ranking(p, None, mem)),
    ]
    for a, b in pairs:
        assert rows(a) == rows(b)
