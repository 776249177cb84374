import datetime as dt

import pytest

from frames import rows
from mercato.operators import cleaning as C
from mercato.operators import mart as M


@pytest.fixture(scope="module")
def clean(spark):
    raw = []
    # weeks around 2020-06-15 (ISO week 25) and the same weeks of 2019
    for year, base in ((2020, dt.date(2020, 6, 15)), (2019, dt.date(2019, 6, 17))):
        for k in range(-5, 5):
            d = base + dt.timedelta(weeks=k)
            wd = f"{d.day}/{d.month}/{d.year % 100}"
            raw.append((wd, "ASIA", "Retail", "C1", "New", 10, 1000 + (k >= 0) * 100))
            raw.append((wd, "ASIA", "Shopify", "F3", "Guest", 4, 401))
            raw.append((wd, "USA", "Retail", "null", "Existing", 3, 100))
    df = spark.createDataFrame(raw, "week_date string, region string, platform string, segment string, "
                                    "customer_type string, transactions long, sales long")
    return C.clean_weekly_sales(df).cache()


def test_clean_columns(clean):
    r = clean.filter("segment = 'C1'").orderBy("week_date").first()
    assert r.age_band == "Young Adults" and r.demographic == "Couples"
    u = clean.filter("segment = 'null'").first()
    assert (u.age_band, u.demographic) == ("unknown", "unknown")
    s = clean.filter("segment = 'F3'").first()
    assert (s.age_band, s.demographic, s.avg_transaction) == ("Retirees", "Families", 100.25)
    assert clean.filter("week_date = date'2020-06-15'").first().week_number == 25


def test_before_after_4w(clean):
    r = M.before_after(clean, 4, year=2020).first()
    # before: weeks 21..24 ; after: weeks 25..28
    assert r.before_changes == 4 * (1000 + 401 + 100)
    assert r.after_changes == 4 * (1100 + 401 + 100)
    assert r.pct_change == round(100 * 400 / 6004, 2)


def test_before_after_by_year_and_dimension(clean):
    got = rows(M.before_after(clean, 4, by=["calendar_year"]), "calendar_year", "before_changes")
    assert got == [(2019, 6004), (2020, 6004)]
    reg = rows(M.before_after(clean, 12, by=["region"]), "region", "before_changes", "after_changes")
    assert reg == [("ASIA", 2 * 5 * 1401, 2 * 5 * 1501), ("USA", 1000, 1000)]


def test_before_after_absent_baseline(clean):
    one = M.before_after(clean, 4, baseline="2020-01-01").collect()
    assert len(one) == 1 and one[0].before_changes is None and one[0].pct_change is None
    assert M.before_after(clean, 4, by=["region"], baseline="2020-01-01").count() == 0


def test_exploration(clean):
    assert rows(M.weekday_names(clean)) == [("MONDAY",)]
    missing = [r[0] for r in M.missing_weeks(clean).collect()]
    assert 25 not in missing and 1 in missing and 53 in missing and len(missing) == 53 - 10
    assert rows(M.platform_rows(clean)) == [("Retail", 40), ("Shopify", 20)]
    share = M.demographic_share(clean).collect()
    for r in share:
        assert abs(r.couple_sales + r.family_sales + r.unknown_sales - 100) < 0.02
    contrib = M.retail_contribution(clean).collect()
    assert abs(sum(r.percentage_contribution for r in contrib) - 100) < 0.02
    q9 = rows(M.avg_transaction_size(clean), "platform", "avg_avg_transactions", "proper_avg_transactions")
    assert q9[0][0] == "Retail"
    assert M.preview(clean).count() == 10


def test_missing_weeks_ignores_null(spark, clean):
    with_null = clean.unionByName(clean.limit(1).withColumn("week_number", clean.week_number * None))
    assert M.missing_weeks(with_null).count() == M.missing_weeks(clean).count()


def test_cuts_in_one_pass_equal_separate_statements(clean):
    dims = ["region", "platform", "age_band", "demographic", "customer_type"]
    one = rows(M.before_after_cuts(clean, 12, dims))
    sep = []
    for d in dims:
        for r in M.before_after(clean, 12, by=[d]).collect():
            sep.append((d, r[d], r.before_changes, r.after_changes, r.pct_change))
    assert one == sorted(sep)
    plan = M.before_after_cuts(clean, 12, dims)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan
