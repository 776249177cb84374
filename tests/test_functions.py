import datetime as dt

from pyspark.sql import functions as F

from frames import rows
from mercato.functions.text import rounded_text
from mercato.functions import (leading_number, minute_boundaries, money_text, null_text, parse_dmy, round_ratio, tsql_week)


def test_tsql_week_starts_sunday_with_jan1_in_week1(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, d),) for d in (1, 2, 3, 9, 10)], "d date")
    got = rows(df.select("d", tsql_week("d").alias("w")))
    assert [w for _, w in got] == [1, 1, 2, 2, 3]


def test_minute_boundaries_not_elapsed_minutes(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2021, 1, 1, 18, 5, 59), dt.datetime(2021, 1, 1, 18, 15, 1))], "a timestamp, b timestamp")
    r = df.select(minute_boundaries("a", "b").alias("m"),
                  F.timestamp_diff("MINUTE", "a", "b").alias("elapsed")).first()
    assert (r.m, r.elapsed) == (10, 9)


def test_parse_dmy_single_digits_and_two_digit_year(spark):
    df = spark.createDataFrame([("31/8/20",), ("9/3/18",), ("15/06/20",)], "s string")
    assert rows(df.select(parse_dmy("s").alias("d"))) == [
        (dt.date(2018, 3, 9),), (dt.date(2020, 6, 15),), (dt.date(2020, 8, 31),)]


def test_round_ratio_exact_half_up(spark):
    df = spark.createDataFrame(
        [(201, 200), (1, 8), (-1, 8), (2, 3), (5, 0), (None, 3), (10**15, 7)], "a long, b long")
    got = [r.r for r in df.select(round_ratio("a", "b", 2).alias("r")).collect()]
    assert got == [1.01, 0.13, -0.13, 0.67, None, None, 142857142857142.86]


def test_leading_number_all_spellings(spark):
    vals = ["20km", "20 km", "13.4km", "23.4", "null", "", None, "32 mins", "27minutes", "15 minute"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.x for r in df.select(leading_number("s").alias("x")).collect()]
    assert got == [20.0, 20.0, 13.4, 23.4, None, None, None, 32.0, 27.0, 15.0]
    got_i = [r.x for r in df.select(leading_number("s", integral=True).alias("x")).collect()]
    assert got_i[:4] == [20, 20, 13, 23]


def test_null_text_and_money(spark):
    df = spark.createDataFrame([("null",), ("",), (None,), ("1, 4",)], "s string")
    assert [r.x for r in df.select(null_text("s", "").alias("x")).collect()] == ["", "", None, "1, 4"]
    assert [r.x for r in df.select(null_text("s", "", sql_null_too=True).alias("x")).collect()] == ["", "", "", "1, 4"]
    m = spark.range(1).select(money_text(F.lit(1358148)).alias("m")).first().m
    assert m == "$ 1,358,148"


def test_leading_number(spark):
    texts = [".5km", "-5km", "1,200km", "32.5 mins", " 20 km", "null", "", "1,2km", "km 5", "1.2.3", "+7", "12,345.5 km", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [(r.a, r.b) for r in df.select("i", leading_number("t").alias("a"), leading_number("t", integral=True).alias("b")).orderBy("i").collect()]
    assert got == [(0.5, 0), (-5.0, -5), (1200.0, 1200), (32.5, 32), (20.0, 20), (None, None), (None, None), (None, None),
                   (None, None), (None, None), (7.0, 7), (12345.5, 12345), (None, None)]


def test_round_ratio_keeps_decimals(spark):
    r = spark.range(1).select(
        round_ratio(F.lit(10.75), F.lit(1)).alias("a"), round_ratio(F.lit(99.5), F.lit(2)).alias("b"),
        round_ratio(F.lit("10.75").cast("decimal(9,2)"), F.lit(2)).alias("c"), round_ratio(F.lit(-1), F.lit(8)).alias("d")).first()
    assert tuple(r) == (10.75, 49.75, 5.38, -0.13)


def test_rounded_text(spark):
    r = spark.range(1).select(rounded_text(F.lit(37.5)).alias("a"), rounded_text(F.lit(40.0)).alias("b"), rounded_text(F.lit(100.004)).alias("c"),
                              rounded_text(F.lit(93.6) / 7).alias("d"), rounded_text(F.lit(0.0)).alias("e")).first()
    assert tuple(r) == ("37.5", "40", "100", "13.37", "0")


def test_wall_clock_times_ignore_session_time_zone(spark):
    from mercato.operators.cleaning import _wall_clock
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = set()
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.createDataFrame([("2021-03-14 01:59:30", "2021-03-14 03:00:10"),
                                        ("2020-11-01 00:30:00", "2021-06-01 00:30:00")], "a string, b string")
            r = df.select(_wall_clock("a").alias("a"), _wall_clock("b").alias("b")).select(
                F.hour("a").alias("h"), minute_boundaries("a", "b").alias("m")).collect()
            got.add(tuple((x.h, x.m) for x in r))
        assert got == {((1, 61), (0, 212 * 1440))}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
