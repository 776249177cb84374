"""Windows and percentiles by cells against the plain window functions and DuckDB."""
import random

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from frames import rows
from mercato.operators import ordered as O

SCHEMA = "g string, d date, t int, v long, x double"


@pytest.fixture(scope="module", params=["hot", "small", "one", "none"])
def data(spark, request):
    """A group of 80 % of the rows, an order value of a third of them, NULLs everywhere."""
    rnd = random.Random(11)
    import datetime as dt
    n = {"hot": 6000, "small": 40, "one": 1, "none": 0}[request.param]
    out = []
    for i in range(n):
        g = "hot" if rnd.random() < .8 else rnd.choice(["a", "b", None, f"k{rnd.randrange(300)}"])
        d = None if rnd.random() < .03 else dt.date(2020, 1, 1) + dt.timedelta(days=100 if rnd.random() < .33 else rnd.randrange(300))
        out.append((g, d, i, None if rnd.random() < .05 else rnd.randrange(-50, 1000),
                    None if rnd.random() < .05 else round(rnd.choice([7.5, rnd.uniform(0, 1e6)]), 2)))
    return spark.createDataFrame(out, SCHEMA).repartition(5).cache()


def sort(columns, descending=False):
    return [F.col(c).desc_nulls_first() if descending else F.col(c).asc_nulls_last() for c in columns]


def window(keys, order, descending=False):
    return Window.partitionBy(*keys).orderBy(*sort(order, descending))


@pytest.mark.parametrize("keys", [[], ["g"]])
@pytest.mark.parametrize("descending", [False, True])
def test_ranks_equal_the_window(data, keys, descending):
    w = window(keys, ["d"], descending)
    want = data.withColumn("r", F.rank().over(w).cast("bigint")).withColumn("q", F.dense_rank().over(w).cast("bigint"))
    for cells in (1, 9):
        got = O.with_ranks(data, ["d"], keys, "r", "q", descending, cells)
        assert got.schema == want.schema or got.columns == want.columns
        assert rows(got) == rows(want)
    assert rows(O.with_ranks(data, ["d"], keys, "r", descending=descending, cells=9)) == rows(want.drop("q"))


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_ranks_over_two_columns(data, keys):
    w = window(keys, ["d", "v"])
    assert rows(O.with_ranks(data, ["d", "v"], keys, "r", cells=13)) == rows(data.withColumn("r", F.rank().over(w).cast("bigint")))


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_running_sums_equal_the_window(data, keys):
    ties = data.withColumn("s", F.sum("v").over(window(keys, ["d"])))
    each = data.withColumn("s", F.sum("v").over(window(keys, ["d", "t"]).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    for cells in (1, 17):
        assert rows(O.with_running_sum(data, "v", ["d"], keys, "s", cells=cells)) == rows(ties)
        assert rows(O.with_running_sum(data, "v", ["d", "t"], keys, "s", rows=True, cells=cells)) == rows(each)
    amounts = data.withColumn("m", F.col("v").cast("decimal(12,2)"))
    got = O.with_running_sum(amounts, "m", ["d"], keys, "s", cells=8)
    assert rows(got, "t", "s") == rows(amounts.withColumn("s", F.sum("m").over(window(keys, ["d"]))), "t", "s")


@pytest.mark.parametrize("keys", [[], ["g"]])
@pytest.mark.parametrize("offset,default", [(1, None), (3, 0), (400, -1)])
def test_lag_and_lead_equal_the_window(data, keys, offset, default):
    w = window(keys, ["d", "t"])
    for cells in (1, 17):
        lag = O.with_lag(data, "v", ["d", "t"], keys, "p", offset, default, cells=cells)
        assert rows(lag, "t", "p") == rows(data.withColumn("p", F.lag("v", offset, default).over(w)), "t", "p")
        lead = O.with_lead(data, "v", ["d", "t"], keys, "p", offset, default, cells=cells)
        assert rows(lead, "t", "p") == rows(data.withColumn("p", F.lead("v", offset, default).over(w)), "t", "p")
    with pytest.raises(ValueError):
        O.with_lag(data, "v", ["d", "t"], keys, offset=0)


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_neighbours_share_one_pass(data, keys):
    w = window(keys, ["d", "t"])
    want = data.select("t", F.lag("v", 2, 0).over(w).alias("a"), F.lead("v").over(w).alias("b"), F.lead("v", 5, -9).over(w).alias("c"))
    for cells in (1, 17, 64):
        got = O.with_neighbours(data, "v", ["d", "t"], {"a": (2, 0), "b": -1, "c": (-5, -9)}, keys, cells)
        assert rows(got, "t", "a", "b", "c") == rows(want)


@pytest.mark.parametrize("keys", [[], ["g"]])
@pytest.mark.parametrize("limit", [10 ** 6, 300])
def test_percentiles_equal_quantile_cont(data, keys, limit):
    ps, names = (0.5, 0.8, 0.95, 0.0, 1.0), ("a", "b", "c", "least", "most")
    got = O.percentiles(data, "x", ps, names, keys, cells=6, limit=limit)
    con = duckdb.connect()
    con.execute("create table t (g varchar, x double)")
    if found := [tuple(r) for r in data.select("g", "x").collect()]:
        con.executemany("insert into t values (?, ?)", found)
    select = ", ".join(f"quantile_cont(x, {p})" for p in ps)
    want = con.execute(f"select {'g, ' if keys else ''}{select} from t {'group by g' if keys else ''}").fetchall()
    spark_own = data.groupBy(*keys).agg(*[F.percentile("x", p).alias(n) for p, n in zip(ps, names)])
    for other in (sorted(want, key=lambda r: tuple((v is not None, v) for v in r)), rows(spark_own)):
        assert [near(r) for r in rows(got)] == [near(r) for r in other]


def near(row):
    return tuple(f"{v:.10e}" if isinstance(v, float) else v for v in row)


def test_hot_groups_and_hot_values_are_cut(spark):
    """A group of 80 % of the rows lies in many cells, and a value of a third of
    them is a cell by itself whose rows are dealt over tasks."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 5 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("g"),
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") * 7919 % 1000).alias("d"), "id")
    at = O.Cells(df, ["g"], ["d"], 40)
    celled = at.deal(at.of(df)).cache()
    largest = celled.groupBy("g", "__cell", "__deal").count().agg(F.max("count")).first()[0]
    assert largest < 3 * 20_000 / 40
    assert celled.filter("g = 'hot'").select("__cell").distinct().count() > 15
    assert celled.filter("d = 500 and g = 'hot'").select("__cell").distinct().count() == 1


def test_even_groups_take_the_plain_window(spark):
    df = spark.range(4000).selectExpr("id % 1000 as g", "id as d")
    assert O.Cells(df, ["g"], ["d"], 16).even and not O.Cells(df, [], ["d"], 16).even
    plan = O.with_ranks(df, ["d"], ["g"], "r", cells=16)._jdf.queryExecution().optimizedPlan().toString()
    assert "__cell" not in plan and plan.count("Window") == 1


def test_no_task_takes_all_rows_without_adaptive_execution(spark):
    """The rows' exchanges are by cell; the only single-partition exchange holds the offsets."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(5000).selectExpr("id", "id * 7919 % 5000 as d").repartition(4)
        ranked = O.with_ranks(df, ["d"], rank="r", dense="q", cells=16)
        sizes = ranked.filter("r > 0 and q > 0").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        assert len(sizes) > 4 and max(r["count"] for r in sizes) < 5000 / 2
        assert rows(ranked, "d", "r", "q") == [(i, i + 1, i + 1) for i in range(5000)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
