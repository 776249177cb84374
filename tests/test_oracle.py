"""Every registered query against its DuckDB oracle on the sf0.001 tables."""
import os

import duckdb
import pytest

from __spark_entry__ import entry
from mercato.plans.oracle import oracle_sql
from mercato.plans.registry import inputs_for, queries
from mercato.sources.tables import TABLES
from tools.oracle_check import _rows, _types

SF = os.environ.get("MERCATO_TEST_SF", "/root/testdata/sf0.001")
KEYS = sorted(queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["region", "before_changes", "after_changes", "pct_change"]
    assert {r.region for r in df.collect()} == {"AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"}


def test_every_order_reaches_the_mart(spark):
    inputs = inputs_for(spark, SF)
    orders = spark.read.parquet(os.path.join(SF, "orders.parquet")).count()
    clean = inputs.clean_sales()
    assert clean.groupBy().sum("transactions").first()[0] == orders
    assert {r.week_number for r in clean.select("week_number").distinct().collect()} <= set(range(10, 41))


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    sdf = queries()[key](spark, SF)
    scols, srows = sdf.columns, [tuple(r) for r in sdf.collect()]
    res = duck.execute(oracle_sql()[key])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert _types(sdf, duck, oracle_sql()[key]) == []
    assert len(srows) == len(drows)
    assert _rows(scols, srows, None) == _rows(dcols, drows, None)
