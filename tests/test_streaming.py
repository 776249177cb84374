"""Streaming ingest gives the same cleaned rows as the batch transforms."""
import os
import tempfile

from frames import rows
from mercato.operators import cleaning as C
from mercato.streaming import RAW_SCHEMAS, start_clean_sink
from mercato.sources.fixtures import Fixtures
from mercato.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def _stream_vs_batch(spark, kind, raw):
    base = tempfile.mkdtemp(prefix="mercato-stream-")
    src, out, ck = (os.path.join(base, x) for x in ("src", "out", "ck"))
    # two arrivals of raw files
    a, b = raw.randomSplit([0.5, 0.5], seed=3)
    a.write.parquet(os.path.join(src, "part1"))
    b.write.parquet(os.path.join(src, "part2"))
    q = start_clean_sink(spark, kind, src + "/*", out, checkpoint=ck)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    want = CLEANERS_BATCH[kind](raw)
    cols = [c for c in want.columns]
    assert rows(got.select(*cols)) == rows(want)


CLEANERS_BATCH = {
    "customer_orders": C.clean_customer_orders,
    "runner_orders": C.clean_runner_orders,
    "weekly_sales": C.clean_weekly_sales,
}


def test_stream_runner_orders(spark):
    fx = Fixtures(Tables(spark, SF))
    raw = fx.runner_orders()
    assert raw.schema.simpleString() == spark.createDataFrame([], RAW_SCHEMAS["runner_orders"]).schema.simpleString()
    _stream_vs_batch(spark, "runner_orders", raw)


def test_stream_weekly_sales(spark):
    fx = Fixtures(Tables(spark, SF))
    raw = fx.weekly_sales()
    _stream_vs_batch(spark, "weekly_sales", raw)


def test_stream_customer_orders(spark):
    fx = Fixtures(Tables(spark, SF))
    _stream_vs_batch(spark, "customer_orders", fx.customer_orders())
