"""The curve is a bijection of unit steps; shards against a plain sort."""
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from edge import edge_docs, load
from mercato.llm import hilbert_shards as H


@pytest.mark.parametrize("n,bits", [(2, 4), (3, 2), (4, 2)])
def test_curve(spark, n, bits):
    grid = spark.range(1 << (n * bits)).select(*(F.call_function("shiftright", F.col("id"), F.lit(k * bits)).bitwiseAND((1 << bits) - 1).cast("int").alias(f"c{k}") for k in range(n)))
    rows = grid.withColumn("h", H.hilbert_index([F.col(f"c{k}") for k in range(n)], bits)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(1 << (n * bits)))
    assert all(sum(abs(a[k] - b[k]) for k in range(n)) == 1 for a, b in zip(rows, rows[1:]))


def check(rows, count):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    sizes = [len(by[s]) for s in range(count)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    order = [(r.hilbert, r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size) for s in range(count) for r in sorted(by[s], key=lambda r: r.slot)]
    assert order == sorted(order)
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)


def test_documents(spark):
    docs = load(spark, "sf0.01", "documents")
    texts = {r.doc_id: r.text.encode() for r in docs.select("doc_id", "text").collect()}
    rows = H.shards(docs).collect()
    check(rows, 8)
    assert all(r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)
    # pruning: a shard covers a small part of the metadata space
    where = {r.doc_id: r.shard for r in rows}
    spread = docs.select("doc_id", "lang").collect()
    assert sum(len({where[r.doc_id] for r in spread if r.lang == x}) for x in ("de", "es", "fr")) < 24


def test_edge_rows(spark):
    rows = H.shards(edge_docs(spark)).collect()
    check(rows, 8)
    assert all(r.size == 1 and r.text_crc32 == 0 for r in rows if r.doc_id in (1, 2))
    check(H.shards(edge_docs(spark), count=40).collect(), 40)
    assert H.shards(edge_docs(spark, [])).collect() == []


def test_no_python(spark):
    plan = H.shards(load(spark, "sf0.001", "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian"))
