"""The audit against a walk of every document through every order, and against DuckDB."""
import re
from collections import defaultdict
from itertools import permutations

import duckdb
from pyspark.sql import functions as F

from edge import LONG, edge_docs, load
from mercato.llm import filter_audit as A

COLUMNS = ["part", "filter_order", "step", *A.FIELDS, "shapley"]


def failures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return ("A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words))
            + "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text)))


def brute(docs, labels):
    """Every document by itself: (doc_id, text, lang) and (doc_id, quality, toxic)."""
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    good, toxic = ({i for i, *x in labels if x[k] == 1 and i is not None} for k in (0, 1))
    out, shapley = defaultdict(lambda: [0] * 6), defaultdict(int)
    for i, t, lang in docs:
        t, lang = t or "", lang or ""
        fails = failures(t) + "E" * (i is not None and i > least[t])
        for p in permutations("ABCDE"):
            order, gone = "".join(p), False
            for step, x in enumerate(order, 1):
                here = x in fails and not gone
                row = out[lang, order, step]
                for k, yes in enumerate((x not in fails and not gone, here, x in fails and gone, fails == x, here and i in good, here and i in toxic)):
                    row[k] += yes
                shapley[lang, x] += here
                gone |= here
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(df):
    assert df.columns == COLUMNS
    return [tuple(r) for r in df.collect()]


def plain(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_equals_a_walk_through_every_order(spark):
    docs, labels = (load(spark, "sf0.001", t) for t in ("documents", "labels"))
    got = result(A.audit(docs, labels))
    assert len(got) == 600 * docs.select("lang").distinct().count()
    assert set(got) == brute(plain(docs, "doc_id", "text", "lang"), plain(labels, "doc_id", "quality", "toxic"))
    assert any(r[6] for r in got) and any(r[7] for r in got) and any(r[8] for r in got)


def test_equals_duckdb(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.01/{t}.parquet'")
    want = con.execute(A.ORACLE).fetchall()
    assert sorted(want) == sorted(result(A.audit(*(load(spark, "sf0.01", t) for t in ("documents", "labels")))))


def test_edge_rows(spark):
    labels = [(1, 1, 0), (1, 0, 1), (3, None, 1), (None, 1, 1), (4, 1, None), (99, 1, 1)]
    made = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = edge_docs(spark)
    want = brute(plain(docs, "doc_id", "text", "lang"), labels)
    assert set(result(A.audit(docs, made))) == want and {r[0] for r in want} == {"", "en", "de", "xx"}
    assert result(A.audit(docs.limit(0), made)) == []
    none = brute(plain(docs, "doc_id", "text", "lang"), [])
    assert set(result(A.audit(docs, made.limit(0)))) == none


def test_one_text_in_most_documents(spark):
    """Of a text that most documents hold only the least id's rows pass E."""
    rows = spark.range(3000).select("id", F.when(F.col("id") % 4 > 0, LONG[:2000]).otherwise(F.concat(F.lit("word "), "id")).alias("text"),
                                    F.lit("en").alias("lang")).withColumnRenamed("id", "doc_id")
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r[1:3]: r for r in result(A.audit(rows, empty))}
    assert got["EABCD", 1][3:6] == (751, 2249, 0)


def test_fields_hold_counts_beyond_32_bits():
    n = 2 ** 60 + 12345
    total = n * A.packed(0b10001, True, False) + 5 * A.packed(0, False, True)
    counts = A.unpacked(total)
    k = A.ORDERS.index("EABCD")
    assert counts[k, 0].tolist() == [5, n, 0, 0, n, 0] and counts[k, 1].tolist() == [5, 0, n, 0, 0, 0]
