"""Repeated lines against a plain count of every key, and against DuckDB."""
import random
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest
import xxhash

from edge import edge_docs, key, load
from mercato.llm import line_dedup as L


def brute(rows, min_docs=10, keep_first=False):
    """(doc_id, n_lines, n_dropped, text) of (doc_id, text)."""
    strip = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\v\f\r"))
    counts, first = Counter(), {}
    for i, text in rows:
        keys = [strip(x) for x in (text or "").split("\n")]
        counts.update(set(keys))
        for n, k in enumerate(keys):
            at = (i is not None, i or 0, n)
            first[k] = min(first.get(k, at), at)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for n, x in enumerate(lines) if not strip(x) or counts[strip(x)] < min_docs
                or keep_first and first[strip(x)] == (i is not None, i or 0, n)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=key)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def plain(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def made(spark, n=400):
    rnd = random.Random(3)
    common = [f"  License Line {k}\t" for k in range(30)] + ["ALL RIGHTS Reserved", "all rights reserved ", "\vx\f", "É", "é"]
    rows = [(i, "\n".join(rnd.choice(common) if rnd.random() < .4 else f"line {rnd.randrange(900)}" for _ in range(rnd.randint(0, 9))))
            for i in range(n)]
    return spark.createDataFrame(rows + [(None, "x\nx\nlicense line 3"), (5, "x")], "doc_id long, text string").repartition(7)


@pytest.mark.parametrize("small", [L.SMALL, -1])
@pytest.mark.parametrize("keep_first", [False, True])
def test_equals_brute_force(spark, small, keep_first):
    docs = made(spark)
    want = brute(plain(docs), keep_first=keep_first)
    assert result(L.without_lines(docs, keep_first=keep_first, small=small)) == want
    assert sum(r[2] for r in want) > 300


@pytest.mark.parametrize("small", [L.SMALL, -1])
def test_edge_rows(spark, small):
    docs = edge_docs(spark)
    for min_docs in (2, 3):
        assert result(L.without_lines(docs, min_docs, small=small)) == brute(plain(docs), min_docs)
    assert L.without_lines(docs.limit(0), small=small).collect() == []
    blank = docs.select("doc_id").selectExpr("doc_id", "cast(null as string) text")
    assert result(L.without_lines(blank, small=small)) == brute(plain(blank))


def test_full_filters_cost_nothing_but_shuffle(spark):
    """Filters far too small make every key a suspect; the result is the same."""
    docs = made(spark)
    assert result(L.without_lines(docs, max_bits=1, bits=1)) == brute(plain(docs))


def test_equals_duckdb(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    want = con.execute(L.ORACLE)
    names = [d[0] for d in want.description]
    df = L.without_lines(load(spark, "sf0.01", "documents"), digest=True)
    got = result(df.select(*names))
    assert got == sorted(want.fetchall()) and sum(r[2] for r in got) > 100
    assert {r[3] for r in got} >= {sha256(b"").hexdigest()} or all(r[1] > r[2] for r in got)


def test_filter_holds_all_repeats_and_few_others():
    """Keys of two tasks, or of two documents in one, are found; by chance few others."""
    h = lambda xs: np.fromiter((xxhash.xxh3_64_intdigest(str(x).encode()) for x in xs), np.uint64, len(xs))
    levels = L.levels_for(300_000)
    tasks = [range(0, 100_000), range(99_000, 200_000), range(200_000, 300_000)]
    once, twice = ({k: L._loaded(b"").copy() for k in range(1 << levels)} for _ in range(2))
    for t in tasks:
        hashes = np.sort(h(list(t)))
        of = L._section_of(hashes, levels)
        for k in range(1 << levels):
            o = L._loaded(L._bits(hashes[of == k]))
            twice[k] |= once[k] & o
            once[k] |= o
    bits = np.concatenate([twice[k].view(np.uint8) for k in range(1 << levels)])
    assert L._in_filter(bits, h(list(range(99_000, 100_000))), levels).all()
    assert L._in_filter(bits, h(list(range(0, 99_000))), levels).mean() < 0.01


def test_sections_grow_with_lines_up_to_a_bound():
    assert L.levels_for(0) == 0 and L.levels_for(10 ** 6) == 3 and L.levels_for(10 ** 12) == 11
