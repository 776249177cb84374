"""MinHash near duplicates against brute force over all pairs."""
import random
from collections import defaultdict
from math import comb

import numpy as np

from edge import edge_docs, load
from mercato.llm import near_dup as N


def brute(rows):
    """{doc_id: (n_shingles, component_id)} by exact sets and all pairs that share a shingle."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    inverse = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            inverse[x].append(i)
    for a, b in {(a, b) for v in inverse.values() for a in v for b in v if a < b}:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def near_group(n, seed):
    """Copies of one text, each with its own changed words; many pairs lie near the threshold."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(9999)}" for _ in range(120)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.randrange(1, 7)):
            own[rnd.randrange(len(own))] = f"x{rnd.randrange(9999)}"
        out.append(" ".join(own))
    return out


def test_matches_brute_force_on_documents(spark):
    docs = load(spark, "sf0.001", "documents")
    got = N.near_duplicates(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(got) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_group_of_near_copies_loses_no_link(spark):
    texts = near_group(60, 1) + near_group(30, 2) + ["short one", "short ONE", "a b c d e", ""]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert result(N.near_duplicates(docs)) == want
    # tiny blocks: every bucket is cut into many cells
    assert result(N.near_duplicates(docs, block=4)) == want


def test_edge_rows(spark):
    rows = [tuple(r) for r in N.near_duplicates(edge_docs(spark)).collect()]
    assert len(rows) == 15
    assert rows.count((1, 0, 1, True)) == 2 and (2, 0, 2, True) in rows and (6, 0, 6, True) in rows
    assert rows.count((3, 1, 3, True)) == 2 and (9, 1, 3, False) in rows and (None, 1, 3, False) in rows
    n = next(r[1] for r in rows if r[0] == 4)
    assert n > 10_000 and (4, n, 4, True) in rows and (5, n, 4, False) in rows
    assert N.near_duplicates(edge_docs(spark, [])).collect() == []


def test_one_of_each_group_stays(spark):
    docs = edge_docs(spark)
    kept = N.without_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in kept.select("doc_id", "text").collect())
    # doc_id 1 has two rows without words: linked with nothing, both stay
    assert [i[1] for i in ids if i[0]] == [-8, 1, 1, 2, 3, 3, 4, 6, 7]


def test_rows_linked_with_nothing_all_stay(spark):
    rows = [(None, None), (None, None), (None, "same words"), (None, "same words"), (5, ""), (5, ""), (None, ""), (6, " \n"), (6, "x y"), (6, "x y"), (7, "x y"), (None, "x y")]
    kept = N.without_copies(spark.createDataFrame([(*r, "?", 1) for r in rows], "doc_id long, text string, h string, kept_id int"))
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(repr, rows[:9]))


def test_posterior_bound():
    least = N.least_matches(128, 32, (75, 100), 1e-4)
    for n, m in least.items():
        p = lambda k: sum(comb(n + 1, i) * 0.75 ** i * 0.25 ** (n + 1 - i) for i in range(k + 1))
        assert p(m) >= 1e-4 > p(m - 1)
    a = np.zeros((2, 128), "<u4")
    b = a.copy()
    b[1, :] = 1
    assert N._likely(a, b, least).tolist() == [0]
