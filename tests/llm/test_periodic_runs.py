"""Runs from suffix trees against brute force over all periods."""
import random
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest

from edge import LONG, edge_docs, key, load
from mercato.llm import periodic_runs as P


def brute(words, least=24, periods=3):
    """All runs by walking every period: stretches where words q apart agree, of least period q."""
    n, found = len(words), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - a
            if length >= max(least, periods * q):
                least_period = next(d for d in range(1, q + 1) if all(words[x] == words[x + d] for x in range(a, a + length - d)))
                if least_period == q:
                    found.append((a, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, plant=True):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {i for a, length, q in runs for i in range(a + q, a + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_tree_runs_equal_brute_force(letters):
    rnd = random.Random(letters)
    for _ in range(150):
        n = rnd.randint(1, 60)
        s = [rnd.randrange(letters) for _ in range(n)]
        if rnd.random() < 0.5:                        # a repeated block inside
            block = s[:rnd.randint(1, 7)]
            s = s[:n // 2] + block * rnd.randint(2, 9) + s[n // 2:]
        for least, periods in ((2, 2), (4, 2), (6, 3), (24, 3)):
            assert [tuple(r) for r in P.runs_of(np.array(s), least, periods).tolist()] == brute(s, least, periods)


def test_suffix_tree_orders_suffixes_and_gives_common_prefixes():
    rnd = random.Random(9)
    for n in (1, 2, 17, 200):
        s = [rnd.randint(1, 3) for _ in range(n)] + [0]
        tree = P.SuffixTree(s)
        assert [s[i:] for i in np.argsort(tree.rank)] == sorted(s[i:] for i in range(n + 1))
        a = np.array([rnd.randrange(n + 1) for _ in range(50)])
        b = (a + 1 + np.array([rnd.randrange(n) for _ in range(50)])) % (n + 1)
        for i, j, x in zip(a.tolist(), b.tolist(), tree.lce(a, b).tolist()):
            assert s[i:i + x] == s[j:j + x] and s[i + x] != s[j + x]


def test_stretches_lose_no_run():
    rnd = random.Random(4)
    docs = []
    for _ in range(200):
        s = []
        while len(s) < 150:
            block = [rnd.randrange(6) for _ in range(rnd.randint(1, 14))]
            s += block * rnd.choice([1, 1, 1, 2, 3, 4, 9]) + [rnd.randrange(40) for _ in range(rnd.randint(0, 12))]
        docs.append(s)
    codes = np.array([c for s in docs for c in s])
    ends = np.cumsum([len(s) for s in docs])
    own, at = {}, 0
    for k, s in enumerate(docs):
        own[k] = [(a - at, b - at) for a, b in P.stretches(codes, ends) if at <= a < at + len(s)] if k % 10 == 0 else []
        if own[k]:
            assert all(b <= len(s) for _, b in own[k])
            assert [tuple(r) for r in P._runs_in(np.array(s), own[k]).tolist()] == brute(s)
        elif k % 10 == 0:
            assert brute(s) == []
        at += len(s)
    assert sum(map(bool, own.values())) > 10


def test_equals_brute_force_on_documents(spark):
    docs = load(spark, "sf0.001", "documents").filter("length(text) < 4000")
    got = {tuple(r) for r in P.run_summary(docs, P.planted).collect()}
    want = {expected(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    assert got == want and any(r[1] for r in want)


def test_edge_rows(spark):
    docs = edge_docs(spark).filter("length(coalesce(text, '')) < 100000")
    got = sorted((tuple(r) for r in P.run_summary(docs, P.planted).collect()), key=key)
    assert got == sorted((expected(r.doc_id, r.text) for r in docs.collect()), key=key)
    assert P.run_summary(docs.limit(0)).collect() == [] == P.list_runs(docs.limit(0)).collect()


def test_whole_long_texts(spark):
    """A run at the very end of a long text, and a text that is one run."""
    text = LONG + " a b c" * 40
    made = spark.createDataFrame([(1, text), (2, "x " * 100_000), (3, "p q r s " * 20_000 + "z")], "doc_id long, text string")
    runs = {(r.doc_id, r.start, r.length, r.period) for r in P.list_runs(made).collect()}
    n = len(text.split())
    assert {(2, 0, 100_000, 1), (3, 0, 80_000, 4)} <= runs and (1, n - 120, 120, 3) in runs
    texts = {r.doc_id: r.text for r in P.collapse_runs(made).collect()}
    assert texts[2] == "x" and texts[3] == "p q r s z" and texts[1].endswith(" a b c")


def test_blanks_repeats_and_ties(spark):
    block = "k l m n o p q r"
    rows = [(1, f"{block} {block} {block}"), (1, f"{block} {block} {block}"), (2, "a " * 24 + "z " + "b " * 24), (3, "a " * 23),
            (None, "a\t" * 24), (4, "a\u00a0b " * 30), (5, None)]
    got = {(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli)
           for r in P.run_summary(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1, 0, 24, 8, 3000), (2, 2, 0, 24, 1, 24000), (3, 0, None, None, None, None), (None, 1, 0, 24, 1, 24000),
                   (4, 1, 0, 30, 1, 30000), (5, 0, None, None, None, None)}
