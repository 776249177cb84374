"""Statistics against plain counting; the estimate resists contamination; labelled junk goes, good texts stay."""
import random

import numpy as np

from edge import LONG, edge_docs, load
from mercato.llm import quality_outliers as Q


def plain(text):
    t = text or ""
    w = t.encode().split()
    seen, dup = set(), 0
    for line in t.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    grams = {}
    for i in range(len(w) - 2):
        grams.setdefault(tuple(w[i:i + 3]), []).append(i)
    hit = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    return len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), dup, len(hit)


def test_statistics():
    rnd = random.Random(1)
    texts = [LONG, "", None, "a b a b a b", "x\nx\n\n x\n", "a b c a b c", "a b #| é"]
    texts += ["".join(rnd.choice(["a", "b", " ", "\n", "#", "\t", "é", " a b"]) for _ in range(rnd.randrange(80))) for _ in range(2000)]
    for t in texts:
        n, chars, symbols, _, dup, rep = Q.statistics(t)
        assert (n, chars, symbols, dup, rep) == plain(t), t


def test_chi_square():
    assert abs(Q.chi_square_quantile(0.05, 4) - 9.4877) < 1e-3 and abs(Q.chi_square_quantile(0.025, 2) - 7.3778) < 1e-3


def test_estimate_resists_a_fifth_of_outliers(spark):
    r = np.random.default_rng(2)
    cov = np.array([[1.0, 0.6], [0.6, 2.0]])
    good, bad = r.multivariate_normal([3, -1], cov, 4000), r.multivariate_normal([15, 15], cov, 1000)
    rows = spark.createDataFrame([("k", float(a), float(b)) for a, b in np.vstack([good, bad])], "key string, f0 double, f1 double")
    e = Q.minimum_covariance(rows, (0.01, 0.01)).first()
    inverse = np.array([[e.w0_0, e.w0_1], [e.w0_1, e.w1_1]])
    assert np.allclose([e.m0, e.m1], [3, -1], atol=0.15) and np.allclose(np.linalg.inv(inverse), cov, atol=0.35)


def test_labelled_documents(spark):
    got = Q.judged(load(spark, "sf0.1", "documents")).join(load(spark, "sf0.1", "labels"), "doc_id").collect()
    good = [r for r in got if r.quality == 1 and not r.base_failed]
    junk = [r for r in got if r.quality == 0]
    assert sum(r.kept for r in good) / len(good) > 0.995 and sum(r.kept for r in junk) / len(junk) < 0.05
    assert all(not r.kept for r in got if r.base_failed)


def test_small_groups_take_a_wider_estimate(spark):
    rnd = random.Random(3)
    text = lambda: " ".join("".join(rnd.choices("abcdefgh", k=rnd.randrange(3, 8))) for _ in range(80))
    rows = [(i, text(), "en", "big") for i in range(120)] + [(1000 + i, text(), "en", f"s{i}") for i in range(10)] + [(2000, text(), "fr", "lone")]
    rows += [(3000, " ".join("#$%&|" for _ in range(80)) + " x1 x2", "en", "s99")]
    rows = [(*r, None) for r in rows]
    got = {r.doc_id: r for r in Q.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert not got[3000].kept and all(got[i].kept for i in got if i != 3000)


def test_extreme_in_lines_or_repeats_alone(spark):
    rnd = random.Random(4)
    made = lambda n: ["".join(rnd.choices("abcdefgh", k=rnd.randrange(4, 8))) for _ in range(n)]
    clean = lambda: "\n".join(" ".join(made(8)) for _ in range(12))
    # 18 of 40 lines are the same word, no three-word window occurs twice: 45 % of the lines, no repeats.
    lines = "\n".join(x for _ in range(19) for x in ("same", " ".join(made(5)))) + "\n" + "\n".join(" ".join(made(5)) for _ in range(2))
    part = made(24)
    repeats = " ".join(part + made(52) + part)
    n, _, _, dup, rep = plain(lines)
    assert dup / 40 == 0.45 and rep == 0
    n, _, _, dup, rep = plain(repeats)
    assert dup == 0 and rep / n == 0.48
    # Source "other" of the language repeats now and then; it doesn't excuse texts of the clean one.
    rows = [(i, clean(), "en", "web") for i in range(200)] + [(1000, lines, "en", "web"), (1001, repeats, "en", "web")]
    mild = lambda k: "\n".join([" ".join(made(8)) for _ in range(12)] + ["again"] * k)
    rows += [(2000 + i, mild(2 + i % 3) if i < 40 else clean(), "en", "other") for i in range(200)]
    got = {r.doc_id: r for r in Q.judged(spark.createDataFrame([(*r, None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert not got[1000].base_failed and not got[1001].base_failed
    assert sorted(i for i, r in got.items() if not r.kept) == [1000, 1001]


def test_edge_rows(spark):
    rows = Q.judged(edge_docs(spark)).collect()
    assert len(rows) == 15 and all(r.base_failed and not r.kept for r in rows if r.doc_id not in (4, 5))
    assert Q.judged(edge_docs(spark, [])).collect() == []
