"""Kernel against enumeration, the collapsed table against the landmark sum, held-out accuracy."""
from itertools import combinations

import numpy as np

from edge import edge_docs, load
from mercato.llm import toxicity as T


def kernel(s, t):
    def psi(x):
        c, out = T.classes(x).tolist(), {}
        for pick in combinations(range(len(c)), T.ORDER):
            if pick[-1] - pick[0] < T.SPAN:
                u = tuple(c[i] for i in pick)
                out[u] = out.get(u, 0) + T.DECAY ** (pick[-1] - pick[0] + 1)
        return out
    a, b = psi(s), psi(t)
    dot = lambda x, y: sum(v * y.get(u, 0) for u, v in x.items())
    return dot(a, b) / np.sqrt(dot(a, a) * dot(b, b))


def test_kernel_matches_enumeration():
    words = ["idiot", "idixot", "banana", "aaaa", "éàü1", "no"]
    got = T.gram(T.features(words), T.features(words))
    assert np.allclose(got, [[kernel(s, t) for t in words] for s in words])


def test_table_equals_the_landmark_sum():
    names, alpha = ["idiot", "clown", "banana"], np.array([1.5, -0.5, 2.0])
    psi = T.features(names)
    table = np.zeros(T.LETTERS ** T.ORDER)
    for a, (code, w) in zip(alpha, psi):
        table[code] += a * w
    found = ["idiot", "idxiot", "clwn", "bananas", "bb", "a" * T.WINDOW]
    want = T.OFFSET + T.gram(T.features(found), psi) @ alpha
    assert np.allclose(T.Model(table).score_terms(found), want)


def test_terms_cover_the_whole_text():
    assert T.terms("so I d i o - t!") == {"so", "i", "d", "o", "-", "t!", "idio-"}
    long = "ab" * 40
    assert all(len(t) <= T.WINDOW for t in T.terms(long)) and {t[0] for t in T.terms(long)} <= {"a", "b"}
    assert T.terms(None) == T.terms("") == set()


def test_held_out_accuracy(spark):
    docs, labels = load(spark, "sf0.1", "documents"), load(spark, "sf0.1", "labels")
    got = T.toxicity(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels).join(labels, "doc_id")
    rows = got.where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    hit = sum(r.predicted and r.toxic for r in rows)
    clean = [r for r in rows if not r.toxic]
    assert hit / sum(r.toxic for r in rows) > 0.9 and sum(not r.predicted for r in clean) / len(clean) > 0.95
    assert hit / sum(r.predicted for r in rows) > 0.8


def test_weights_undo_the_cap_of_a_label():
    r = np.random.default_rng(7)
    clean, toxic = r.normal(-1, 0.7, (4000, 1)), r.normal(0, 0.7, (500, 1))
    fit = lambda n, w: T.fit_logistic(np.vstack([clean[:n], toxic]), np.repeat([0.0, 1.0], [n, 500]), np.repeat([w, 1.0], [n, 500]))
    x = np.hstack([r.normal(-0.5, 0.7, (200, 1)), np.ones((200, 1))])
    full, weighted, plain = (x @ fit(*a) for a in ((4000, 1.0), (500, 8.0), (500, 1.0)))
    assert abs(np.mean(weighted - full)) < 0.4 and np.mean(plain - full) > 1.5


def test_inserted_characters(spark):
    docs, labels = load(spark, "sf0.1", "documents"), load(spark, "sf0.1", "labels")
    model = T.train(docs.select("doc_id", "text"), labels)
    clean = model.score_terms(["thonble", "stren", "einheit", "queaux"])
    assert model.score_terms(["idiot", "idioot", "stuupid", "cloown", "id"]).max() > 0 > clean.max()
    assert (model.score_terms([T.bare(w) for w in ("idi.ot", "st-upid", "clo_wn")]) > 0).all()
    # One insult in a clean text is enough, plain, dotted or with a letter put in.
    text = docs.join(labels.where("toxic = 0"), "doc_id").where("lang = 'en' and length(text) between 500 and 900").first().text
    score = lambda word: model.document(T.strongest(model.score_terms([b for t in T.terms(f"{text} {word} and") if (b := T.bare(t))])))
    assert score("") < 0.1 and all(score(w) > T.CUT for w in ("idiot", "Clown.", "st.upid", "idixot", "scumm", "i d i o t"))


def test_copies_of_a_document_are_no_evidence(spark):
    """A chance word of a toxic document that was copied often stays unknown; an insult that turns up anywhere doesn't."""
    r = np.random.default_rng(3)
    words = ["".join(r.choice(list("abcdefghij"), 5)) for _ in range(200)]
    prose = lambda *more: " ".join([*r.permutation(words)[:30], *more, *r.permutation(words)[:30]])
    toxic = [prose("zwyrk") for _ in range(60)] + [prose("zwyrk", "kquuz", "plain")] * 60
    rows = [(i, t, 1) for i, t in enumerate(toxic)] + [(i + 1000, prose(), 0) for i in range(400)]
    made = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = T.train(made.select("doc_id", "text"), made.select("doc_id", "toxic"))
    insult, chance = model.score_terms(["zwyrk", "kquuz"])
    assert insult > 0.5 > 0 > chance


def test_edge_rows(spark):
    labels = spark.createDataFrame([(3, 1, 1), (4, 0, 0), (None, 0, 1), (7, 0, None), (9, 1, 0), (9, 1, 1)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        rows = T.toxicity(edge_docs(spark), lab).collect()
        assert len(rows) == 15 and all(0 <= r.score <= 1 for r in rows)
    assert T.toxicity(edge_docs(spark, []), labels).collect() == []
    assert T.without_toxic(edge_docs(spark), labels.limit(0)).count() == 15
