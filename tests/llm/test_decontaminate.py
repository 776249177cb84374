"""Block-max WAND against scoring every entry; verified pairs against substrings."""
import random
from collections import Counter

from edge import edge_docs, load
from mercato.llm import decontaminate as D


def index(texts):
    df = Counter(t for x in texts for t in set(D.words(x)))
    return D.Index(list(enumerate(texts)), df, len(texts), sum(len(D.words(x)) for x in texts) / len(texts))


def test_search_returns_all_above_the_threshold():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.randrange(5, 90))) for _ in range(80)]
    ix = index(texts)
    n = len(ix.entry_item)
    for alpha in (0.2, 0.4, 0.6):
        for _ in range(60):
            terms = set(rnd.sample(range(len(ix.term)), rnd.randrange(1, 40)))
            scores = Counter()
            for t in terms:
                for e, x in zip(ix.entry[t], ix.impact[t]):
                    scores[e] += x
            want = {e for e, s in scores.items() if s >= alpha}
            assert {e for e, _ in ix.search(terms, 0, n, alpha)} == want
            low, high = sorted(rnd.sample(range(n), 2))
            assert {e for e, _ in ix.search(terms, low, high, alpha)} == {e for e in want if low <= e < high}


def test_a_verbatim_item_is_found_wherever_it_stands():
    rnd = random.Random(4)
    items = [" ".join(f"t{rnd.randrange(5000)}" for _ in range(n)) + ". Answer is " + " ".join(f"a{rnd.randrange(5000)}" for _ in range(5)) for n in (8, 40, 70, 300)]
    ix = index(items)
    noise = [f"n{i}" for i in range(400)]
    for k, item in enumerate(items):
        for at in range(0, 400, 23):
            text = " ".join(noise[:at]) + " " + item.upper() + " " + " ".join(noise[at:])
            found = ix.match(text, D.ALPHA)
            assert [m[0] for m in found] == [k] and found[0][2:] == (1.0, 1.0, 1.0)
    assert ix.match(" ".join(noise), D.ALPHA) == []


def test_documents_against_substrings(spark):
    docs, bench = load(spark, "sf0.01", "documents"), load(spark, "sf0.01", "benchmark")
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = {(i, b.item_id) for b in bench.collect() for i, t in texts if b.text in t}
    assert want and want <= got
    low = {(i, b.item_id) for b in bench.collect() for i, t in texts if b.text.lower()[:len(b.text) // 2] in t.lower() or b.text.lower()[len(b.text) // 2:] in t.lower()}
    assert got <= low | want
    # the result does not depend on how the items are cut into indexes
    assert {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench, index_bytes=2000).collect()} == got
    kept = D.without_contaminated(docs, bench, index_bytes=2000)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in texts} - {i for i, _ in got}


def test_edge_rows(spark):
    bench = spark.createDataFrame([(1, "one two three four"), (1, "one two three four"), (2, None), (3, ""), (None, "another text under the same id"), (4, "...")], "item_id long, text string")
    got = sorted((str(r.doc_id), str(r.item_id)) for r in D.contaminated(edge_docs(spark), bench).collect())
    assert got == [("3", "1"), ("3", "None"), ("9", "1"), ("None", "1")]
    assert D.contaminated(edge_docs(spark), bench.limit(0)).collect() == []
    assert D.contaminated(edge_docs(spark, []), bench).collect() == []
    assert D.without_contaminated(edge_docs(spark), bench).count() == 15 - 5
