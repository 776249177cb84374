"""Base spans against the plain patterns; contexts of seeds find unseen identifiers."""
import random
import re
from collections import Counter
from hashlib import sha256

from edge import edge_docs, load
from mercato.llm import pii as I


def plain(text):
    t, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return I.joined(sorted(out))


def test_odd_texts():
    rnd = random.Random(1)
    parts = ["a@b.c", "@", ".", "-", " ", "1.2.3.4", "0001.2.3.256", "4111 1111 1111 1111", "49", "+49 (0)30 123-456-78", "+1", "(", "\n", "é", "x", "٣", "4111111111111111", "a.b@", "%"]
    for _ in range(4000):
        t = "".join(rnd.choices(parts, k=rnd.randrange(12)))
        assert I.joined(I.base_spans(t)) == plain(t), t


def test_documents(spark):
    docs = load(spark, "sf0.01", "documents").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = I.find_personal_data(docs).collect()
    assert len(rows) == len(texts) and sum(r.n_card for r in rows) > 0
    for r in rows:
        assert r.base_sha256 == sha256(plain(texts[r.doc_id]).encode()).hexdigest()
        assert r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_context == len([x for x in r.spans.split(",") if x])


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    rows = [(i, f"the person wrote customerid {'jane%d@example.org' % i if i < 8 else 'KX-88%03d' % i} yesterday and the 12345 apples") for i in range(12)]
    rows += [(100 + i, f"the version 9{i}{i}1 the the 7{i}77 of the day") for i in range(50)]
    got = {r.doc_id: r for r in I.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].spans == f"email:28:{28 + len('jane%d@example.org' % i)}" for i in range(8))
    assert all(got[i].spans == "context:28:36" for i in range(8, 12))
    assert all(got[100 + i].spans == "" for i in range(50))


def test_contexts_beside_punctuation(spark):
    forms = ['wrote customerid "%s", then left', "wrote customerid ( %s ) then left", "wrote customerid %s, then left", "wrote customerid:%s then left", 'wrote {"customerid":"%s","then":1} left']
    rows = [(100 * k + i, f % (f"jane{k}x{i}@example.org" if i < 8 else f"KX-88{k}{i:02d}")) for k, f in enumerate(forms) for i in range(12)]
    for k in range(len(forms)):  # every form on its own: its seeds alone have to find its identifiers
        own = [r for r in rows if r[0] // 100 == k]
        got = {r.doc_id: r for r in I.find_personal_data(spark.createDataFrame(own, "doc_id long, text string")).collect()}
        for i, t in own:
            at = t.find("KX-88")
            assert got[i].n_context == (at >= 0) and (at < 0 or got[i].spans == f"context:{at}:{at + 8}"), (t, got[i])


def test_words_and_contexts_agree():
    assert I.words('email:jane@x.org') == ["email", "jane@x.org"] and I.words("1,234") == ["1,234"] and I.words("don't") == ["don't"]
    assert [v for *_, v in I.candidates("ab:12:cd:34:ef:56 http://x/1234 id=KX-1234,", [])] == ["ab:12:cd:34:ef:56", "http://x/1234", "KX-1234"]
    counts, inner = Counter(), Counter()
    t = 'to jane@x.org. Next/1.2.3.4 " , end'
    spans = [(s, e) for s, _, e in I.base_spans(t)]
    got = I.contexts(t, spans, counts, inner)
    known = {w for x in counts for w in I.words(x)} | set(inner)
    assert all(not w or w in known for pair in got.values() for w in pair)
    assert got[spans[0]] == ("to", "next/") and got[spans[1]] == ("next/", "end")


def test_scores_against_plain_iteration(spark):
    rnd = random.Random(5)
    words = ["id", "mail", "of", "to"]
    rows = []
    for i in range(60):
        v = rnd.choice([f"u{rnd.randrange(20)}@x.org", f"N-{rnd.randrange(5)}0055"])
        rows.append((i, f"{rnd.choice(words)} {v} {rnd.choice(words)}"))
    found = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "xxhash64(text) h", "text").mapInArrow(I._found, I.FOUND)
    got = {r.value: r.score for r in I.graph_scores(found, rounds=3, support=2, confident=0.3).collect()}
    edges, count, seeds = {}, {}, set()
    for _, t in rows:
        a, v, b = t.split()
        for x in (a, I.word(v), b):
            count[x] = count.get(x, 0) + 1
        for p in ("L:" + a, "R:" + b):
            edges[p, v] = edges.get((p, v), 0) + 1
        if "@" in v:
            seeds.add(v)
    score = {v: float(v in seeds) for _, v in edges}
    for _ in range(3):
        trust = {}
        for p in {p for p, _ in edges}:
            own = {v: n for (q, v), n in edges.items() if q == p}
            if len(own) >= 2 and sum(score[v] >= 0.3 for v in own) >= 2:
                trust[p] = min(0.999, sum(n * score[v] for v, n in own.items()) / (count[p[2:]] + 1))
        for v in score:
            if v not in seeds:
                miss = 1.0
                for p in trust:
                    miss *= 1 - trust[p] if (p, v) in edges else 1
                score[v] = 1 - miss
    want = {v: s for v, s in score.items() if v not in seeds and s >= 0.3}
    assert want and got.keys() == want.keys() and all(abs(got[v] - want[v]) < 1e-9 for v in want)


def test_edge_rows(spark):
    rows = I.find_personal_data(edge_docs(spark)).collect()
    assert len(rows) == 15 and all(r.spans == "" and r.base_sha256 == sha256(b"").hexdigest() for r in rows)
    assert I.find_personal_data(edge_docs(spark, [])).collect() == []
