"""Base spans against the plain patterns; merged states; formats found by likelihood."""
import random
import re
from hashlib import sha256

import pytest

from edge import edge_docs, load
from mercato.llm import secrets as S


def plain(text):
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_documents_against_plain_patterns(spark):
    docs = load(spark, "sf0.01", "documents").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = S.find_secrets(docs).collect()
    assert len(rows) == len(texts) and sum(r.n_assign for r in rows) > 5
    for r in rows:
        assert r.base_sha256 == sha256(plain(texts[r.doc_id]).encode()).hexdigest()


def test_odd_texts():
    rnd = random.Random(1)
    parts = ["token", "TOKEN", "api_key", "apikey", "=", ":", " ", '"', "'", "abc", "abcdef", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", "\n", " ", "ſecret", "toKen"]
    for _ in range(3000):
        t = "".join(rnd.choices(parts, k=rnd.randrange(12)))
        assert S.joined(S.base_spans(t)) == plain(t), t


def test_compatible_states_merge():
    rnd = random.Random(2)
    hexes = ["".join(rnd.choices("0123456789abcdef", k=40)).translate(S._CLASSES) for _ in range(400)]
    a = S.Automaton(hexes)
    assert len(a.states) <= 3
    words = ["".join(rnd.choices("ghijklmnop", k=40)).translate(S._CLASSES) for _ in range(20)]
    assert min(map(a.likelihood, hexes)) > max(map(a.likelihood, words))
    # a format of two parts keeps its states apart
    b = S.Automaton([("AKIA" + "".join(rnd.choices("0123456789", k=16))).translate(S._CLASSES) for _ in range(300)])
    assert len(b.states) > 3 and abs(sum(map(b.likelihood, ["HUUH" + "d" * 16]))) < 1


def test_a_learned_format_is_found_without_its_keyword(spark):
    rnd = random.Random(3)
    value = lambda: "sk-" + "".join(rnd.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=30))
    rows = [(i, f"a token = {value()} here") for i in range(300)] + [(1000 + i, "averyveryverylongordinaryword " * 5) for i in range(300)]
    rows += [(5000, f"see {value()} there")]
    got = {r.doc_id: r for r in S.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[5000].spans == "format:4:37" and got[5000].n_assign == 0
    assert all(got[1000 + i].spans == "" for i in range(300))


@pytest.mark.parametrize("k", [1, 10, 1000, 10_000])
def test_a_common_format_is_found_as_well_as_a_rare_one(spark, k):
    """Recall of unlabelled values, of three formats, whatever their count; ordinary long runs stay."""
    rnd = random.Random(k)
    upper, mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    values = [lambda: "sk-" + "".join(rnd.choices(upper, k=30)), lambda: "ghp_" + "".join(rnd.choices(mixed, k=36)),
              lambda: "".join(rnd.choices(mixed, k=24)) + "=="]
    words = ["international/organisations", "well-established-long-compound", "https://example.org/some/long/path/here", "2024-01-15T10-20-30", "AVeryLongIdentifierName_of_things"]
    rows = [(i, f"a token = {values[i % 3]()} here") for i in range(450)]
    rows += [(1000 + i, f"this {words[i % 5]} is in the text {words[(i + 2) % 5]}") for i in range(500)]
    rows += [(10_000 + i, f"see {values[i % 3]()} there") for i in range(k)]
    got = S.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_format").collect()
    assert sum(r.n_format == 1 for r in got if r.doc_id >= 10_000) >= 0.9 * k
    assert not any(r.n_format for r in got if 1000 <= r.doc_id < 10_000)


def test_redaction(spark):
    assert S.redact("ab token=abcdef1 cd", [(3, 0, 16), (9, 2, 16)]) == "ab [SECRET] cd"
    docs = edge_docs(spark)
    clean = S.redact_documents(docs)
    assert clean.columns == docs.columns and clean.count() == 15
    assert [r.text for r in clean.where("doc_id = -8").collect()] == ["[SECRET]"]
    rest = "doc_id IS NULL OR doc_id != -8"
    assert sorted(str(r.text) for r in clean.where(rest).collect()) == sorted(str(r.text) for r in docs.where(rest).collect())


def test_edge_rows(spark):
    rows = S.find_secrets(edge_docs(spark)).collect()
    assert len(rows) == 15 and [r.spans for r in rows if r.doc_id == -8] == ["assign:0:20"]
    assert all(r.base_sha256 == sha256(b"").hexdigest() for r in rows if r.doc_id in (None, 1, 2, 6))
    assert S.find_secrets(edge_docs(spark, [])).collect() == []
