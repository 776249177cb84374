"""Codes against plain arrays, and files against the tokenizers library."""
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from edge import LONG, edge_docs, load
from mercato.llm import token_file as F
from mercato.llm.common import scratch

PATH = P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("top", [1, 2, 300, 60_000, 2 ** 31])
def test_random_access(top):
    ids = np.random.default_rng(top).integers(0, top, 3000).astype(np.uint32)
    ids[:2000] %= 200
    r = F.Reader(F.dump([None, 7], [1200, 1800], ids))
    assert r.doc_ids == [None, 7] and r.tokens == 3000
    assert [r.token(i) for i in range(0, 3000, 41)] == ids[::41].tolist()
    for a, b in ((0, 3000), (511, 513), (1, 1), (2999, 3000), (700, 1900)):
        assert (r.slice(a, b) == ids[a:b]).all()
    assert (r.document(1) == ids[1200:]).all()


def test_widths_are_the_smallest():
    ids = np.concatenate([np.arange(900) % 16, np.full(100, 50_000)]).astype(np.uint32)
    size = lambda ws: sum((w + (k + 1 < len(ws))) * (np.frexp(ids.astype(float))[1] > sum(ws[:k])).sum() if k else len(ids) * (w + (len(ws) > 1)) for k, w in enumerate(ws))
    best = F.widths(ids)
    assert sum(best) == 16 and size(best) <= min(size([4, 12]), size([16]), size([8, 8]), size([4, 4, 8]))
    assert F.Reader(F.dump([], [], np.empty(0, np.uint32))).tokens == 0


def expected(rows):
    library = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_documents(spark):
    docs = load(spark, "sf0.001", "documents").select("doc_id", "text")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    folder = scratch(spark, "tokens")
    manifest = F.write_tokens(docs.repartition(5), PATH, 2, folder, file_tokens=20_000)
    assert manifest.count() > 3
    assert sorted(map(tuple, F.read_summary(manifest, folder).collect())) == expected(rows)


def test_encoder_on_odd_texts():
    library = Tokenizer.from_file(PATH)
    odd = [LONG, "", " a  b", "\n \nx ", "<|endoftext|> a", "a  <|endoftext|>  <|endoftext|>b", "one <|endoftext|", "日本 😀", "it's 12 a.b,c"]
    assert [x.tolist() for x in F.encoder(PATH).encode(odd)] == [library.encode(t, add_special_tokens=False).ids for t in odd]


def test_latin_texts_need_no_whole_encoder(monkeypatch):
    rnd = random.Random(4)
    odd = ["".join(rnd.choice("ab1éß 's 't 're'LL  \n.,!?#*$'_/x") for _ in range(rnd.randrange(30))) for _ in range(20_000)]
    library, enc = Tokenizer.from_file(PATH), F.TextEncoder(PATH)
    monkeypatch.setattr(enc, "tokenizer", None)
    assert [x.tolist() for x in enc.encode(odd)] == [x.ids for x in library.encode_batch(odd, add_special_tokens=False)]


def test_other_texts_as_the_library_has_them():
    rnd = random.Random(5)
    odd = ["".join(rnd.choice("aé 's \r\t\n.,*\u0085\x1c\xa0\u2028ª²½٣日ß😀\u0301-µ") for _ in range(rnd.randrange(30))) for _ in range(20_000)]
    library = Tokenizer.from_file(PATH)
    assert [x.tolist() for x in F.TextEncoder(PATH).encode(odd)] == [x.ids for x in library.encode_batch(odd, add_special_tokens=False)]


def test_memos_are_bounded(monkeypatch):
    monkeypatch.setattr(F, "KEPT", 5)
    library, enc = Tokenizer.from_file(PATH), F.TextEncoder(PATH)
    text = "one two, " + "x" * 5000 + " three*** four five " + "ab " * 50 + "six seven eight nine\nten"
    assert [x.tolist() for x in enc.encode([text] * 3)] == [library.encode(text, add_special_tokens=False).ids] * 3
    assert len(enc.kept) <= 6 and len(enc.short) <= 6 and max(map(len, enc.kept)) < 1000


def test_new_pre_tokens_go_to_the_library_together(monkeypatch):
    library, enc = Tokenizer.from_file(PATH), F.TextEncoder(PATH)
    texts = [f"Wort{i}é, und{i}\tnoch 日{i} " + "".join(chr(97 + i // 26 ** k % 26) for k in range(4)) + ". Ende" for i in range(500)]
    calls, ids_of = [], enc.ids_of
    monkeypatch.setattr(enc, "ids_of", lambda found: calls.append(len(found)) or ids_of(found))
    assert [x.tolist() for x in enc.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert len(calls) == 1 and calls[0] > 1000


def test_edge_rows(spark):
    rows = sorted(map(tuple, F.token_files(edge_docs(spark), PATH).collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == [None, None, None, -8, 1, 1, 2, 3, 3, 3, 4, 5, 6, 7, 9]
    assert [r[1] for r in rows] == np.concatenate([[0], np.cumsum([r[2] for r in rows])])[:-1].tolist()
    assert F.token_files(edge_docs(spark, []), PATH).collect() == []
