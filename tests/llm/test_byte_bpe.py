"""Ids against the tiktoken library; round trips; the queue against sorting."""
import random
from hashlib import sha256

import numpy as np
import public_tokenizers as P
import tiktoken

from edge import LONG, edge_docs, load
from mercato.llm import byte_bpe as B

PATH = P.path("byte_bpe_multi_50k.tiktoken")
BPE = B.tokenizer(PATH, P.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=BPE.ranks, special_tokens={})


def test_odd_texts():
    rnd = random.Random(1)
    odd = [LONG, "", " ", "a  b   c", "\n \n x", "don't we'll I'M", "日本語 123456 ｱ", "👩‍👩‍👧", " a   b", "x" * 100_000, "ab" * 60_000, "<|endoftext|>"]
    odd += ["".join(rnd.choice(" \n\ta b1.'s éж日😀 ") for _ in range(rnd.randrange(40))) for _ in range(3000)]
    for text, ids in zip(odd, BPE.encode(odd)):
        assert ids.tolist() == LIBRARY.encode_ordinary(text)
        assert BPE.decode(ids) == text.encode()


def test_emptied_memos_change_nothing(monkeypatch):
    import mercato.llm.segments as S
    monkeypatch.setattr(S, "WORDS", 5)
    monkeypatch.setattr(S, "SEGMENTS", 5)
    monkeypatch.setattr(S, "RUN", 30)
    bpe = B.ByteBpe(BPE.ranks, P.PATTERN)
    texts = LONG[:20_000].split("gamma") + [None]
    assert [x.tolist() for x in bpe.encode(texts)] == [LIBRARY.encode_ordinary(t or "") for t in texts]


def test_long_segments_are_not_kept():
    bpe = B.ByteBpe(BPE.ranks, P.PATTERN)
    text = "one " + "x" * 5000 + " two"
    assert [x.tolist() for x in bpe.encode([text] * 2)] == [LIBRARY.encode_ordinary(text)] * 2
    assert set(bpe.kept) == {"two"}


def test_short_pre_tokens_are_merged_side_by_side():
    rnd = random.Random(3)
    bpe = B.ByteBpe(BPE.ranks, P.PATTERN)
    odd = ["".join(rnd.choice("theandingré日😀12.,'") for _ in range(rnd.randrange(1, 60))).encode() for _ in range(5000)]
    odd += [b"a" * n for n in range(1, 256)] + [b"ab" * 127, b"\xff" * 255, b" " * 255]
    steps, lowest = [], bpe.blocks.lowest
    bpe.blocks.lowest = lambda: steps.append(1) or lowest()
    ids, n = bpe.merge_short(odd)
    assert len(steps) < 1000                # not a step for each rank or pre-token
    plain = bpe.merge(odd)
    assert (ids == plain[0]).all() and (n == plain[1]).all()
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [LIBRARY._encode_single_piece(p) for p in odd]


def test_a_full_memo_keeps_what_is_used_most(monkeypatch):
    import mercato.llm.segments as S
    monkeypatch.setattr(S, "SEGMENTS", 40)
    bpe = B.ByteBpe(BPE.ranks, P.PATTERN)
    for k in range(20):
        texts = [f"x the {word} and the, {word}. of" for word in (f"w{chr(97 + k)}{chr(97 + j)}q" for j in range(26))]
        assert [x.tolist() for x in bpe.encode(texts)] == [LIBRARY.encode_ordinary(t) for t in texts]
        assert len(bpe.kept) <= 40 and len(bpe.lengths) <= 40 and {"the", "and", "of", "the,"} <= set(bpe.kept)


def test_workers_hold_no_memos_after_a_task(spark):
    pattern = P.PATTERN
    docs = edge_docs(spark)
    B.round_trip(docs.repartition(4), PATH, pattern).collect()
    B.encode(docs.repartition(4), PATH, pattern).collect()

    def held(batches):
        from mercato.llm.byte_bpe import batch, tokenizer
        for b in batches:
            bpe = tokenizer(PATH, pattern)
            yield batch("n long", [[len(bpe.kept) + len(bpe.words)]])

    rows = spark.range(8, numPartitions=8).mapInArrow(held, "n long").collect()
    assert [r.n for r in rows] == [0] * 8


def test_queue_gives_ranks_in_order():
    rnd = random.Random(2)
    q, held = B.RankQueue(200_000), {}
    for _ in range(2000):
        if held and rnd.random() < 0.4:
            r = q.lowest()
            assert r == min(held) and q.take(r) == sorted(held.pop(r))
        else:
            r, p = rnd.randrange(200_000), rnd.randrange(1000)
            if r in held:
                q.bucket[r].append(p)
                held[r].append(p)
            else:
                q.open(r, [p])
                held[r] = [p]
    while held:
        r = q.lowest()
        assert r == min(held) and q.take(r) == sorted(held.pop(r))
    assert q.lowest() == -1


def test_documents(spark):
    docs = load(spark, "sf0.001", "documents").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in B.round_trip(docs, PATH, P.PATTERN).collect():
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == sha256(texts[r.doc_id].encode()).hexdigest()
    back = B.decode(B.encode(docs, PATH, P.PATTERN), PATH, P.PATTERN)
    assert {r.doc_id: bytes(r.bytes).decode() for r in back.collect()} == texts


def test_edge_rows(spark):
    rows = B.round_trip(edge_docs(spark), PATH, P.PATTERN).collect()
    assert len(rows) == 15 and all(r.n_tokens == 0 and r.ids_sha256 == sha256(b"").hexdigest() for r in rows if r.doc_id in (1, 2))
    assert B.round_trip(edge_docs(spark, []), PATH, P.PATTERN).collect() == []
