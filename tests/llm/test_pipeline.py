"""The pipeline's stages and its result against what each operator says of the rows it gets."""
from hashlib import sha256

import public_tokenizers as P
import tiktoken

import corpus_pipeline as pipeline
from edge import edge_docs, load
from mercato.llm import byte_bpe, decontaminate, registry, secrets, toxicity
from mercato.llm.common import keep
from test_near_dup import brute

SF = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "benchmark_decontamination", "secret_scan", "byte_bpe"]
    assert pipeline.ORACLE_SQL is None and len(registry.QUERIES) == 13


def test_every_stage_on_what_the_one_before_kept(spark):
    docs = load(spark, "sf0.01", "documents")
    columns, bench = docs.columns, load(spark, "sf0.01", "benchmark")
    stage = dict(pipeline.STAGES)
    text = lambda df: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}

    before = text(docs)
    predicted = toxicity.toxicity(docs, load(spark, "sf0.01", "labels")).where("predicted = 0")
    docs = keep(stage["toxicity"](spark, docs, SF), "t")
    assert docs.columns == columns and text(docs) == {r.doc_id: before[r.doc_id] for r in predicted.collect()}

    before = text(docs)
    docs = keep(stage["minhash_near_dedup"](spark, docs, SF), "t")
    groups = brute(list(before.items()))
    assert docs.columns == columns and text(docs) == {i: before[i] for i, (_, c) in groups.items() if i == c}

    before = text(docs)
    docs = keep(stage["benchmark_decontamination"](spark, docs, SF), "t")
    held = {i for i, t in before.items() if any(b.text in t for b in bench.collect())}
    assert docs.columns == columns and held and not held & text(docs).keys()
    found = {r.doc_id for r in decontaminate.contaminated(spark.createDataFrame(list(before.items()), "doc_id long, text string"), bench).collect()}
    assert text(docs) == {i: t for i, t in before.items() if i not in found}

    before = text(docs)
    docs = keep(stage["secret_scan"](spark, docs, SF), "t")
    assert docs.columns == columns
    for r in docs.collect():
        spans = secrets.base_spans(before[r.doc_id])
        assert r.text == secrets.redact(before[r.doc_id], spans) and r.n_chars == len(r.text)

    bpe = byte_bpe.tokenizer(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    want = {i: sha256(",".join(map(str, library.encode_ordinary(t))).encode()).hexdigest() for i, t in text(docs).items()}
    assert {r.doc_id: r.ids_sha256 for r in stage["byte_bpe"](spark, docs, SF).collect()} == want
    assert {r.doc_id: r.ids_sha256 for r in pipeline.run(spark, SF).collect()} == want


def test_edge_rows(spark):
    docs = edge_docs(spark)
    for name, f in pipeline.STAGES[:-1]:
        out = f(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        docs = keep(out, name)
    assert docs.count() > 5
    empty = edge_docs(spark, [])
    for _, f in pipeline.STAGES:
        assert f(spark, empty, "/root/testdata/sf0.001").collect() == []
