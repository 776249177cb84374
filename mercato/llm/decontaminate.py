"""Benchmark decontamination: BM25 over an inverted index of test items, searched with block-max WAND.

Index. A test item is cut into chunks of at most ``CHUNK`` words; chunks are
the indexed entries. Document frequencies are counted over all items. A
posting's impact is the BM25 contribution of its term, divided by the chunk's
score against itself, so one threshold ``ALPHA`` fits chunks of any length.
Postings are kept in blocks of ``POSTINGS`` entries with their largest impact.

Search. Every passage of every text is a query: windows of ``2 * CHUNK`` words
that step by ``CHUNK``, so whatever stands in a text over CHUNK words or less
lies whole in one window. Ranges of entries whose summed largest impacts stay
below ALPHA are passed over for all windows of a text at once; the rest is
walked by block-max WAND, which returns every entry at or above ALPHA.

Check. For each retrieved item, the word n-grams of its question (all
sentences but the last) and its answer (the last sentence; both are the whole
item if it has one) are sought around the window. A pair is reported when half
of the item's n-grams, or ``QUESTION`` of the question's, are there.

The index is built in blocks of items of at most ``INDEX_BYTES`` of text, one
after another, and each block is broadcast; the result does not depend on the
blocks. Items without a word match nothing; a repeated item is searched once
for each item_id. Null and empty texts match nothing.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import batch, keep, tidy, tune

CHUNK = 48
ALPHA = 0.5
K1, B = 1.2, 0.75
POSTINGS = 8
RANGES = 100           # ranges of entries in the first bound
NGRAM = 4
SHARE, QUESTION = 0.5, 0.7
INDEX_BYTES = 2 << 20  # text bytes of the items in one broadcast index

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
OUT = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def parts(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer of an item."""
    sentences = [w for s in _SENTENCE.split(text) if (w := words(s))]
    if len(sentences) < 2:
        return words(text), words(text)
    return [w for s in sentences[:-1] for w in s], sentences[-1]


def ngrams(found: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(found[i:i + n]) for i in range(len(found) - n + 1)}


class Index:
    """Impact-ordered blocks of postings over the chunks of some items."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n_items: int, mean_words: float):
        self.items = [(i, *parts(t)) for i, t in items]
        entries = []                                     # (item position, terms)
        for at, (_, text) in enumerate(items):
            w = words(text)
            n = -(-len(w) // CHUNK)
            entries += [(at, w[len(w) * k // n:len(w) * (k + 1) // n]) for k in range(n)]
        # Neighbours in the index share words, so that a range's largest impacts stay close to an entry's own.
        entries.sort(key=lambda e: (sorted(Counter(e[1]).items(), key=lambda x: (-x[1], x[0]))[0], e[0]))
        self.entry_item = [e[0] for e in entries]
        postings: dict[str, list[tuple[int, float]]] = {}
        for at, (_, w) in enumerate(entries):
            tf = Counter(w)
            norm = K1 * (1 - B + B * len(w) / mean_words)
            impact = {t: np.log1p((n_items - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + norm) for t, f in tf.items()}
            whole = sum(impact.values())
            for t, x in impact.items():
                postings.setdefault(t, []).append((at, x / whole))
        self.term = {t: i for i, t in enumerate(postings)}
        self.entry = [[p[0] for p in x] for x in postings.values()]
        self.impact = [[p[1] for p in x] for x in postings.values()]
        self.most = [max(x) for x in self.impact]
        self.block_most = [[max(x[i:i + POSTINGS]) for i in range(0, len(x), POSTINGS)] for x in self.impact]
        self.width = max(1, -(-len(entries) // RANGES))
        self.bound = np.zeros((len(postings) + 1, -(-len(entries) // self.width) or 1), np.float32)
        for i, (e, x) in enumerate(zip(self.entry, self.impact)):
            np.maximum.at(self.bound[i], np.array(e) // self.width, np.array(x, np.float32))

    def windows(self, ids: np.ndarray, alpha: float):
        """(start, terms, ranges) of the windows of a text that may hold an
        entry: per half window the largest impacts of its distinct terms are
        summed for each range, and a window has two halves."""
        half, known = np.arange(len(ids)) // CHUNK, ids < len(self.term)
        key = np.unique(half[known] * (len(self.term) + 1) + ids[known])
        half, ids = key // (len(self.term) + 1), key % (len(self.term) + 1)
        which, first = np.unique(half, return_index=True)
        if not len(which):
            return
        for low in range(0, len(which), 512):            # long texts in pieces
            some = slice(low, min(len(which), low + 513))
            ends = [*first[some], first[some.stop] if some.stop < len(which) else len(ids)]
            total = np.add.reduceat(self.bound[ids[ends[0]:ends[-1]]], np.array(ends[:-1]) - ends[0], axis=0)
            for k in range(min(512, len(total))):
                two = k + 1 < len(total) and which[low + k + 1] == which[low + k] + 1
                bound = total[k] + total[k + 1] if two else total[k]
                if bound.max() >= alpha - 1e-4:
                    terms = set(ids[ends[k]:ends[k + 2 if two else k + 1]].tolist())
                    yield int(which[low + k]) * CHUNK, terms, np.flatnonzero(bound >= alpha - 1e-4).tolist()

    def search(self, terms: set[int], low: int, high: int, alpha: float) -> list[tuple[int, float]]:
        """Block-max WAND: all entries in [low, high) that score ``alpha`` or more."""
        cursors = []                                     # [entry, position, term]
        for t in terms:
            e = self.entry[t]
            p = bisect_left(e, low)
            if p < len(e) and e[p] < high:
                cursors.append([e[p], p, t])
        found = []

        def forward(c: list, target: int) -> None:
            e = self.entry[c[2]]
            c[1] = bisect_left(e, target, c[1])
            c[0] = e[c[1]] if c[1] < len(e) else high

        while True:
            cursors = sorted(c for c in cursors if c[0] < high)
            bound, pivot = 0.0, None
            for k, c in enumerate(cursors):
                bound += self.most[c[2]]
                if bound >= alpha - 1e-9:
                    pivot = k
                    break
            if pivot is None:
                return found
            at = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == at:
                pivot += 1
            head = cursors[:pivot + 1]
            block, ends = 0.0, []
            for c in head:                               # the block that holds the pivot entry
                e = self.entry[c[2]]
                p = bisect_left(e, at, c[1])
                if p < len(e):
                    block += self.block_most[c[2]][p // POSTINGS]
                    ends.append(e[min(len(e), (p // POSTINGS + 1) * POSTINGS) - 1] + 1)
            if block < alpha - 1e-9:                     # nothing up to the first block's end can qualify
                after = min([*ends, *(c[0] for c in cursors[pivot + 1:pivot + 2]), high])
                target = max(after, at + 1)
            elif head[0][0] == at:
                score = sum(self.impact[c[2]][c[1]] for c in head)
                if score >= alpha - 1e-9:
                    found.append((at, score))
                target = at + 1
            else:
                target = at
            for c in head:
                if c[0] < target:
                    forward(c, target)

    def match(self, text: str | None, alpha: float):
        """(item position, score, overlap, question overlap, answer overlap) of the items a text holds."""
        w = words(text)
        if not w or not self.term:
            return []
        get, last = self.term.get, len(self.term)
        ids = np.fromiter(map(get, w, repeat(last)), np.int64, len(w))
        best: dict[int, tuple] = {}
        for start, terms, ranges in self.windows(ids, alpha):
            for r in ranges:
                for entry, score in self.search(terms, int(r) * self.width, (int(r) + 1) * self.width, alpha):
                    item = self.entry_item[entry]
                    row = (score, *self.overlaps(item, w, start))
                    if row[1] >= SHARE or row[2] >= QUESTION:
                        best[item] = max(best.get(item, row), row, key=lambda x: (x[1], x[2], x[3], x[0]))
        return [(item, *row) for item, row in best.items()]

    def overlaps(self, item: int, w: list[str], start: int) -> tuple[float, float, float]:
        _, question, answer = self.items[item]
        n = len(question) + len(answer)
        near = w[max(0, start - n):start + 2 * CHUNK + n]
        out, held, all_ = [], 0, 0
        for part in (question, answer):
            size = min(NGRAM, len(part))
            want = ngrams(part, size)
            got = len(want & ngrams(near, size))
            out.append(got / len(want))
            held, all_ = held + got, all_ + len(want)
        return held / all_, *out


def _matched(batches, index: Index, alpha: float):
    for b in batches:
        rows = []
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            rows += [(doc_id, index.items[i][0], *x) for i, *x in index.match(text, alpha)]
        yield batch(OUT, list(zip(*rows)) if rows else [[]] * 6)


def _item_words(batches):
    """The distinct terms of each item, and on the first of them its number of words."""
    for b in batches:
        rows = []
        for item_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            found = words(text)
            rows += [(item_id, text if not k else None, t, 0 if k else len(found)) for k, t in enumerate(sorted(set(found)))]
        yield batch("item_id long, text string, term string, n long", list(zip(*rows)) if rows else [[]] * 4)


def _unmatched(batches, index: Index, alpha: float, at: int):
    for b in batches:
        ok = [i for i, text in enumerate(b.column(at).to_pylist()) if not index.match(text, alpha)]
        yield b.take(pa.array(ok, pa.int64()))


def indexes(benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> Iterator[Index]:
    """An index for each block of items; document frequencies are those of all items."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()
    counted = items.mapInArrow(_item_words, "item_id long, text string, term string, n long")
    found = keep(counted, "item_words")
    items = found.where("n > 0").select("item_id", "text", "n")          # one row for each item with a word
    size = items.agg(F.count(F.lit(1)).alias("items"), F.sum("n").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if not size["items"]:
        return
    df = keep(found.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "item_terms")
    blocks = -(-size["bytes"] // index_bytes)
    of_block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    for k in range(blocks):
        terms = df.join(found.where(of_block == k).select("term").distinct(), "term", "left_semi")
        some = items.where(of_block == k).orderBy("item_id", "text")
        yield Index([(r["item_id"], r["text"]) for r in some.collect()], {r["term"]: r["df"] for r in terms.collect()}, size["items"], size["n"] / size["items"])


def contaminated(docs: DataFrame, benchmark: DataFrame, alpha: float = ALPHA, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """One row for each document and item whose overlap is verified."""
    spark = tune(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = []
    for index in indexes(benchmark, index_bytes):
        sent = spark.sparkContext.broadcast(index)
        found.append(docs.mapInArrow(lambda it, sent=sent: tidy(_matched(it, sent.value, alpha)), OUT))
    if not found:
        return spark.createDataFrame([], OUT)
    return reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(
        *(F.max(c).alias(c) for c in ("score", "overlap", "question_overlap", "answer_overlap")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, alpha: float = ALPHA, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns as they are."""
    spark, at = tune(docs.sparkSession), docs.columns.index("text")
    for index in indexes(benchmark, index_bytes):
        sent = spark.sparkContext.broadcast(index)
        docs = docs.mapInArrow(lambda it, sent=sent: tidy(_unmatched(it, sent.value, alpha, at)), docs.schema)
    return docs
