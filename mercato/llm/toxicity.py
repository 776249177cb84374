"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

Kernel. Two strings are compared by their common subsequences of ``ORDER``
characters; an occurrence that spans s characters weighs ``DECAY ** s``, and
spans above ``SPAN`` weigh nothing. The kernel is normalised. Gaps cost little,
so "id.io-t" stays near "idiot".

Model. Sentences carry their document's label. In them each term is counted by
its contexts: the distinct neighbours it stands between, toxic only if no clean
sentence has the same three words. So a document's copies add nothing to its
chance words, while an insult, which turns up anywhere, gathers evidence.
Terms are the bags' instances: a toxic document has at least one toxic term, a
clean one none. Landmarks are terms of both kinds; every training term is mapped
to K(x, landmarks) K(landmarks, landmarks)^-1/2, and a linear SVM with squared
hinge loss is fitted there. Its offset is fixed at OFFSET: a term that is like no
landmark is clean. The decision is then a sum of landmark kernels,

    f(x) = <psi(x), V> / |psi(x)| + OFFSET,   V = sum_j alpha_j psi(landmark_j) / |psi(landmark_j)|,

which is evaluated through V, a table over the subsequences of the landmarks.
This is the same number, at a cost that does not depend on the landmark count.

Document score. All terms of the whole text are scored; a logistic function
of the strongest one, fitted on the training documents, gives 0 to 1: one clear
insult is enough, whatever the length of the text.

Null and empty texts have no terms and get the score of a text without toxic
terms. Without training rows of both labels, or toxic terms, every score is 0. Repeated
labels of a document count as toxic if any of them says so; null labels are
ignored. Only doc_id and text of the documents are read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import Cache, batch, keep, pieces, tidy, tune

ORDER = 3            # characters of a subsequence
DECAY = 0.6          # weight of each character that a subsequence spans
SPAN = 7             # longest span
WINDOW = 24          # characters of a term; longer ones are cut into overlapping windows
LETTERS = 64         # character classes
MAX_DOCS = 6000      # labelled documents of each label that are learned from
MAX_TERMS = 3000     # training terms of each kind
LANDMARKS = 240      # Nyström landmarks
OFFSET = -1.0        # value of a term that is like no landmark
EVIDENCE = 10.0      # log likelihood ratio from which a term counts as toxic
MINING = 2           # rounds that add the clean terms most mistaken for toxic ones
VIRTUAL = 40         # most frequent toxic terms that get virtual gapped examples
GAPPED = 0.05        # weight of such an example, of its term's
CUT = 0.3            # scores from here on predict label 1
HELD_OUT = 2         # remainder of crc32(doc_id) mod 4 that is never learned from

_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def _class_of(points: np.ndarray) -> np.ndarray:
    """Character classes of code points: a-z as 1..26, 0-9 as 27, others by code point."""
    x = points.astype(np.int64)
    return np.where((x >= 97) & (x <= 122), x - 96, np.where((x >= 48) & (x <= 57), 27, 28 + x % 36)).astype(np.int32)


def classes(term: str) -> np.ndarray:
    """The classes of a term's characters between two edge marks (0)."""
    return np.concatenate([[0], _class_of(np.frombuffer(term.encode("utf-32-le", "replace"), "<u4")), [0]]).astype(np.int32)


def terms(text: str | None) -> set[str]:
    """Distinct lower-cased terms of the whole text: what stands between white
    space; runs of three or more single characters joined ("i d i o t"); a term
    over WINDOW characters as windows that overlap by half."""
    found = text.lower().split() if text else []
    out = set(found)
    single = [i for i, t in enumerate(found) if len(t) == 1]
    run: list[int] = []
    for i in [*single, -9]:
        if run and i != run[-1] + 1:
            if len(run) > 2:
                out.add("".join(found[k] for k in run))
            run = []
        run.append(i)
    for t in [t for t in out if len(t) > WINDOW]:
        out.discard(t)
        t = bare(t)
        out.update(t[i:i + WINDOW] for i in range(0, max(1, len(t) - WINDOW // 2), WINDOW // 2))
    return out


def bare(term: str) -> str:
    """The term's letters and digits."""
    return term if term.isalpha() else "".join(c for c in term if c.isalnum())


@lru_cache(maxsize=256)
def _picks(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index triples of a string of n characters within SPAN, and their weights."""
    found = [(i, *rest) for i in range(n) for rest in combinations(range(i + 1, min(n, i + SPAN)), ORDER - 1)]
    picks = np.array(found, np.int32).reshape(-1, ORDER)
    return picks, DECAY ** (picks[:, -1] - picks[:, 0] + 1).astype(np.float64)


def features(found: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per term its subsequence codes and normalised weights; equal codes are summed."""
    out = []
    for t in found:
        x = classes(t[:WINDOW])
        picks, weights = _picks(len(x))
        code = np.zeros(len(picks), np.int64)
        for k in range(ORDER):
            code = code * LETTERS + x[picks[:, k]]
        code, at = np.unique(code, return_inverse=True)
        total = np.bincount(at, weights, len(code)) if len(code) else np.empty(0)
        out.append((code, total / (np.sqrt((total ** 2).sum()) or 1.0)))
    return out


def gram(a: list[tuple[np.ndarray, np.ndarray]], b: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Normalised kernel values between two lists of featured terms."""
    used = np.unique(np.concatenate([c for c, _ in b] or [np.empty(0, np.int64)]))
    dense = np.zeros((len(used) + 1, len(b)))
    for j, (code, w) in enumerate(b):
        dense[np.searchsorted(used, code), j] = w
    out = np.zeros((len(a), len(b)))
    for i, (code, w) in enumerate(a):
        at = np.searchsorted(used, code)
        ok = (at < len(used)) & (used[np.minimum(at, len(used) - 1)] == code) if len(used) else np.zeros(len(code), bool)
        out[i] = w[ok] @ dense[at[ok]]
    return out


@dataclass
class Model:
    table: np.ndarray            # V over the subsequence codes, flat
    logit: tuple[float, float] = (1.0, 0.0)    # slope and constant of the document's score

    def score_terms(self, found: list[str]) -> np.ndarray:
        """f(x) of distinct terms, computed together for terms of one length."""
        out = np.full(len(found), OFFSET)
        by: dict[int, list[int]] = {}
        for i, t in enumerate(found):
            by.setdefault(min(len(t), WINDOW) + 2, []).append(i)
        for n, at in by.items():
            picks, weights = _picks(n)
            if not len(picks):
                continue
            for part in pieces(at, 512):
                points = np.frombuffer("".join(found[i][:WINDOW] for i in part).encode("utf-32-le", "replace"), "<u4")
                x = np.zeros((len(part), n), np.int32)
                x[:, 1:-1] = _class_of(points).reshape(len(part), n - 2)
                code = np.zeros((len(part), len(picks)), np.int32)
                for k in range(ORDER):
                    code = code * LETTERS + x[:, picks[:, k]]
                out[part] += (self.table[code] @ weights) / np.sqrt(_norms(code, picks[:, -1] - picks[:, 0]))
        return out

    def document(self, strongest: float) -> float:
        return float(1 / (1 + np.exp(-min(30.0, max(-30.0, strongest * self.logit[0] + self.logit[1])))))


def _norms(code: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Squared norms per row: weights of equal codes are summed first."""
    packed = np.sort(code * 8 + spans.astype(np.int32), axis=1)  # spans are below 8
    total = np.cumsum(DECAY ** np.arange(1, 9)[packed & 7], axis=1)
    code = packed >> 3
    last = np.ones(code.shape, bool)
    last[:, :-1] = code[:, 1:] != code[:, :-1]
    rows, cols = np.nonzero(last)
    ends = total[rows, cols]
    sums = np.diff(ends, prepend=0.0)
    first = np.ones(len(rows), bool)
    first[1:] = rows[1:] != rows[:-1]
    sums[first] = ends[first]
    return np.bincount(rows, sums ** 2, len(code))


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, rounds: int = 40) -> np.ndarray:
    """Linear SVM of fixed offset with squared hinge loss by Newton steps on the active rows."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        on = y * (x @ w + OFFSET) < 1
        xa = x[on] * weight[on, None]
        new = np.linalg.solve(np.eye(len(w)) + 2 * c * x[on].T @ xa, 2 * c * xa.T @ (y[on] - OFFSET))
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> np.ndarray:
    xb = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(xb.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(xb @ w, -30, 30)))
        h = xb.T @ (xb * (weight * p * (1 - p) + 1e-9)[:, None]) + 0.5 * np.eye(len(w))
        step = np.linalg.solve(h, xb.T @ (weight * (y - p)) - 0.5 * w)
        w += step
        if np.abs(step).max() < 1e-7:
            break
    return w


def strongest(scores: np.ndarray) -> float:
    """The largest score of a document's terms, cut to [-2, 2]; -2 where it has none."""
    return float(np.clip(scores.max(initial=-2.0), -2, 2))


def _contexts(batches):
    """(term, context, toxic): the terms of labelled sentences with a hash of their
    neighbours; of terms that are no word of the sentence, with that of the sentence."""
    for b in batches:
        for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            found = set()
            for s in _SENTENCE.split(text or ""):
                words = ["", *map(bare, s.lower().split()), ""]
                whole = terms(s)
                found.update((w, xxhash.xxh3_64_intdigest(f"{a} {z}") >> 1) for a, w, z in zip(words, words[1:], words[2:])
                             if w and len(w) <= WINDOW)
                known = set(words)
                found.update((t, xxhash.xxh3_64_intdigest(s) >> 1) for t in map(bare, whole) if t and t not in known)
            for part in pieces(sorted(found), 5000):
                yield batch("term string, context long, toxic int", (*zip(*part), [toxic] * len(part)))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Model | None:
    """Learn from at most ``max_docs`` labelled documents of each label (those
    with the smallest hash of doc_id), never from held-out ones. A label's documents
    weigh all / picked, so scores mean the same whatever share of a label is picked."""
    labels = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    labels = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != HELD_OUT)
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labels = keep(labels, "labels")
    every = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = {y: max(1.0, every.get(y, 0) / max_docs) for y in (0, 1)}
    picked = None
    for y in (0, 1):
        part = labels.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
        picked = part if picked is None else picked.unionByName(part)
    # At most 2 * max_docs rows of two numbers: a proven bound for the broadcast.
    sample = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "text")
    sample = keep(sample, "labelled").groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    found = sample.select("toxic", "text").mapInArrow(lambda it: tidy(_contexts(it)), "term string, context long, toxic int")
    found = found.groupBy("term", "context").agg(F.min("toxic").alias("toxic"))
    counts = keep(found.groupBy("term").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")), "term_counts")
    # Weights for the terms: relative ones, as no document is more evidence than its own.
    bad, good = (F.col(c) * (weight[y] / min(weight.values())) for c, y in (("bad", 1), ("good", 0)))
    rate = counts.agg((F.sum(bad) / (F.sum(bad) + F.sum(good))).alias("r")).first()["r"]
    if not rate or rate >= 1:
        return None
    share = bad / (bad + good)
    # Log likelihood ratio of a term's own rate of toxic contexts against the overall rate.
    ratio = bad * F.log(share / rate) + F.when(F.col("good") > 0, good * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    rare = counts.where("bad > 0").where((share > 0.7) & (ratio > EVIDENCE)).orderBy(F.desc("bad"), "term").limit(MAX_TERMS)
    usual = counts.where(share <= 0.5)
    bad = {r["term"]: r["bad"] for r in rare.collect()}
    good = {r["term"]: r["good"] for order in (F.desc("good"), F.xxhash64("term")) for r in usual.orderBy(order, "term").limit(MAX_TERMS).collect()}
    if not bad or not good:
        return None
    marks: dict[str, int] = {}
    for _ in range(MINING):
        table = _fit_terms(bad, good, marks)
        # All clean terms are scored; the worst mistaken join the training set,
        # and those of them that weigh most become landmarks too.
        judged = usual.select("term", "good").mapInArrow(lambda it: tidy(_judged(it, table)), "term string, good long, value double")
        judged = keep(judged, "judged_terms")
        good |= {r["term"]: r["good"] for r in judged.orderBy(F.desc("value"), "term").limit(MAX_TERMS // 2).collect()}
        loss = F.greatest(F.col("value") - OFFSET, F.lit(0.0)) * F.sqrt("good")
        marks |= {r["term"]: r["good"] for r in judged.orderBy(loss.desc(), "term").limit(LANDMARKS // 2).collect()}
        good |= marks
    model = Model(_fit_terms(bad, good, marks))
    # A row of two numbers for each sampled document.
    rows = sample.select("toxic", "text").mapInArrow(lambda it: _strongest(it, model), "toxic int, s double").toPandas()
    y = rows["toxic"].to_numpy(float)
    slope, constant = fit_logistic(rows[["s"]].to_numpy(), y, np.where(y > 0, weight[1], weight[0]))
    model.logit = (float(slope), float(constant))
    return model


def _judged(batches, table):
    model = Model(table)
    for b in batches:
        t = b.column(0).to_pylist()
        yield batch("term string, good long, value double", (t, b.column(1).to_pylist(), model.score_terms(t)))


def gapped(term: str) -> list[str]:
    """Virtual examples of a term: a character repeated or a stray letter inserted."""
    return [term[:i] + c + term[i:] for i in range(1, len(term)) for c in (term[i], "xqjzk"[i % 5])]


def _fit_terms(bad: dict[str, int], good: dict[str, int], extra: dict[str, int]) -> np.ndarray:
    """The table V of the Nyström SVM on terms of both kinds; the clean terms ``extra`` are landmarks too."""
    bad = {g: GAPPED * bad[t] for t in sorted(bad, key=lambda t: (-bad[t], t))[:VIRTUAL] for g in gapped(t) if g not in good} | bad
    names = list(bad) + list(good)
    y = np.array([1.0] * len(bad) + [-1.0] * len(good))
    size = np.array([*bad.values(), *good.values()], float)
    weight = np.sqrt(size)
    for side in (1.0, -1.0):  # both kinds weigh the same in all
        weight[y == side] /= weight[y == side].sum()
    weight *= len(names) / 2
    psi = features(names)
    mined = [len(bad) + i for i, t in enumerate(good) if t in extra]
    marks = [psi[i] for i in dict.fromkeys(_landmarks(psi, y, LANDMARKS) + mined)]
    inner = gram(marks, marks)
    value, vector = np.linalg.eigh(inner)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    alpha = root @ fit_svm(gram(psi, marks) @ root, y, weight)
    table = np.zeros(LETTERS ** ORDER)
    for a, (code, weights) in zip(alpha, marks):
        table[code] += a * weights
    return table


def _landmarks(psi, y: np.ndarray, count: int) -> list[int]:
    """Half of the landmarks of either kind, each the term least like those chosen (its
    largest kernel value to them is smallest); the first is the most frequent."""
    chosen = []
    for side in (1.0, -1.0):
        at = np.flatnonzero(y == side)
        codes, own = np.unique(np.concatenate([psi[i][0] for i in at]), return_inverse=True)
        weights = np.concatenate([psi[i][1] for i in at])
        ends = np.cumsum([len(psi[i][0]) for i in at])
        near, pick, one = np.zeros(len(at)), 0, np.zeros(len(codes))
        for _ in range(min(count // 2, len(at))):
            chosen.append(int(at[pick]))
            code, w = psi[at[pick]]
            one[np.searchsorted(codes, code)] = w
            sums = np.concatenate([[0.0], np.cumsum(weights * one[own])])[ends]
            near = np.maximum(near, np.diff(sums, prepend=0.0))      # kernel values to the one chosen last
            one[:] = 0
            near[pick] = 2.0
            pick = int(np.argmin(near))
            if near[pick] > 0.98:
                break
    return chosen


def _scorer(model: Model):
    """Scores of raw terms: distinct unknown terms are scored together, and kept."""
    known = Cache(None, 250_000)

    def score(found: set[str]) -> np.ndarray:
        new = [t for t in found if t not in known]
        if len(known) + len(new) > known.limit:
            known.clear()
            new = list(found)
        for part in pieces(new, 20_000):
            plain = [bare(t) for t in part]
            once = list(dict.fromkeys(plain))
            value = dict(zip(once, model.score_terms(once).tolist()))
            known.update(zip(part, map(value.__getitem__, plain)))
        return np.fromiter((known[t] for t in found), float, len(found))

    return score


def _strongest(batches, model: Model):
    score = _scorer(model)
    for b in batches:
        yield batch("toxic int, s double", (b.column("toxic").to_pylist(), [strongest(score(terms(t))) for t in b.column("text").to_pylist()]))


def _scored(batches, model: Model | None):
    score = _scorer(model) if model else None
    for b in batches:
        ids = b.column(0).to_pylist()
        out = [0.0] * len(ids)
        if model:
            found = [terms(t) for t in b.column(1).to_pylist()]
            score(set().union(*found) if found else set())
            out = [model.document(strongest(score(f))) for f in found]
        yield batch("doc_id long, held_out boolean, score double, predicted int", (
            ids, [zlib.crc32(str(i).encode()) % 4 == HELD_OUT if i is not None else False for i in ids], out, [int(s >= CUT) for s in out]))


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    tune(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB whatever the corpus
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(lambda it: tidy(_scored(it, sent.value)), "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    tune(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return score_documents(docs, train(docs, labels, max_docs))


def _harmless(batches, model: Model, at: int):
    score = _scorer(model)
    for b in batches:
        found = [terms(t) for t in b.column(at).to_pylist()]
        score(set().union(*found) if found else set())
        ok = [i for i, f in enumerate(found) if model.document(strongest(score(f))) < CUT]
        yield b.take(pa.array(ok, pa.int64()))


def without_toxic(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are."""
    tune(docs.sparkSession)
    model = train(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), labels, max_docs)
    if model is None:
        return docs
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")
    return docs.mapInArrow(lambda it: tidy(_harmless(it, sent.value, at)), docs.schema)
