"""Periodic runs of words: the maximal stretches that repeat a block at least three times.

A run is a stretch of consecutive words with least period q (words q apart are
identical), at least ``LEAST`` words and ``PERIODS`` periods long, that no
neighbouring word extends. All runs of a document are found from common
extensions in two suffix trees:

1. Ukkonen's algorithm builds the suffix tree of the words and that of their
   reversal. Both end in a symbol of their own, so no suffix is another's start.
2. An Euler tour numbers the leaves. Of the visits between two neighbouring
   leaves only the shallowest is kept, and a sparse table of minima over them
   gives the depth of any two leaves' lowest common ancestor, which is how far
   the two positions agree (LCE), in constant time.
3. A run's Lyndon root, in one order of the words or in its inverse, is the
   longest Lyndon word at its position; that word ends before the next smaller
   (larger) suffix. So each position has two candidates (i, j) of period j - i.
   Each is extended to the right by the first tree and to the left by the second.

Before that a document is cut down to the stretches that may hold a run. In a
run every block of ``BLOCK`` words occurs again one period on or back, as
LEAST - BLOCK + 1 >= 2 q and 3 q - BLOCK + 1 >= 2 q hold for the q in question.
So a block that occurs once in a document (then: in a stretch) lies in no run.
The rule loses nothing; a false match of two block hashes only leaves a stretch
in that holds no run. The stretches of one document, kept apart by symbols of
their own, share its two trees.

Words are ``[^\\x20\\x09-\\x0D]+``. A null, empty or blank text has no words and
no runs. A repeated row or doc_id is worked on again, row by row; a null doc_id
stays null. Other columns are not read, whatever their names. Ties for the
strongest run go to the smallest start, then period. An empty table gives an
empty result. Whole texts are used; memory grows with one document's stretches
(about 0.5 kB a word of them), so a very long text costs only where it repeats.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import batch, tune

LEAST = 24       # words of a run, at least
PERIODS = 3      # periods of a run, at least
BLOCK = 9        # words; the argument above holds for 9 and the two limits

#: Words and doc_id to the words that are searched.
Rewrite = Callable[[np.ndarray, "int | None"], np.ndarray]


class SuffixTree:
    """Ukkonen's suffix tree of a list of symbols, whose last occurs once.

    ``rank`` is each suffix's place in sorted order; ``lce`` gives the length of
    the longest common prefix of suffixes, for arrays of pairs."""

    def __init__(self, symbols: list[int]):
        start, end, leaves, kids, width = self._grown(symbols)
        self._tour(np.array(start), np.array(end), leaves, kids, width)

    @staticmethod
    def _grown(s: list[int]):
        n, width = len(s), max(s) + 1
        start, end, link = [0], [0], [0]
        kids: dict[int, int] = {}                     # parent * width + first symbol -> node
        leaves: list[int] = []                        # in the order of their suffixes
        node = length = edge = waiting = 0
        for i, c in enumerate(s):
            waiting += 1
            last = 0                                  # an inner node that lacks its suffix link
            while waiting:
                if not length:
                    edge = i
                key = node * width + s[edge]
                below = kids.get(key)
                if below is None:
                    kids[key] = len(start)
                    leaves.append(len(start))
                    start.append(i), end.append(n), link.append(0)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    at = start[below]
                    span = end[below] - at
                    if length >= span:                # walk down
                        edge += span
                        length -= span
                        node = below
                        continue
                    if s[at + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    split = kids[key] = len(start)
                    start.append(at), end.append(at + length), link.append(0)
                    kids[split * width + c] = split + 1
                    leaves.append(split + 1)
                    start.append(i), end.append(n), link.append(0)
                    start[below] = at + length
                    kids[split * width + s[at + length]] = below
                    if last:
                        link[last] = split
                    last = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        return start, end, leaves, kids, width

    def _tour(self, start, end, leaves, kids, width) -> None:
        nodes = len(start)
        keys, below = (np.fromiter(x, np.int64, len(kids)) for x in (kids.keys(), kids.values()))
        order = np.argsort(-keys)                     # children of one parent together, the last symbol first
        parents = keys[order] // width
        child = below[order].tolist()
        low = np.searchsorted(-parents, -np.arange(nodes), "left").tolist()
        high = np.searchsorted(-parents, -np.arange(nodes), "right").tolist()
        parent = np.zeros(nodes, np.int64)
        parent[below] = keys // width
        up, size = parent.tolist(), (end - start).tolist()
        depth, visits, stack = [0] * nodes, [], [0]
        while stack:
            v = stack.pop()
            visits.append(v)
            depth[v] = depth[up[v]] + size[v]
            if low[v] < high[v]:
                stack.extend(child[low[v]:high[v]])
        visited, depths = np.array(visits), np.array(depth, np.int32)
        suffix = np.full(nodes, -1, np.int64)
        suffix[leaves] = np.arange(len(leaves))
        at = np.flatnonzero(suffix[visited] >= 0)     # the tour's leaves, in sorted order
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[suffix[visited[at]]] = np.arange(len(leaves))
        # Behind a leaf the tour climbs to the parent of the node it enters next.
        self.minima = [depths[parent[visited[at[:-1] + 1]]]]
        span = 1
        while 2 * span <= len(self.minima[0]):
            row = self.minima[-1]
            self.minima.append(np.minimum(row[:-span], row[span:]))
            span *= 2

    def lce(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes a and b, a != b."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            here = level == k
            row = self.minima[k]
            out[here] = np.minimum(row[low[here]], row[high[here] - (1 << k)])
        return out


def _next_smaller(rank: list[int]) -> list[int]:
    """For each position the next one of smaller rank; -1 where there is none."""
    out, stack = [-1] * len(rank), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def runs_of(symbols: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> np.ndarray:
    """All runs of an array of symbols: rows (start, length, period) by start, then period."""
    _, codes = np.unique(symbols, return_inverse=True)
    n = len(codes)
    text = (codes.ravel() + 1).tolist()
    tree, mirror = SuffixTree([*text, 0]), SuffixTree([*text[::-1], 0])
    found = []
    for rank in (tree.rank, n - tree.rank):
        j = np.array(_next_smaller(rank[:n].tolist()))
        i = np.arange(n)
        here = (j >= 0) & (periods * (j - i) <= n)
        i, j = i[here], j[here]
        left, right = mirror.lce(n - i, n - j), tree.lce(i, j)
        found.append(np.stack([i - left, j + right - i + left, j - i], 1))
    rows = np.concatenate(found)
    rows = rows[(rows[:, 1] >= least) & (rows[:, 1] >= periods * rows[:, 2])]
    rows = np.unique(rows, axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def _again(codes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each word, whether the block that begins there occurs again in its group."""
    n = len(codes) - BLOCK + 1
    if n < 1:
        return np.zeros(len(codes), bool)
    h, span = _mixed(codes + 1), 1
    with np.errstate(over="ignore"):
        for take in (1, 2, 4, 1):                     # blocks of 2, 4, 8 and 9 words
            more = h[span:len(codes) - take + 1] if take == span else _mixed(codes[span:] + 1)
            h = h[:len(more)] * np.uint64(0xD6E8FEB86659FD93) + more
            span += take
        h = (h ^ h >> np.uint64(31)) + _mixed(group[:n] + 7)
    order = np.argsort(h)
    same = np.diff(h[order]) == 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    twice &= group[:n] == group[BLOCK - 1:]           # a block lies within one group
    return np.concatenate([twice, np.zeros(BLOCK - 1, bool)])


def stretches(codes: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Where runs may lie, as [start, stop) in ascending order: each stretch lies
    in one document (``ends``: their ends) and every run within one stretch."""
    starts = np.concatenate([[0], ends[:-1]])
    stops = ends
    held = -1
    while held != int((stops - starts).sum()):        # until all blocks of a stretch occur in it again
        held = int((stops - starts).sum())
        wide = stops - starts >= LEAST
        starts, sizes = starts[wide], (stops - starts)[wide]
        if not len(starts):
            return []
        first = np.cumsum(sizes) - sizes
        index = np.arange(sizes.sum()) + np.repeat(starts - first, sizes)
        group = np.repeat(np.arange(len(starts)), sizes)
        twice = _again(codes[index], group)
        edge = np.diff(np.concatenate([[0], twice.view(np.int8), [0]]))
        # A block at a stretch's last BLOCK - 1 words doesn't exist: no row of
        # blocks passes from one stretch to the next.
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        starts, stops = index[a], index[b - 1] + BLOCK
    return list(zip(starts.tolist(), stops.tolist()))


def _runs_in(codes: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
    """The runs of one document, found in its stretches: they share the two
    trees, kept apart by symbols that occur once."""
    top = int(codes.max()) + 1
    joined, shift, at = [], [], 0
    for k, (a, b) in enumerate(parts):
        joined += [codes[a:b], np.array([top + k])]
        shift.append((at, a - at))
        at += b - a + 1
    rows = runs_of(np.concatenate(joined[:-1]))
    begins, moves = (np.array(x) for x in zip(*shift))
    rows[:, 0] += moves[np.searchsorted(begins, rows[:, 0], "right") - 1]
    # The last words of a stretch may begin the next one.
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word codes of all texts behind one another, where each text ends, and the words of the codes."""
    codes: dict[bytes, int] = {}
    out, ends, n = [], [], 0
    for text in texts.to_pylist():
        words = text.split() if text else ()
        out.append(np.fromiter([codes.setdefault(w, len(codes)) for w in words], np.int64, len(words)))
        n += len(words)
        ends.append(n)
    return np.concatenate(out) if out else np.empty(0, np.int64), np.array(ends, np.int64), list(codes)


def documents_runs(batches, rewrite: Rewrite | None) -> Iterator[tuple[list, list[np.ndarray], list[np.ndarray], list[bytes]]]:
    """Per batch of (doc_id, text as bytes): doc_ids, each document's word codes and runs, the words."""
    for b in batches:
        ids = b.column(0).to_pylist()
        codes, ends, words = coded(b.column(1))
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        if rewrite:
            for i, a, e in zip(ids, starts.tolist(), ends.tolist()):
                codes[a:e] = rewrite(codes[a:e], i)
        found: dict[int, list[tuple[int, int]]] = {}
        for a, e in stretches(codes, ends) if len(codes) else []:
            k = int(np.searchsorted(ends, a, "right"))
            found.setdefault(k, []).append((a - int(starts[k]), e - int(starts[k])))
        own = [codes[a:e] for a, e in zip(starts.tolist(), ends.tolist())]
        none = np.empty((0, 3), np.int64)
        yield ids, own, [_runs_in(own[k], found[k]) if k in found else none for k in range(len(ids))], words


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words no run contains behind its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge)[:n] == 0


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run of the greatest exact length / period; ties: smallest start, then period."""
    if not len(runs):
        return None
    near = runs[:, 1] / runs[:, 2]
    best = runs[near >= near.max() * (1 - 1e-12)]     # all that doubles can't tell apart
    return tuple(max(best.tolist(), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])))


def _collapsed(words: list[bytes], codes: np.ndarray, runs: np.ndarray) -> bytes:
    kept = codes[kept_words(len(codes), runs)] if len(runs) else codes
    return b" ".join(map(words.__getitem__, kept.tolist()))


SUMMARY = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string")


def _summaries(batches, rewrite: Rewrite | None):
    for ids, codes, runs, words in documents_runs(batches, rewrite):
        rows = []
        for i, c, r in zip(ids, codes, runs):
            best = strongest(r)
            listed = "".join(f"{a},{n},{p}\n" for a, n, p in r.tolist()).encode()
            rows.append((i, len(r), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
                         sha256(listed).hexdigest(), sha256(_collapsed(words, c, r)).hexdigest()))
        if rows:
            yield batch(SUMMARY, zip(*rows))


def _listed(batches, rewrite: Rewrite | None):
    for ids, _, runs, _ in documents_runs(batches, rewrite):
        rows = [(i, *r) for i, found in zip(ids, runs) for r in found.tolist()]
        if rows:
            yield batch("doc_id long, start long, length long, period long", zip(*rows))


def _texts(batches, rewrite: Rewrite | None):
    for ids, codes, runs, words in documents_runs(batches, rewrite):
        yield batch("doc_id long, text string", (ids, [_collapsed(words, c, r).decode() for c, r in zip(codes, runs)]))


def _rows(docs: DataFrame) -> DataFrame:
    tune(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))


def list_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """Every run of every text: doc_id, start (word number from 0), length, period."""
    return _rows(docs).mapInArrow(lambda it: _listed(it, rewrite), "doc_id long, start long, length long, period long")


def collapse_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """doc_id and the text without the words that a run contains behind its
    first period, joined by one space (null text: empty)."""
    return _rows(docs).mapInArrow(lambda it: _texts(it, rewrite), "doc_id long, text string")


def run_summary(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """Per document: the number of runs, the strongest one and digests of all
    runs and of the collapsed text."""
    return _rows(docs).mapInArrow(lambda it: _summaries(it, rewrite), SUMMARY)


def planted(codes: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The periodic tail that one document in ten gets, by its doc_id (a null doc_id: none)."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(codes), h // 10
    if doc_id is None or h % 10 or not n:
        return codes
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([codes[:a], codes[a + np.arange(n - a) % p]])
