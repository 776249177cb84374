"""Byte-level BPE by a rank queue on hierarchical bitmaps.

Encoding a pre-token repeatedly merges the neighbouring pair of the lowest
rank, leftmost first. Pairs wait in buckets, one per merge rank, that hold
positions of a doubly linked list of parts. A three-level bitmap of 64-bit
words tells which buckets are filled: three find-first-set steps give the next
rank. A position whose pair has changed since it was queued is stale and is
skipped. So a pre-token of n bytes costs O(n) queue steps (and the sorting of
buckets), also where it is a megabyte long. Many short pre-tokens share one
queue: they lie behind one another in one list, without pairs across borders.
There a bucket holds the pairs of a block of neighbouring ranks, and a step merges
the lowest pair of each pre-token that has one in the lowest block, as arrays.

A pre-token that is itself a vocabulary entry is that entry, as in rank-file
tokenizers. Null and empty texts give no ids. Encodings of recurring pre-tokens
are kept in bounded caches.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import batch, no_cycles, pieces, tidy, tune
from mercato.llm.segments import SegmentEncoder, in_order

SHORT = 255             # bytes; pre-tokens up to this length are merged side by side
TOGETHER = 32_768       # of these share a queue
BLOCK = 11              # bits of the ranks that share a bucket there
NONE = (1 << 20) - 1    # no id


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the bytes and the rank, a line each."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankQueue:
    """Buckets of positions by rank, and a three-level bitmap of the filled ones."""

    def __init__(self, ranks: int):
        self.leaf = [0] * (-(-ranks // 64))
        self.mid = [0] * (-(-len(self.leaf) // 64))
        self.top = 0
        self.bucket: dict[int, list[int]] = {}

    def open(self, rank: int, positions: list[int]) -> None:
        """Fill the empty bucket of a rank."""
        self.bucket[rank] = positions
        a, b = rank >> 6, rank >> 12
        self.leaf[a] |= 1 << (rank & 63)
        self.mid[b] |= 1 << (a & 63)
        self.top |= 1 << b

    def lowest(self) -> int:
        """The least rank that has positions; -1 if there is none."""
        if not self.top:
            return -1
        b = (self.top & -self.top).bit_length() - 1
        word = self.mid[b]
        a = (b << 6) + (word & -word).bit_length() - 1
        word = self.leaf[a]
        return (a << 6) + (word & -word).bit_length() - 1

    def empty(self, rank: int) -> list:
        """Empty the bucket of a rank: what it holds, in any order."""
        a, b = rank >> 6, rank >> 12
        self.leaf[a] &= ~(1 << (rank & 63))
        if not self.leaf[a]:
            self.mid[b] &= ~(1 << (a & 63))
            if not self.mid[b]:
                self.top &= ~(1 << b)
        return self.bucket.pop(rank)

    def take(self, rank: int) -> list[int]:
        """Empty the bucket of a rank: its positions from left to right."""
        held = self.empty(rank)
        held.sort()
        return held


class ByteBpe(SegmentEncoder):
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks = ranks
        self.vocabulary = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.vocabulary[i] = b
        self.split = regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.byte = np.array([ranks[bytes([i])] for i in range(256)])
        self.first = np.full((256, 256), -1, np.int64)       # ranks of byte pairs
        self.joined: dict[int, int] = {}                     # (left id, right id) -> rank of both
        for whole, rank in ranks.items():
            for k in range(1, len(whole)):
                left, right = ranks.get(whole[:k]), ranks.get(whole[k:])
                if left is not None and right is not None:
                    self.joined[left << 20 | right] = rank
            if len(whole) == 2:
                self.first[whole[0], whole[1]] = rank
        self.blocks = RankQueue((len(self.vocabulary) >> BLOCK) + 1)
        self.pairs = np.array([*sorted(self.joined), NONE << 20 | NONE])       # the same as arrays
        self.pair_ranks = np.array([*map(self.joined.get, self.pairs[:-1].tolist()), -1])

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; -1 where they don't merge."""
        pair = left << 20 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.pair_ranks[at], -1)

    def merge_short(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` for pre-tokens of at most ``SHORT`` bytes. A bucket holds the
        pairs of a block of neighbouring ranks, as arrays of positions; each step
        takes the lowest block and merges in every pre-token there is one of its
        pair of the lowest rank, leftmost first. The others wait in the bucket."""
        queue, bucket = self.blocks, self.blocks.bucket
        data = np.frombuffer(b"".join(found), np.uint8)
        n, sizes = len(data), np.array([len(p) for p in found])
        starts = np.cumsum(sizes) - sizes
        ends = starts + sizes - 1
        # Position n stands for none: it merges with nothing.
        word = np.repeat(np.arange(len(found)), sizes)
        part = np.append(self.byte[data], NONE)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends] = before[starts] = n
        pair = np.full(n + 1, -1, np.int64)
        pair[:-2] = self.first[data[:-1], data[1:]]
        pair[ends] = -1

        def push(positions: np.ndarray) -> None:
            block = pair[positions] >> BLOCK
            order = np.argsort(block, kind="stable")
            order = order[np.searchsorted(block[order], 0):]
            block, positions = block[order], positions[order]
            cuts = np.flatnonzero(np.diff(block, prepend=-1)).tolist()
            for a, z in zip(cuts, [*cuts[1:], len(block)]):
                if (b := int(block[a])) in bucket:
                    bucket[b].append(positions[a:z])
                else:
                    queue.open(b, [positions[a:z]])

        push(np.arange(n))
        while (b := queue.lowest()) >= 0:
            held = np.concatenate(queue.empty(b))
            rank = pair[held]
            held = held[fresh := rank >> BLOCK == b]             # the others are stale
            which = word[held]
            key = np.sort((which << BLOCK | rank[fresh] & (1 << BLOCK) - 1) << 8 | held - starts[which])
            which = key >> BLOCK + 8
            at = starts[which] + (key & 255)
            lowest = np.diff(which, prepend=-1) > 0
            i, waiting = at[lowest], at[~lowest]
            if len(waiting):
                queue.open(b, [waiting])
            new, gone, left = pair[i], after[i], before[i]
            right = after[gone]
            part[i], part[gone], pair[gone] = new, -1, -1
            after[i], before[right] = right, i
            pair[i], pair[left] = self._rank(new, part[right]), self._rank(part[left], new)
            push(np.concatenate([i, left]))
        left_over = part[:-1] >= 0
        return part[:-1][left_over].astype("<i4"), np.add.reduceat(left_over, starts, dtype=np.int64)

    def merge(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, and how many each has. All of them lie behind one another in one list of
        parts, without pairs across their borders, and share the queue."""
        queue, get = self.queue, self.joined.get
        bucket, open_ = queue.bucket, queue.open
        data = np.frombuffer(b"".join(found), np.uint8)
        n = len(data)
        ends = np.cumsum([len(p) for p in found])
        start = np.full(n, -1, np.int64)
        start[:-1] = self.first[data[:-1], data[1:]]
        start[ends - 1] = -1
        order = np.argsort(start, kind="stable")
        sorted_ = start[order]
        order, sorted_ = order[np.searchsorted(sorted_, 0):], sorted_[np.searchsorted(sorted_, 0):]
        cuts = np.flatnonzero(np.diff(sorted_, prepend=-1))
        for r, positions in zip(sorted_[cuts].tolist(), np.split(order, cuts[1:]) if len(cuts) else []):
            open_(r, positions.tolist())
        pair, part = start.tolist(), self.byte[data].tolist()
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends[:-1]] = -1
        before[0] = -1
        after, before = after.tolist(), before.tolist()
        while (r := queue.lowest()) >= 0:
            positions = queue.take(r)
            for k, i in enumerate(positions):
                if pair[i] != r:
                    continue                     # stale
                gone = after[i]
                part[i], part[gone], pair[gone] = r, -1, -1
                back, right, left = r, after[gone], before[i]
                after[i] = right
                if right >= 0:
                    before[right] = i
                    new = get(r << 20 | part[right], -1)
                    pair[i] = new
                    if new >= 0:
                        if new in bucket:
                            bucket[new].append(i)
                        else:
                            open_(new, [i])
                        back = min(back, new)
                else:
                    pair[i] = -1
                if left >= 0:
                    new = get(part[left] << 20 | r, -1)
                    pair[left] = new
                    if new >= 0:
                        if new in bucket:
                            bucket[new].append(left)
                        else:
                            open_(new, [left])
                        back = min(back, new)
                if back < r:                     # a lower rank came up: it goes first
                    if k + 1 < len(positions):
                        open_(r, positions[k + 1:])
                    break
        ids = np.array(part)
        return ids[ids >= 0].astype("<i4"), np.add.reduceat(ids >= 0, ends - [len(p) for p in found], dtype=np.int64)

    def ids_of(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raws = [p.encode("utf-8", "replace") for p in found]
        whole = np.array([self.ranks.get(raw, -1) for raw in raws], "<i4")
        n = np.ones(len(raws), np.int64)
        made = [(np.flatnonzero(whole >= 0), whole[whole >= 0])]
        short = np.array([len(raw) <= SHORT for raw in raws], bool)
        for merge, size, which in (self.merge_short, TOGETHER, short), (self.merge, 4096, ~short):
            for at in pieces(np.flatnonzero((whole < 0) & which), size):
                ids, n[at] = merge([raws[i] for i in at.tolist()])
                made.append((at, ids))
        return in_order(n, made), n

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> ByteBpe:
    """One per worker process: its tables outlive a task, its memos do not."""
    return ByteBpe(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text."""
    tune(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def run(batches):
        bpe = tokenizer(path, pattern)
        for b in batches:
            yield batch("doc_id long, ids ints", (b.column(0).to_pylist(), list(bpe.encode(b.column(1).to_pylist()))))
        bpe.forget()

    return rows.mapInArrow(lambda it: tidy(run(it)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, bytes): what the ids of ``encode`` stand for."""
    def run(batches):
        bpe = tokenizer(path, pattern)
        for b in batches:
            yield batch("doc_id long, bytes binary", (b.column(0).to_pylist(), [bpe.decode(np.array(x or [], np.int32)) for x in b.column(1).to_pylist()]))

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, and its ids decoded, in one pass."""
    tune(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches):
        bpe = tokenizer(path, pattern)
        digits = [str(i) for i in range(len(bpe.vocabulary))]
        with no_cycles():
            for b in batches:
                n, of_ids, of_bytes = [], [], []
                for ids in bpe.encode(b.column(1).to_pylist()):
                    n.append(len(ids))
                    of_ids.append(sha256(",".join(map(digits.__getitem__, ids.tolist())).encode()).hexdigest())
                    of_bytes.append(sha256(bpe.decode(ids)).hexdigest())
                yield batch(out, (b.column(0).to_pylist(), n, of_ids, of_bytes))
        bpe.forget()

    return rows.mapInArrow(lambda it: tidy(run(it)), out)
