"""Splitting texts where every pre-token boundary is sure, so that repeated words are encoded once.

In the split pattern of byte-level BPE a space before a character that isn't
white space always begins a pre-token: letters, digits and signs take one
leading space, and a run of white space leaves its last space to what follows.
Cutting texts there changes no pre-token.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, compress, count, islice
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 500_000        # pre-tokens kept by a worker
SEGMENTS = 300_000     # segments (a word with its signs) kept by a worker
LONGEST_KEPT = 200     # characters; longer pre-tokens and segments are encoded anew each time
IDS = 8_000_000        # ids of these kept by a worker
RUN = 4_000_000        # characters whose new segments are encoded together

_CUT = re.compile(r" (?=\S)")
_SIGNS = frozenset(".,!?;:")
_ODD = re.compile(r" (?:\s|\Z)")


def segments(text: str) -> list[str]:
    """The text cut there; the spaces at the cuts, which lead all segments but the first, are left out."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


def simple(segment: str) -> list[str] | None:
    """The pre-tokens of a plain word, or of one with a sign behind it; else None."""
    body = segment[1:] if segment[:1] == " " else segment
    if body.isalpha():
        return [segment]
    if body[-1:] in _SIGNS and body[:-1].isalpha():
        return [segment[:-1], segment[-1]]
    return None


def in_order(n: np.ndarray, made: list) -> np.ndarray:
    """Ids of all items behind one another, from pairs of some items' positions
    and their ids; ``n``: how many ids each item has."""
    ids = np.empty(n.sum(), "<i4")
    starts = np.cumsum(n) - n
    for at, found in made:
        k = n[at]
        ids[np.repeat(starts[at] - np.cumsum(k) + k, k) + np.arange(len(found))] = found
    return ids


class Codes(dict):
    """A number for each key, given when the key is first looked up; ``new`` holds those since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: dict[str, int] = {}

    def __missing__(self, key: str) -> int:
        code = self[key] = self.new[key] = self.number()
        return code


class SegmentEncoder:
    """Encodes texts by segment. A text is first turned into numbers of its
    segments; the ids of segments not met before are found together, and then
    those of all texts are gathered from one array. When a memo is full, the half
    of its segments that was used most is kept."""

    def __init__(self, limit: int | None = None):
        self.limit = limit
        self.kept = Codes()      # by segment, of the segment behind a space
        self.words = Codes()     # by pre-token; plain words behind a space are segments
        self.forget()

    def split(self, segment: str) -> list[str]:
        """Pre-tokens of a segment, or coarser parts that are encoded alike alone."""
        raise NotImplementedError

    def ids_of(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these parts behind one another, and how many each has."""
        raise NotImplementedError

    def forget(self) -> None:
        """Empty the memos: a worker that is reused would hold them through later stages."""
        self.kept.clear()
        self._store(np.empty(0, "<i4"), np.empty(0, np.int64), np.empty(0, np.int64))

    def _store(self, ids: np.ndarray, lengths: np.ndarray, used: np.ndarray) -> None:
        """Hold the ids of the numbers from 0 on, and no pre-tokens."""
        self.ids, self.lengths, self.used = ids, lengths, used
        self.starts = np.cumsum(lengths) - lengths
        self.words.clear()
        self.kept.number = self.words.number = count(len(lengths)).__next__

    def _gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these numbers behind one another, and how many each has."""
        n = self.lengths[codes]
        ends = np.cumsum(n)
        return self.ids[np.repeat(self.starts[codes] - ends + n, n) + np.arange(ends[-1] if len(n) else 0)], n

    def _learn(self) -> None:
        """Find the ids of the new segments and pre-tokens."""
        kept, words, split = self.kept, self.words, self.split
        asked = list(kept.new)
        plain = np.fromiter(map(str.isalpha, asked), bool, len(asked))
        single, codes = list(compress(asked, plain)), list(compress(kept.new.values(), plain))
        rest = list(compress(kept.new.items(), ~plain))
        # Words with a sign behind them, then what is left.
        signed = [s[-1] in _SIGNS and s[:-1].isalpha() for s, _ in rest]
        bodies, signs, several = [], [], []
        for s, code in compress(rest, signed):
            bodies.append(s[:-1])
            signs.append(s[-1])
            several.append(code)
        parts = [*chain.from_iterable(zip(map(kept.__getitem__, bodies), map(words.__getitem__, signs)))]
        sizes = [2] * len(several)
        for s, code in compress(rest, map(not_, signed)):
            found = split(" " + s)
            if len(found) == 1:
                single.append(s)
                codes.append(code)
            else:
                several.append(code)
                sizes.append(len(found))
                parts += [kept[p[1:]] if p[0] == " " and p[1:].isalpha() else words[p] for p in found]
        single += islice(kept.new, len(asked), None)
        codes += islice(kept.new.values(), len(asked), None)
        codes = np.array([*codes, *words.new.values()], np.int64)
        ids, n = self.ids_of([" " + s for s in single] + list(words.new))
        kept.new.clear()
        words.new.clear()
        more = np.zeros(len(codes) + len(several), np.int64)
        self.lengths, self.starts, self.used = (np.concatenate([x, more]) for x in (self.lengths, self.starts, self.used))

        def add(codes: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
            self.lengths[codes], self.starts[codes] = n, len(self.ids) + np.cumsum(n) - n
            self.ids = np.concatenate([self.ids, ids])

        add(codes, ids, n)
        if several:
            parts = np.array(parts, np.int64)
            self.used += np.bincount(parts, minlength=len(self.used))
            ids, n = self._gather(parts)
            add(np.array(several, np.int64), ids, np.add.reduceat(n, np.cumsum([0, *sizes[:-1]])))

    def _trim(self, fresh: list[str]) -> None:
        """Bound what is held: long segments go, and the less used half where there are too many."""
        kept, limit = self.kept, self.limit or SEGMENTS
        for s in fresh:
            if len(s) > LONGEST_KEPT:
                del kept[s]
        if len(kept) > limit or len(self.words) > (self.limit or WORDS) or len(self.ids) > IDS:
            keys, codes = list(kept), np.fromiter(kept.values(), np.int64, len(kept))
            best = np.sort(np.argsort(-self.used[codes], kind="stable")[:limit // 2])
            codes = codes[best]
            kept.clear()
            kept.update(zip(map(keys.__getitem__, best.tolist()), range(len(best))))
            self._store(*self._gather(codes), self.used[codes] // 2)

    def _first(self, segment: str) -> list[int]:
        """Numbers of a text's first segment, which may have no space before it."""
        return [self.words[p] for p in simple(segment) or self.split(segment)] if segment else []

    def _numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        """The numbers of each text's segments."""
        out = [np.empty(0, np.int64)] * len(texts)
        even = []
        for i, text in enumerate(texts):
            if text and _ODD.search(text):
                first, *rest = segments(text)
                out[i] = np.array(self._first(first) + [*map(self.kept.__getitem__, rest)], np.int64)
            elif text:
                even.append(i)
        if not even:
            return out
        # Arrow splits at all spaces and finds the distinct segments, each of which is looked up once.
        found = pc.split_pattern(pa.array([texts[i] for i in even], pa.large_string()), " ")
        ends = found.offsets.to_numpy()
        found = found.values
        firsts = map(self._first, found.take(pa.array(ends[:-1])).to_pylist())
        behind = np.ones(len(found), bool)
        behind[ends[:-1]] = False
        found = found.filter(pa.array(behind)).dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = np.fromiter(map(self.kept.__getitem__, distinct), np.int64, len(distinct))
        codes = codes[found.indices.to_numpy()]
        ends = (ends - np.arange(len(ends))).tolist()
        for i, first, a, b in zip(even, firsts, ends, ends[1:]):
            out[i] = np.concatenate([np.array(first, np.int64), codes[a:b]])
        return out

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text. Texts are taken in runs of about RUN characters."""
        run: list[str | None] = []
        size = 0
        for i, text in enumerate(texts):
            run.append(text)
            size += len(text or "")
            if size > RUN or i + 1 == len(texts):
                numbers = self._numbers(run)
                fresh = list(self.kept.new)
                self._learn()
                codes = np.concatenate(numbers)
                self.used += np.bincount(codes, minlength=len(self.used))
                ids, n = self._gather(codes)
                self._trim(fresh)
                ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum([0, *map(len, numbers)])].tolist()
                yield from (ids[a:b] for a, b in zip(ends, ends[1:]))
                run, size = [], 0
