"""Secret scan: base patterns, and formats learned by grammar inference.

Labelled credentials are what the base patterns match anywhere in the corpus,
with the pattern's kind as the label. Per kind, a prefix tree over the character
classes of a bounded sample of them (the values of smallest hash) is turned
into a probabilistic automaton: states whose stop and transition frequencies
agree within the Hoeffding bound, and whose successors do, are merged (ALERGIA
on the red-blue frontier).

Candidates are all runs of 16 or more credential characters outside the base
spans, in every whole text. An automaton accepts a candidate whose likelihood
per character is typical of its training values: no less than that of all but
1 % of them, and no more than that of any (sixteen digits are likelier than any
hexadecimal key, and none). The background is a first-order model of the class
pairs of all candidates in the corpus that no automaton accepts or that are
plain words, so a format's own values, however many leak, hardly make it look
usual. An accepted candidate whose log likelihood beats the background's by
``MARGIN`` is a span of kind "format".

Null and empty texts have no spans; very long texts are taken whole. Without
any base match only base spans are given (none); an empty table gives no rows.
Repeated rows each have their own spans, equal ones. Columns other than doc_id
and text are ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import batch, keep, tidy, tune

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

SAMPLE = 800          # labelled credentials of a kind that its automaton is inferred from
LONGEST = 200         # characters of a credential in the prefix tree; scoring takes whole runs
ALPHA = 0.01          # confidence of the Hoeffding test
MARGIN = 5.6          # nats by which a format beats the background over a whole run
SYMBOLS = "dhlHU+/_.=-"

_CLASS = {**{c: "d" for c in "0123456789"}, **{c: "h" for c in "abcdef"}, **{c: "l" for c in "ghijklmnopqrstuvwxyz"},
          **{c: "H" for c in "ABCDEF"}, **{c: "U" for c in "GHIJKLMNOPQRSTUVWXYZ"}, **{c: c for c in "+/_.=-"}}
_CLASSES = str.maketrans(_CLASS)
# Words of letters, camel case included, in classes; possessive, so that no run takes long.
_PLAIN = re.compile(r"[+/_.=-]*+(?:(?:[HU]*+[hl]{2,}+|[HU]++(?=[+/_.=-]|\Z)|[HU]?[hl](?=[+/_.=-]|\Z))[+/_.=-]*+)++")

Span = tuple[int, int, int]   # start, kind, end


def _long_tokens(text: str, least: int) -> Iterator[tuple[int, str]]:
    """(position, token) of what stands between white space in ``least`` or more characters."""
    at = 0
    for token in [t for t in text.split() if len(t) >= least]:
        at = text.index(token, at)
        yield at, token
        at += len(token)


def base_spans(text: str | None) -> list[Span]:
    """Leftmost non-overlapping matches per kind; those too short are dropped."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    for at, token in _long_tokens(text, 20):
        if "AKIA" in token:
            found += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(token) if m.end() - m.start() >= 20]
        found += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(token) if m.end() - m.start() >= 24]
    return sorted(found)


def candidates(text: str | None, base: list[Span]) -> Iterator[tuple[int, str]]:
    """Runs of credential characters that touch no base span."""
    for at, token in _long_tokens(text or "", 16):
        for m in RUN.finditer(token):
            s, e = at + m.start(), at + m.end()
            if not any(b[0] < e and s < b[2] for b in base):
                yield s, m.group()


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


class Automaton:
    """A probabilistic automaton inferred from strings over SYMBOLS."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.count, self.stop, self.next = [0], [0], [{}]     # next: symbol -> [state, times]
        for s in strings:
            q = 0
            self.count[0] += 1
            for c in s:
                edge = self.next[q].get(c)
                if edge is None:
                    edge = self.next[q][c] = [len(self.count), 0]
                    self.count.append(0)
                    self.stop.append(0)
                    self.next.append({})
                edge[1] += 1
                q = edge[0]
                self.count[q] += 1
            self.stop[q] += 1
        self.slack = math.sqrt(math.log(2 / alpha) / 2)
        self._merge_states()
        self._weigh()

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.slack * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        """Stop and transition frequencies agree, and so do those of common successors."""
        todo, seen = [(a, b)], set()
        while todo:
            a, b = todo.pop()
            if a == b or (a, b) in seen:
                continue
            seen.add((a, b))
            n1, n2 = self.count[a], self.count[b]
            if self._differ(self.stop[a], n1, self.stop[b], n2):
                return False
            for c in self.next[a].keys() | self.next[b].keys():
                x, y = self.next[a].get(c), self.next[b].get(c)
                if self._differ(x[1] if x else 0, n1, y[1] if y else 0, n2):
                    return False
                if x and y:
                    todo.append((x[0], y[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to the automaton at a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.count[a] += self.count[b]
            self.stop[a] += self.stop[b]
            for c, (q, times) in self.next[b].items():
                edge = self.next[a].get(c)
                if edge is None:
                    self.next[a][c] = [q, times]
                else:
                    edge[1] += times
                    todo.append((edge[0], q))

    def _merge_states(self) -> None:
        red = [0]
        while True:
            held = set(red)
            frontier = [(-self.count[e[0]], q, c) for q in red for c, e in self.next[q].items() if e[0] not in held]
            if not frontier:
                self.states = red
                return
            _, q, c = min(frontier)
            edge = self.next[q][c]
            blue = edge[0]
            like = next((r for r in red if self._compatible(r, blue)), None)
            if like is None:
                red.append(blue)
            else:
                edge[0] = like
                self._fold(like, blue)

    def _weigh(self) -> None:
        """Smoothed log probabilities; an unseen symbol stays in its state."""
        self.log, self.to, self.end = {}, {}, {}
        for q in self.states:
            n = self.count[q] + 0.1 * (len(SYMBOLS) + 1)
            self.end[q] = math.log((self.stop[q] + 0.1) / n)
            for c in SYMBOLS:
                edge = self.next[q].get(c)
                self.log[q, c] = math.log(((edge[1] if edge else 0) + 0.1) / n)
                self.to[q, c] = edge[0] if edge else q
        self.next = [self.next[q] if q in self.end else None for q in range(len(self.next))]

    def walk(self, string: str) -> tuple[float, float]:
        """Log likelihoods per character of a string, without and with its end."""
        q, total = 0, 0.0
        for c in string:
            total += self.log[q, c]
            q = self.to[q, c]
        n = max(1, len(string))
        return total / n, (total + self.end[q]) / n

    def likelihood(self, string: str) -> float:
        """Log likelihood per character of a whole string, its end included."""
        return self.walk(string)[1]


class Model:
    """Automata by kind with the range of likelihoods of each, and the background of class pairs."""

    def __init__(self, values: dict[int, list[str]]):
        self.automata = []
        for _, found in sorted(values.items()):
            strings = [v[:LONGEST].translate(_CLASSES) for v in found]
            a = Automaton(strings)
            found = sorted(a.walk(s)[0] for s in strings)
            self.automata.append((a, found[len(found) // 100], found[-1]))
        self.learn_background({})

    def learn_background(self, pairs: dict[tuple[str, str], int]) -> None:
        total = Counter()
        for (a, _), n in pairs.items():
            total[a] += n
        self.pair = {(a, b): math.log((pairs.get((a, b), 0) + 0.5) / (total[a] + 0.5 * len(SYMBOLS)))
                     for a in "^" + SYMBOLS for b in SYMBOLS}

    def accepted(self, classes: str) -> float:
        """The likelihood under the likeliest automaton that accepts it; else minus infinity."""
        walks = ((a.walk(classes), low, high) for a, low, high in self.automata)
        return max((whole for (own, whole), low, high in walks if low <= own <= high), default=-math.inf)

    def usual(self, classes: str) -> bool:
        """Whether a candidate belongs to the background."""
        return bool(_PLAIN.fullmatch(classes)) or self.accepted(classes) == -math.inf

    def score(self, value: str) -> float:
        """By how much the likeliest format that accepts it beats the background."""
        s = value.translate(_CLASSES)
        return self.accepted(s) * len(s) - sum(self.pair[p] for p in zip("^" + s, s))


_FOUND = "kind int, value string, hash long, n long"


def _training(batches):
    """Base values by kind (kind, value, hash), and as kind -1 the class strings of candidates, counted."""
    for b in batches:
        rows, runs = {}, Counter()
        for text in b.column(0).to_pylist():
            base = base_spans(text)
            for s, k, e in base:
                value = ASSIGN.match(text, s, e).group(2) if k == 0 else text[s:e]
                rows[k, value] = xxhash.xxh3_64_intdigest(value.encode()) >> 1
            runs.update(value.translate(_CLASSES) for _, value in candidates(text, base))
        out = [(k, v, h, 0) for (k, v), h in rows.items()] + [(-1, s, 0, n) for s, n in runs.items()]
        yield batch(_FOUND, list(zip(*out)) if out else [[]] * 4)


def _background(batches, model: Model):
    """Class pairs of the background's candidates, counted."""
    pairs: Counter = Counter()
    for b in batches:
        for s, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if model.usual(s):
                for p in zip("^" + s, s):
                    pairs[p] += n
    yield batch("pair string, n long", [[a + c for a, c in pairs], list(pairs.values())])


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Infer the automata from the ``sample`` distinct values of each kind that
    have the smallest hash, then the background from all candidates."""
    spark = tune(docs.sparkSession)
    found = keep(docs.select(F.col("text").cast("string")).mapInArrow(lambda it: tidy(_training(it)), _FOUND), "credentials")
    values: dict[int, list[str]] = defaultdict(list)
    for kind in range(3):
        own = found.where(F.col("kind") == kind).select(F.substring("value", 1, LONGEST).alias("value"), "hash").distinct()
        values[kind] = [r["value"] for r in own.orderBy("hash", "value").limit(sample).collect()]
    values = {k: v for k, v in values.items() if v}
    if not values:
        return None
    model = Model(values)
    sent = spark.sparkContext.broadcast(model)   # bounded by the sample
    runs = found.where("kind = -1").select("value", "n")
    pairs = runs.mapInArrow(lambda it: _background(it, sent.value), "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    model.learn_background({(r["pair"][0], r["pair"][1]): r["n"] for r in pairs.collect()})   # at most 132 rows
    return model


def all_spans(text: str | None, model: Model | None, margin: float = MARGIN) -> tuple[list[Span], list[Span]]:
    """(base spans, base and format spans) of a whole text."""
    base = base_spans(text)
    more = [(s, 3, s + len(v)) for s, v in candidates(text, base) if model.score(v) >= margin] if model else []
    return base, sorted(base + more)


def _spans(batches, model, margin):
    for b in batches:
        ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        found = [all_spans(t, model, margin) for t in texts]
        yield batch("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long", (
            ids, *([sum(x[1] == k for x in base) for base, _ in found] for k in range(3)),
            [sha256(joined(base).encode()).hexdigest() for base, _ in found], [joined(every) for _, every in found],
            [len(every) - len(base) for base, every in found]))


def find_secrets(docs: DataFrame, sample: int = SAMPLE, margin: float = MARGIN) -> DataFrame:
    """Spans of every row of ``docs`` (doc_id, text)."""
    tune(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, sample))   # bounded by the sample
    return docs.mapInArrow(lambda it: _spans(it, sent.value, margin),
                           "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long")


def redact(text: str | None, spans: list[Span], mark: str = "[SECRET]") -> str | None:
    """The text with each run of overlapping spans replaced by ``mark``."""
    if not spans:
        return text
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, sample: int = SAMPLE, margin: float = MARGIN) -> DataFrame:
    """``docs`` with the spans of its text column redacted; other columns stay as they are."""
    tune(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(train(docs.select(F.col("text").cast("string")), sample))
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            clean = [redact(t, all_spans(t, sent.value, margin)[1]) for t in texts]
            yield b.set_column(at, b.schema.field(at), pa.array(clean, b.schema.field(at).type)) if clean != texts else b

    return docs.mapInArrow(lambda it: tidy(run(it)), docs.schema)
