"""Personal data: base patterns, and contextual extraction bootstrapped from them.

Base matches (e-mail, IP, card, phone) are the seeds. The nearest words beside a seed
are lexical patterns ("L:" before it, "R:" behind it). Identifier-like tokens
outside base spans, three digits or a sign like @ or _ among five or more
characters, are the candidates; they are instances with patterns of their own.
Spark scores the graph of patterns and instances in rounds:

    pattern:  sum over its instances of n * score(instance) / (occurrences of its word + 1)
    instance: 1 for a seed; else 1 - prod over its patterns of (1 - score(pattern))

Words are white-space tokens, cut at the ends of spans, at quotes, brackets and
the like and behind a glued label (`email:`, `id=`), without punctuation at their
ends; contexts and occurrences take the same words.

A pattern's denominator counts its word everywhere in the corpus, so "the" stays
near 0 however many seeds it precedes. Only patterns seen beside ``SUPPORT``
distinct instances of score above ``CONFIDENT`` count for instances. Candidates whose final score
reaches CONFIDENT become spans of kind "context"; base spans stay as they are.

Null and empty texts have no spans. Rows that repeat a doc_id are answered row
by row (their text's hash tells them apart). Positions are code points, ends
exclusive. Contexts are sought within 200 characters of a match.
"""

from __future__ import annotations

import re
from collections import Counter
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import batch, keep, no_cycles, tune

KINDS = ("email", "ip", "card", "phone", "context")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
STRIP = ".,;:!?()[]{}<>\"'|#*"

ROUNDS = 3
SUPPORT = 3
CONFIDENT = 0.5
COUNTED = 300_000     # distinct words counted together before they are passed on

Span = tuple[int, int, int]   # start, kind, end
FOUND = "doc_id long, h long, role int, value string, left string, right string, s long, e long, n long"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[Span]:
    """Leftmost non-overlapping matches per kind; failing ones are dropped, without retries."""
    if not text:
        return []
    found, at = [], 0
    if "@" in text or "." in text:
        # Neither pattern holds white space: matches lie within tokens.
        for token in text.split():
            mail, ip = "@" in token, token.count(".") > 2
            if mail or ip:
                at = text.index(token, at)
                if mail:
                    found += [(at + m.start(), 0, at + m.end()) for m in EMAIL.finditer(token)]
                if ip:
                    found += [(at + m.start(), 1, at + m.end()) for m in IP.finditer(token) if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m.group().split("."))]
                at += len(token)
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(found)


def is_candidate(token: str) -> bool:
    return len(token) >= 5 and (sum(c in "0123456789" for c in token) >= 3 or "@" in token or "_" in token and any(c in "0123456789" for c in token))


def word(token: str) -> str:
    return token.strip(STRIP + "=").lower()


# Cuts within a token; no comma in a number, no apostrophe in a word.
_CUT = re.compile(r"""["()\[\]{}<>|;!?]+|,(?![0-9])|(?<!\w)'|'(?!\w)""")
# A label glued to what it names; no URL scheme, no group of hexadecimal digits (MAC, IPv6).
_LABEL = re.compile(r"(?![0-9A-Fa-f]{1,4}:)[^\W\d_][\w-]*[:=](?!//)")


def parts(token: str) -> list[tuple[int, int]]:
    """(start, end) of a token's parts."""
    out, at = [], 0
    for m in [*_CUT.finditer(token), None]:
        end = m.start() if m else len(token)
        label = _LABEL.match(token, at, end)
        if label and label.end() < end:
            out.append((at, label.end()))
            at = label.end()
        if at < end:
            out.append((at, end))
        at = m.end() if m else end
    return out


def words(token: str) -> list[str]:
    if token.isalnum():
        return [token.lower()]
    return [w for s, e in parts(token) if (w := word(token[s:e]))]


def contexts(text: str, spans: list[tuple[int, int]], counts: Counter, inner: Counter) -> dict[tuple[int, int], tuple[str, str]]:
    """The nearest words beside every span, empty where there is none; counts the
    text's tokens outside of spans, and the words within them (``inner``)."""
    cuts = sorted({0, len(text), *(x for span in spans for x in span)})
    inside = sorted(spans)
    first, last = {}, {}           # cut -> nearest word behind it, and before it
    k, reach = 0, 0
    segments = []
    for s, e in zip(cuts, cuts[1:]):
        while k < len(inside) and inside[k][0] <= s:
            reach = max(reach, inside[k][1])
            k += 1
        piece = text[s:e]
        if reach > s:
            w = word(piece)
            inner[w] += 1
            ends = w, w
        else:
            counts.update(piece.split())
            ends = _nearest(piece[:200].split()), _nearest(piece[-200:].split()[::-1], -1)
        segments.append((s, e, ends))
    for order, found, side in ((segments, last, 1), (segments[::-1], first, 0)):
        w, far = "", 0
        for s, e, ends in order:
            found[(s, e)[1 - side]] = w if far <= 200 else ""
            w, far = (ends[side], 0) if ends[side] else (w, far + e - s)
    return {(s, e): (last.get(s, ""), first.get(e, "")) for s, e in spans}


def _nearest(tokens: list[str], at: int = 0) -> str:
    return next((found[at] for t in tokens if (found := words(t))), "")


_MAYBE = re.compile(r"[0-9@]")


def candidates(text: str | None, base: list[Span]):
    """(start, end, value) of identifier-like tokens that touch no base span."""
    if not text or not _MAYBE.search(text):
        return
    at = 0
    for token in text.split():
        if len(token) < 5 or not _MAYBE.search(token):
            continue
        at = text.index(token, at)
        # The parts that look like identifiers; the whole token if none does.
        for pieces in (parts(token), [(0, len(token))]):
            found = [(s, v) for s, e in pieces if (v := token[s:e].strip(STRIP)) and is_candidate(v)]
            if found:
                break
        for s, value in found:
            s = at + token.index(value, s)
            if not any(b[0] < s + len(value) and s < b[2] for b in base):
                yield s, s + len(value), value
        at += len(token)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _found(batches):
    """Role 0: a document and its base spans; 1: a seed; 2: a candidate; 3: how often a word occurs."""
    counts, inner = Counter(), Counter()   # tokens outside of spans, words of spans

    def counted():
        for token, n in counts.items():
            for w in words(token):
                inner[w] += n
        rows = list(inner.items())
        counts.clear()
        inner.clear()
        none = [None] * len(rows)
        return batch(FOUND, (none, none, [3] * len(rows), [w for w, _ in rows], none, none, none, none, [n for _, n in rows]))

    with no_cycles():
        for b in batches:
            rows = []
            for doc_id, h, text in zip(*(c.to_pylist() for c in b.columns)):
                base = base_spans(text)
                rows.append((doc_id, h, 0, joined(base), None, None, None, None, None))
                more = list(candidates(text, base))
                if text:
                    beside = contexts(text, [*((s, e) for s, _, e in base), *((s, e) for s, e, _ in more)], counts, inner)
                    rows += [(doc_id, h, 1, text[s:e], *beside[s, e], s, e, None) for s, _, e in base]
                    rows += [(doc_id, h, 2, v, *beside[s, e], s, e, None) for s, e, v in more]
            yield batch(FOUND, list(zip(*rows)) if rows else [[]] * 9)
            if len(counts) + len(inner) > COUNTED:
                yield counted()
        yield counted()


def graph_scores(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confident: float = CONFIDENT) -> DataFrame:
    """(value, score) of the candidates that reach ``confident``."""
    seen = found.where("role IN (1, 2)")
    sides = F.array(F.struct(F.concat(F.lit("L:"), "left").alias("pattern"), F.col("left").alias("word")),
                    F.struct(F.concat(F.lit("R:"), "right").alias("pattern"), F.col("right").alias("word")))
    edges = seen.select("value", (F.col("role") == 1).alias("seed"), F.explode(sides).alias("p")).where("p.word != ''")
    edges = edges.groupBy(F.col("p.pattern").alias("pattern"), F.col("p.word").alias("word"), "value").agg(
        F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"))
    # A pattern needs that many distinct instances whatever their scores; the others can be left out at once.
    broad = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"), F.max("seed").alias("any_seed"), F.max("word").alias("word")).where(F.col("instances") >= support)
    words = found.where("role = 3").groupBy(F.col("value").alias("word")).agg(F.sum("n").alias("occurrences"))
    broad = broad.join(words, "word").select("pattern", "occurrences")
    edges = keep(edges.join(broad, "pattern").select("pattern", "value", "n", "seed", "occurrences"), "edges")
    scores = edges.groupBy("value").agg(F.max("seed").cast("double").alias("score"), F.max("seed").alias("seed"))
    for _ in range(rounds):
        scores = keep(scores, "scores")
        patterns = edges.drop("seed").join(scores, "value").groupBy("pattern", "occurrences").agg(
            F.sum(F.col("n") * F.col("score")).alias("weight"), F.sum((F.col("score") >= confident).cast("int")).alias("backed"))
        patterns = patterns.where(F.col("backed") >= support).select("pattern", F.least(F.lit(0.999), F.col("weight") / (F.col("occurrences") + 1)).alias("trust"))
        miss = edges.join(patterns, "pattern").groupBy("value").agg(F.sum(F.log(1 - F.col("trust"))).alias("miss"))
        scores = scores.join(miss, "value", "left").select("value", "seed", F.when(F.col("seed"), 1.0).otherwise(1 - F.exp(F.coalesce("miss", F.lit(0.0)))).alias("score"))
    return scores.where(~F.col("seed") & (F.col("score") >= confident)).select("value", "score")


def _merged(batches):
    out = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_context long"
    for b in batches:
        rows = []
        for doc_id, base, more in zip(*(c.to_pylist() for c in b.columns)):
            spans = [(int(s), KINDS.index(k), int(e)) for x in base.split(",") if x for k, s, e in [x.split(":")]]
            extra = [(x["s"], 4, x["e"]) for x in more or []]
            rows.append((doc_id, *(sum(k == j for _, k, _ in spans) for j in range(4)), sha256(base.encode()).hexdigest(),
                         joined(sorted(spans + extra)), len(extra)))
        yield batch(out, list(zip(*rows)) if rows else [[]] * 8)


def find_personal_data(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confident: float = CONFIDENT) -> DataFrame:
    """Spans of every row of ``docs`` (doc_id, text)."""
    tune(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), F.col("text").cast("string"))
    found = keep(rows.mapInArrow(_found, FOUND), "found")
    values = graph_scores(found, rounds, support, confident)
    spans = found.where("role = 2").join(values, "value").select(F.coalesce("doc_id", F.lit(-(1 << 62))).alias("id"), "h", "s", "e").distinct()
    # A document's spans: bounded by its text.
    spans = spans.groupBy("id", "h").agg(F.collect_list(F.struct("s", "e")).alias("more"))
    every = found.where("role = 0").select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 62))).alias("id"), "h", "value")
    every = every.join(spans, ["id", "h"], "left").select("doc_id", "value", "more")
    return every.mapInArrow(_merged, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_context long")
