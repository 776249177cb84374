"""MinHash near-duplicate groups with sequential Bayesian verification.

A document's set holds its distinct 5-word shingles. Steps:

1. One pass computes per document a fingerprint of its whole word sequence, the
   set's size and a MinHash signature. Documents with one fingerprint have
   equal sets: they are one node from here on (copies are never paired).
2. Signatures are cut into bands; nodes that share a band meet in a bucket.
3. Star phase: every node of a bucket is compared with the bucket's two hubs
   (smallest and largest fingerprint), so a bucket of n nodes gives 2n pairs.
4. Mixed phase: buckets whose nodes do not all hang together yet are compared
   in blocks, pairs of different components only, each in the first band that
   it shares. Only verified links leave the task, so that neither links are
   lost to the star phase nor pairs of a large group written out.
5. In both phases a candidate is compared batch by batch; after each batch it
   is dropped once the posterior probability of a similarity at or above the
   threshold (uniform prior, Beta posterior) falls below ``miss``. Survivors
   are verified exactly on the full shingle sets of the whole texts.
6. Components by label propagation with pointer jumping on written tables.

Null or wordless texts have an empty set, link with nothing and stay alone.
Rows that repeat a doc_id are answered row by row. A null doc_id takes part in
links; it is never the smallest id of a group that holds another id.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import Cache, batch, keep, pieces, tidy, tune

WIDTH = 5          # words in a shingle
PERMS = 128        # MinHash values in a signature
ROWS = 4           # values in a band: 32 bands miss a pair at 0.75 with 5e-6
STEP = 32          # values compared between two posterior checks
THRESHOLD = (75, 100)
MISS = 1e-4        # posterior below which a candidate is dropped
BLOCK = 2048       # nodes of a bucket compared in one block
BLOCK_WORDS = 2_000_000  # shingles of the nodes in one block
SEED = 20_240_601

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_HASH = Cache(xxhash.xxh3_64_intdigest)


def words(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lower-cased; bytes are split at 9-13 and 32."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def shingles(found: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; one for a text below ``width`` words."""
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASH.__getitem__, found), np.uint64, len(found))
    n = max(1, len(h) - width + 1)
    out = np.full(n, min(len(h), width), np.uint64)
    for k in range(min(width, len(h))):
        out = (out ^ h[k:k + n]) * _ODD
        out ^= out >> np.uint64(29)
    out *= _MIX
    out ^= out >> np.uint64(32)
    return np.unique(out)


@lru_cache
def _multipliers(perms: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(SEED)
    a, b = (r.integers(0, 1 << 63, perms, dtype=np.int64).astype(np.uint64) for _ in range(2))
    return (a << np.uint64(1)) | np.uint64(1), b


def signature(found: np.ndarray, perms: int = PERMS) -> np.ndarray:
    a, b = _multipliers(perms)
    low = np.full(perms, np.iinfo(np.uint64).max, np.uint64)
    for part in pieces(found, 256):
        np.minimum(low, (a[:, None] * part[None, :] + b[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype("<u4")


@lru_cache
def least_matches(perms: int, step: int, threshold: tuple[int, int], miss: float) -> dict[int, int]:
    """After n compared values: the fewest matches m at which P(J >= t | m of n)
    is still ``miss`` or more. With a uniform prior that posterior equals
    P(Binomial(n + 1, t) <= m)."""
    t, out = threshold[0] / threshold[1], {}
    for n in range(step, perms + 1, step):
        p, m = 0.0, -1
        while p < miss:
            m += 1
            p += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        out[n] = m
    return out


SIGNED = "doc_id long, h long, n_shingles long, fp binary, sig binary"


def _signed(batches, width, perms):
    for b in batches:
        ids, fps, sizes, sigs = [], [], [], []
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            w = words(text)
            s = shingles(w, width)
            ids.append(doc_id)
            sizes.append(len(s))
            fps.append(xxhash.xxh3_128_digest(b" ".join(w)) if w else None)
            sigs.append(signature(s, perms).tobytes() if w else None)
        yield batch(SIGNED, (ids, b.column(1).to_pylist(), sizes, fps, sigs))


def _banded(batches, perms, rows):
    bands = perms // rows
    for b in batches:
        fps, sigs = b.column(0).to_pylist(), b.column(1).to_pylist()
        for f, s in zip(pieces(fps, 500), pieces(sigs, 500)):
            cut = np.frombuffer(b"".join(s), "<u4").reshape(len(s), bands, rows)
            keys = [xxhash.xxh3_64_intdigest(x.tobytes(), k) for x in cut for k, x in enumerate(x)]
            yield batch("bucket long, fp binary", (np.array(keys, np.uint64).view(np.int64),
                                                   [x for x in f for _ in range(bands)]))


def _likely(a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Of paired signatures (rows of a and b): those that no batch prunes."""
    alive, done, matches = np.arange(len(a)), 0, np.zeros(len(a), np.int64)
    for n, m in least.items():
        matches += (a[alive, done:n] == b[alive, done:n]).sum(axis=1)
        ok = matches >= m
        alive, matches, done = alive[ok], matches[ok], n
    return alive


def _pruned(batches, least):
    """Candidate pairs with both signatures and sizes: the pairs that survive."""
    for x in batches:
        a, b = (np.frombuffer(b"".join(x.column(c).to_pylist()), "<u4").reshape(x.num_rows, -1) for c in ("sig_a", "sig_b"))
        if x.num_rows:
            yield x.select(["a", "b"]).take(pa.array(_likely(a, b, least)))


def _own(batches):
    """Rows (fp, text) whose text has the fingerprint: a repeated doc_id may
    stand for several texts."""
    for b in batches:
        fps, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        ok = [i for i, (f, t) in enumerate(zip(fps, texts)) if xxhash.xxh3_128_digest(b" ".join(words(t))) == f]
        yield b.take(pa.array(ok, pa.int64()))


def _cells(rows: DataFrame) -> DataFrame:
    """Deal the nodes of each bucket into its blocks and the blocks into cells
    (x, y): within a block (x = y) or between two of them (side 0 and side 1)."""
    rows = rows.withColumn("k", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    rows = rows.withColumn("z", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("bucket", "fp", "comp", "n_shingles", F.least("k", "z").alias("x"), F.greatest("k", "z").alias("y"),
                       (F.col("z") < F.col("k")).cast("int").alias("side"))


def _jaccard(s: np.ndarray, t: np.ndarray, threshold: tuple[int, int]) -> bool:
    both = len(np.intersect1d(s, t, assume_unique=True))
    return threshold[1] * both >= threshold[0] * (len(s) + len(t) - both)


def _mixed(least, threshold, width, rows, key, data):
    """Links between different components in one cell: compared on the
    signatures, survivors verified on the texts. A pair is dealt with in the
    first band that it shares; components that a link joins are one from then on."""
    fp, comp, n, side = (np.array(data.column(c).to_pylist(), object if c in ("fp", "comp") else None) for c in ("fp", "comp", "n_shingles", "side"))
    sig = np.frombuffer(b"".join(data.column("sig").to_pylist()), "<u4").reshape(len(fp), -1)
    cut = sig.reshape(len(fp), -1, rows)
    band = next(k for k in range(cut.shape[1]) if xxhash.xxh3_64_intdigest(cut[0, k].tobytes(), k) == key[0] % (1 << 64))
    texts, sets = data.column("text"), {}
    _, comp = np.unique(comp, return_inverse=True)
    (up, down), found = threshold, []

    def of(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingles(words(texts[i].as_py()), width)
        return sets[i]

    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    for k, i in enumerate(left.tolist()):
        j = left[k + 1:] if key[1] == key[2] else right
        j = j[(comp[j] != comp[i]) & (np.minimum(n[i], n[j]) * down >= np.maximum(n[i], n[j]) * up)]
        for m_to, m in least.items():  # batch after batch over the shrinking rest
            j = j[(sig[j, :m_to] == sig[i, :m_to]).sum(axis=1) >= m]
        if band and len(j):
            j = j[~(cut[j, :band] == cut[i, :band]).all(axis=2).any(axis=1)]
        for x in j.tolist():
            if comp[x] != comp[i] and _jaccard(of(i), of(x), threshold):
                found.append((fp[i], fp[x]))
                comp[comp == comp[x]] = comp[i]
    return pa.table({"a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([y for _, y in found], pa.binary())})


def _verified(batches, width, threshold):
    sets = Cache(lambda t: shingles(words(t), width), 64)
    for x in batches:
        a, b, ok = x.column("text_a").to_pylist(), x.column("text_b").to_pylist(), []
        for i, (s, t) in enumerate(zip(a, b)):
            if _jaccard(sets[s], sets[t], threshold):
                ok.append(i)
        yield x.select(["a", "b"]).take(pa.array(ok, pa.int64()))


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (fp, comp): comp is the smallest fp that is reachable.

    Each round takes the least label of the neighbours, then jumps to the
    label's own label; labels are written, so lineage does not grow."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = keep(both.distinct(), "links")
    labels = keep(both.groupBy(F.col("a").alias("fp")).agg(F.least(F.col("fp"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("fp").alias("b"), "comp"), "b").groupBy(F.col("a").alias("fp")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "fp").select("fp", F.least("comp", "near").alias("next"), "comp")
        jump = labels.select(F.col("fp").alias("next"), F.col("comp").alias("over"))
        new = keep(step.join(jump, "next").select("fp", F.least("next", "over").alias("next"), "comp"), "labels")
        if new.where("next != comp").isEmpty():
            return labels
        labels = new.select("fp", F.col("next").alias("comp"))


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored. An empty table
    gives an empty result. ``settings`` are those of ``groups``."""
    return groups(docs, **settings).drop("h")


def without_copies(docs: DataFrame, **settings) -> DataFrame:
    """One row of ``docs`` for each group of near copies, all columns as they
    are. Rows without words are linked with nothing and all stay, and so do
    rows without a doc_id that only link with one another."""
    named, worded = F.col("doc_id").isNotNull(), F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = groups(docs, **settings).where("kept AND n_shingles > 0").select(F.col("doc_id").alias("kept_id"), F.col("h").alias("kept_h"))
    kept = keep(kept.distinct(), "kept")
    own, nameless = kept.where("kept_id IS NOT NULL"), kept.where("kept_id IS NULL")
    same = F.xxhash64(docs["text"]) == F.col("kept_h")
    first = docs.where(named & worded).join(own, (docs["doc_id"] == own["kept_id"]) & same, "left_semi").dropDuplicates(["doc_id", "text"])
    return first.unionByName(docs.where(~named & worded).join(nameless, same, "left_semi")).unionByName(docs.where(~worded))


def groups(docs: DataFrame, width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD, perms: int = PERMS, rows: int = ROWS,
           step: int = STEP, miss: float = MISS, block: int = BLOCK, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``near_duplicates`` with h, the hash of each row's text."""
    tune(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    least = least_matches(perms, step, threshold, miss)
    hashed = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    base = keep(hashed.mapInArrow(lambda it: tidy(_signed(it, width, perms)), SIGNED), "signed")
    some = base.where("fp IS NOT NULL")
    # One node per fingerprint; equal fingerprints have equal signatures.
    nodes = some.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.max("sig").alias("sig"))
    nodes = keep(nodes, "nodes")
    bands = keep(nodes.select("fp", "sig").mapInArrow(lambda it: _banded(it, perms, rows), "bucket long, fp binary"), "bands")
    hubs = bands.groupBy("bucket").agg(F.min("fp").alias("low"), F.max("fp").alias("high"), F.count(F.lit(1)).alias("n")).where("low != high")
    met = keep(bands.join(hubs, "bucket").select("bucket", "fp", "low", "high", "n"), "buckets")

    pairs = met.select("fp", F.explode(F.array("low", "high")).alias("hub")).where("fp != hub")
    pairs = pairs.select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")).distinct()
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("fp").alias(side), F.col("sig").alias(f"sig_{side}"), F.col("n_shingles").alias(f"n_{side}")), side)
    up, down = threshold
    pairs = pairs.where(F.least("n_a", "n_b") * down >= F.greatest("n_a", "n_b") * up)
    pairs = keep(pairs.mapInArrow(lambda it: tidy(_pruned(it, least)), "a binary, b binary"), "star")

    def texts_of(some_nodes: DataFrame) -> DataFrame:
        ends = some_nodes.join(nodes.select("fp", "doc_id"), "fp")
        texts = docs.join(ends, docs["doc_id"].eqNullSafe(ends["doc_id"])).select(docs["doc_id"], "fp", "text").distinct()
        return keep(texts.select("fp", "text").mapInArrow(_own, "fp binary, text string"), "texts")

    texts = texts_of(pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct())
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("fp").alias(side), F.col("text").alias(f"text_{side}")), side)
    edges = keep(pairs.mapInArrow(lambda it: tidy(_verified(it, width, threshold)), "a binary, b binary"), "edges")
    labels = components(edges)

    own = met.select("bucket", "fp").join(labels, "fp", "left").join(nodes.select("fp", "n_shingles"), "fp")
    own = keep(own.select("bucket", "fp", "n_shingles", F.coalesce("comp", "fp").alias("comp")), "own")
    # In three nodes the two hubs have met all.
    mixed = own.groupBy("bucket").agg(F.min("comp").alias("one"), F.max("comp").alias("other"), F.count(F.lit(1)).alias("n"),
                                      F.sum("n_shingles").alias("words")).where("one != other AND n > 3")
    blocks = F.ceil(F.greatest(F.col("n") / block, F.col("words") / block_words)).cast("int")
    open_ = keep(own.join(mixed.select("bucket", blocks.alias("blocks")), "bucket"), "mixed")
    texts = texts_of(open_.select("fp").distinct())
    cells = _cells(open_).join(nodes.select("fp", "sig"), "fp").join(texts, "fp")
    more = cells.groupBy("bucket", "x", "y").applyInArrow(
        lambda key, t: _mixed(least, threshold, width, rows, [v.as_py() for v in key], t), "a binary, b binary")
    labels = components(edges.unionByName(keep(more, "more")))

    grouped = nodes.select("fp", "doc_id").join(labels, "fp", "left").select("fp", "doc_id", F.coalesce("comp", "fp").alias("comp"))
    first = grouped.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    found = grouped.join(first, "comp").select("fp", "component_id")
    out = some.select("doc_id", "h", "n_shingles", "fp").join(found, "fp").select("doc_id", "h", "n_shingles", "component_id")
    alone = base.where("fp IS NULL").select("doc_id", "h", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
