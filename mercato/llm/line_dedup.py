"""Lines that recur in many documents: two Bloom filters find the suspects, Spark confirms them.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower
case. A document is a row; it counts a key once. Four passes:

1. Each task hashes its documents' keys. Per ``FLUSH`` hashes it sets those seen
   in one filter, ``once``, and those seen in two or more documents in another,
   ``twice``. The filters' bits are dealt to sections by the top bits of the
   hash; only sections with bits leave the task, compressed.
2. Sections meet by number (in two steps, so no group takes a row of every
   task): twice = twice | twice' | once & once', once = once | once'. A key of
   two documents is always in ``twice``; another key is there by chance only.
   The merged sections of ``twice`` are a table in the shared folder.
3. Documents are read again; only keys in ``twice`` leave the task, with their
   doc_id, as a table. Counting them by key confirms them exactly (partial
   sums before the exchange, so a hot key is no hot group) and gives the first
   occurrence: the smallest doc_id (null first), then line.
4. Lines with a confirmed key go. If the confirmed keys are under ``SMALL``
   bytes each worker reads their table; beyond that the suspects of a document
   meet the keys in a salted join, and the documents their dropped keys.

The filters have ``BITS`` bits a line, ``MAX_BITS`` at most: beyond that more
keys are suspects by chance, which costs shuffle, never a result. Null and empty
texts are one empty line. Empty keys are never dropped. Repeated rows are
documents of their own. Ties for the first occurrence (rows that repeat a
doc_id) all count as first. Texts of any length are worked on whole, one at a
time. Other columns pass through unread. An empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import batch, keep, tune

SECTION = 20            # log2 of the bits of a section
BITS = 8                # bits of a filter for each line
MAX_BITS = 1 << 31      # of a filter; a worker holds one while it probes
PROBES = 4
FLUSH = 2_000_000       # hashes held by a task
SALTS = 16
SMALL = 32 << 20        # bytes of confirmed keys that every worker may read
MIN_DOCS = 10

SECTIONS = "section int, salt int, once binary, twice binary"


def key_of(line: bytes) -> bytes:
    return line.strip(b" \t\n\v\f\r").lower()


def _positions(hashes: np.ndarray) -> np.ndarray:
    """Bit positions in its section of each hash, a row for each probe."""
    mask = np.uint64((1 << SECTION) - 1)
    step = hashes >> np.uint64(SECTION) & mask | np.uint64(1)
    return np.stack([hashes + np.uint64(k) * step & mask for k in range(PROBES)])


def _section_of(hashes: np.ndarray, levels: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - levels)).astype(np.int64) if levels else np.zeros(len(hashes), np.int64)


def _bits(hashes: np.ndarray) -> bytes:
    if not len(hashes):
        return b""
    held = np.zeros(1 << SECTION, bool)
    held[_positions(hashes).ravel()] = True
    return zstandard.compress(np.packbits(held, bitorder="little").tobytes(), 1)


def _loaded(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), np.uint64) if data else np.zeros(1 << SECTION - 6, np.uint64)


def _stored(bits: np.ndarray) -> bytes:
    return zstandard.compress(bits.tobytes(), 1) if bits.any() else b""


def _keys(text: bytes | None) -> list[bytes]:
    return [key_of(x) for x in (text or b"").split(b"\n")]


def _filters(batches, levels: int):
    """The sections of a task's two filters."""
    task = TaskContext.get()
    salt = (task.partitionId() if task else 0) % SALTS

    def sections(held: list[int]):
        hashes, n = np.unique(np.array(held, np.uint64), return_counts=True)
        of = _section_of(hashes, levels)                        # ascending, as the hashes are
        for k in np.unique(of).tolist():
            a, b = np.searchsorted(of, [k, k + 1])
            yield batch(SECTIONS, [[k], [salt], [_bits(hashes[a:b])], [_bits(hashes[a:b][n[a:b] > 1])]])

    held: list[int] = []
    for b in batches:
        for text in b.column(0).to_pylist():
            held += map(xxhash.xxh3_64_intdigest, {k for k in _keys(text) if k})
            if len(held) >= FLUSH:
                yield from sections(held)
                held = []
    if held:
        yield from sections(held)


def _merged(rows: pa.Table) -> pa.Table:
    once, twice = _loaded(b"").copy(), _loaded(b"").copy()
    for o, t in zip(rows.column("once").to_pylist(), rows.column("twice").to_pylist()):
        o = _loaded(o)
        twice |= _loaded(t) | once & o
        once |= o
    first = rows.slice(0, 1)
    return pa.Table.from_batches([batch(SECTIONS, [
        first.column("section").to_pylist(), first.column("salt").to_pylist(), [_stored(once)], [_stored(twice)]])])


def levels_for(lines: int, bits: int = BITS, max_bits: int = MAX_BITS) -> int:
    """log2 of the number of sections."""
    wanted = min(max(lines * bits, 1), max_bits)
    return max(0, (wanted - 1).bit_length() - SECTION)


def suspect_filter(docs: DataFrame, levels: int) -> DataFrame:
    """The merged sections of the filter of keys seen in two or more documents, written: section, twice."""
    tune(docs.sparkSession)
    texts = docs.select(F.col("text").cast("string").cast("binary").alias("text"))
    found = texts.mapInArrow(lambda it: _filters(it, levels), SECTIONS)
    for by in (("section", "salt"), ("section",)):
        found = found.groupBy(*by).applyInArrow(_merged, SECTIONS)
    return keep(found.select("section", "twice").filter(F.length("twice") > 0), "twice")


def _path(table: DataFrame) -> str:
    """The folder of a table that ``keep`` has written."""
    files = table.inputFiles()
    return files[0].rsplit("/", 1)[0] if files else ""


def _read(folder: str, columns: list[str]):
    """The rows of a written table, batch by batch, in a worker."""
    where = "file://" + folder[5:] if folder.startswith("file:/") and not folder.startswith("file://") else folder
    files, root = pafs.FileSystem.from_uri(where)
    for f in files.get_file_info(pafs.FileSelector(root)):
        if f.base_name.startswith("part-"):
            with files.open_input_file(f.path) as opened:
                yield from pq.ParquetFile(opened).iter_batches(columns=columns)


_HELD: dict[str, object] = {}


def _held(folder: str, load):
    """What a worker has loaded from a folder; it keeps the last one only."""
    if folder not in _HELD:
        _HELD.clear()
        _HELD[folder] = load()
    return _HELD[folder]


def _load_filter(folder: str, levels: int) -> np.ndarray:
    bits = np.zeros((1 << levels, 1 << SECTION - 3), np.uint8)
    for b in _read(folder, ["section", "twice"]):
        for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            bits[k] = _loaded(data).view(np.uint8)
    return bits.ravel()


def _in_filter(bits: np.ndarray, hashes: np.ndarray, levels: int) -> np.ndarray:
    base = _section_of(hashes, levels) << SECTION
    out = np.ones(len(hashes), bool)
    for p in _positions(hashes):
        at = base + p.astype(np.int64)
        out &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return out


SUSPECTS = "doc_id long, h long, line long, key binary"


def _suspects(batches, folder: str, levels: int):
    """The keys of each document that the filter holds, with their first line."""
    for b in batches:
        ids, hashes = b.column(0).to_pylist(), b.column(1).to_pylist()
        found, keys = [], []
        for row, text in enumerate(b.column(2).to_pylist()):
            seen: dict[bytes, int] = {}
            for line, k in enumerate(_keys(text)):
                seen.setdefault(k, line)
            seen.pop(b"", None)
            found += [(row, line) for line in seen.values()]
            keys += seen
        if not keys or not folder:
            continue
        bits = _held(folder, lambda: _load_filter(folder, levels))
        here = _in_filter(bits, np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys)), levels)
        rows = [(ids[found[i][0]], hashes[found[i][0]], found[i][1], keys[i]) for i in np.flatnonzero(here).tolist()]
        if rows:
            yield batch(SUSPECTS, zip(*rows))


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("h"), text.cast("binary").alias("text"))


def suspects(docs: DataFrame, bits: int = BITS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, h (of the text), line, key: every key that two or more documents
    hold, and few others, once a document; written."""
    tune(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = docs.agg(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    levels = levels_for(lines, bits, max_bits)
    folder = _path(suspect_filter(docs, levels))
    return keep(_rows(docs).mapInArrow(lambda it: _suspects(it, folder, levels), SUSPECTS), "suspects")


def repeated_lines(found: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Of suspects: the keys of at least ``min_docs`` documents, exactly, with
    the first document and line; written: key, n_docs, first_id, first_line."""
    first = F.min(F.struct("doc_id", "line"))
    keys = found.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), first.alias("f")).filter(F.col("n_docs") >= min_docs)
    return keep(keys.select("key", "n_docs", F.col("f.doc_id").alias("first_id"), F.col("f.line").alias("first_line")), "repeated")


def _load_keys(folder: str) -> dict[bytes, tuple[int | None, int]]:
    return {k: (i, line) for b in _read(folder, ["key", "first_id", "first_line"]) for k, i, line in zip(*(c.to_pylist() for c in b.columns))}


def _kept(doc_id, text: bytes | None, repeated, keep_first: bool) -> tuple[int, list[bytes]]:
    """Number of lines and those that stay."""
    lines = (text or b"").split(b"\n")
    out = []
    for n, line in enumerate(lines):
        first = repeated.get(key_of(line))
        if first is None or keep_first and first == (doc_id, n):
            out.append(line)
    return len(lines), out


def _dropped(rows, repeated_of, keep_first: bool, digest: bool):
    for doc_id, text, extra in rows:
        n, lines = _kept(doc_id, text, repeated_of(extra), keep_first)
        body = b"\n".join(lines)
        yield doc_id, n, n - len(lines), sha256(body).hexdigest() if digest else body.decode()


def _apply(batches, folder: str, keep_first: bool, digest: bool, schema: str):
    for b in batches:
        repeated = _held(folder, lambda: _load_keys(folder)) if folder else {}
        rows = zip(b.column(0).to_pylist(), b.column(2).to_pylist(), [None] * b.num_rows)
        found = list(_dropped(rows, lambda _: repeated, keep_first, digest))
        if found:
            yield batch(schema, zip(*found))


def _apply_own(batches, keep_first: bool, digest: bool, schema: str):
    """As ``_apply``, where each row brings the repeated keys it holds."""
    for b in batches:
        rows = zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist())
        own = lambda held: {x["key"]: (x["first_id"], x["first_line"]) for x in held or ()}
        found = list(_dropped(rows, own, keep_first, digest))
        if found:
            yield batch(schema, zip(*found))


def _own_keys(found: DataFrame, repeated: DataFrame) -> DataFrame:
    """doc_id, h, salt, held: the repeated keys of each document, once for each
    salt. A key of any share of the documents is dealt over all salts."""
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt")
    dealt = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "h"), F.lit(SALTS)).cast("int"))
    held = dealt.join(repeated.select("key", "first_id", "first_line", salts), ["key", "salt"])
    held = held.groupBy("doc_id", "h").agg(F.collect_set(F.struct("key", "first_id", "first_line")).alias("held"))
    return held.select("doc_id", "h", "held", salts)


def without_lines(docs: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False, digest: bool = False,
                  bits: int = BITS, max_bits: int = MAX_BITS, small: int = SMALL) -> DataFrame:
    """doc_id, n_lines (before), n_dropped and the text that stays, or its SHA-256
    (``digest``). ``keep_first`` leaves a repeated line where it first occurs."""
    schema = "doc_id long, n_lines long, n_dropped long, " + ("kept_sha256 string" if digest else "text string")
    found = suspects(docs, bits, max_bits)
    repeated = repeated_lines(found, min_docs)
    size = repeated.agg(F.sum(F.length("key") + 100)).first()[0] or 0
    if size <= small:
        folder = _path(repeated)
        return _rows(docs).mapInArrow(lambda it: _apply(it, folder, keep_first, digest, schema), schema)
    held = _own_keys(found, repeated)
    rows = _rows(docs).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    same = rows.doc_id.eqNullSafe(held.doc_id) & rows.h.eqNullSafe(held.h) & (rows.salt == held.salt)
    joined = rows.join(held, same, "left").select(rows.doc_id, rows.h, "text", "held")
    return joined.mapInArrow(lambda it: _apply_own(it, keep_first, digest, schema), schema)


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, n, line, translate(trim(line, E' \t\n\x0B\f\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, generate_subscripts(l, 1) AS n, unnest(l) AS line
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
repeated AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE key IN (FROM repeated)) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE key NOT IN (FROM repeated)), '')) AS kept_sha256
FROM lines GROUP BY doc_id"""
