"""Token ids in files of directly addressable codes.

An id is cut into chunks of bits, least significant first. Level 0 holds the
first chunk of every id; a continuation bitmap marks the ids that have more,
and these, in order, have their next chunk in level 1, and so on. A rank
directory (ones before every block of ``BLOCK`` bits) turns a position in one
level into the position in the next. So any token is read in at most one step a
level, without decoding others; no id is stored wider than its levels need. The
chunk widths of a file are those that make it smallest, found by dynamic
programming over the bit lengths of its ids.

File layout, little-endian: magic "DAC1"; counts of documents, tokens and
levels (u64); per level its width and entries (u64 each); doc_ids (i64), null
flags (u8), document starts (u64, one more than documents); then per level the
packed chunks, and, but for the last, the bitmap and the directory (u64). Each
part begins at a multiple of 8 bytes.

Documents are sorted by doc_id over all files (nulls first; rows that repeat a
doc_id by their text) by a range partitioning. A task cuts its rows into files
of about ``FILE_TOKENS`` ids and writes them under new names, which only the
committed manifest refers to: what a lost task left behind is never read.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from mercato.llm.common import batch, keep, no_cycles, pieces, scratch, tune
from mercato.llm.segments import SegmentEncoder, in_order

MAGIC = b"DAC1"
BLOCK = 512              # bits between two entries of a rank directory
FILE_TOKENS = 4_000_000
PIECE = 1 << 18          # wide values packed at once
RUN = 500_000            # ids of whole documents read at once
KEPT = 700_000           # segments kept by a worker
TOGETHER = 32_768        # pre-tokens given to the library at once

MANIFEST = "file string, first_id long, first_hash long, docs long, tokens long, bytes long"


def byte_characters() -> dict[int, str]:
    """The published byte-level alphabet: printable Latin-1 bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + k) for k, b in enumerate(rest)}


# Texts of these characters only are cut into pre-tokens here, as the library's
# own pattern does; what letters, numbers and white space are is sure for them.
_LATIN = re.compile(r"[\n -~À-ÖØ-öø-ÿ]*")
_PRE = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[!-/:-@\[-`{-~]+|\s+(?!\S)|\s+")


class TextEncoder(SegmentEncoder):
    """The tokenizers library with its byte-level pre-tokenizer. A segment's
    pre-tokens go to the library's BPE model itself where they are sure, else
    the segment goes to its whole encoder; ids of recurring segments are kept. A
    text that holds the string of a special token goes there whole: by the
    library's default such a string is that token."""

    def __init__(self, path: str):
        super().__init__(KEPT)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bare = Tokenizer(self.tokenizer.model)       # the model for pre-tokens between spaces
        self.bare.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.sizes[[*vocabulary.values()]] = [*map(len, vocabulary)]
        self.alphabet = np.array([ord(c) for _, c in sorted(byte_characters().items())], "<u4")
        self.alphabet[0xFF] = ord(" ")
        self.short = self.words

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        whole = {i: np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<i4")
                 for i, text in enumerate(texts) if text and any(s in text for s in self.special)}
        for i, ids in enumerate(super().encode([None if i in whole else text for i, text in enumerate(texts)])):
            yield whole.get(i, ids)

    def split(self, segment: str) -> list[str]:
        return _PRE.findall(segment) if _LATIN.fullmatch(segment) else [segment]

    def ids_of(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sure = np.array([p.isascii() and p.isprintable() or p.isalpha() or p[1:].isalpha() and p[0] == " " or bool(_LATIN.fullmatch(p)) for p in found], bool)
        n = np.zeros(len(found), np.int64)
        made = []
        for at in pieces(np.flatnonzero(sure), TOGETHER):
            # Bytes as characters of the alphabet; a byte that UTF-8 hasn't becomes a space, which the alphabet hasn't.
            data = np.frombuffer("\udcff".join([found[i] for i in at.tolist()]).encode("utf-8", "surrogateescape"), np.uint8)
            ids = self.bare.encode_batch_fast([self.alphabet[data].tobytes().decode("utf-32-le")], add_special_tokens=False)[0].ids
            ids = np.array(ids, "<i4")
            ends = np.append(np.flatnonzero(data == 0xFF), len(data)) - np.arange(len(at))
            n[at] = np.diff(np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1, prepend=0)
            made.append((at, ids))
        for i in np.flatnonzero(~sure).tolist():
            ids = self.tokenizer.encode(found[i], add_special_tokens=False).ids
            n[i] = len(ids)
            made.append(([i], ids))
        return in_order(n, made), n


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def widths(ids: np.ndarray) -> list[int]:
    """Chunk widths of the least total size: a level of w bits costs w + 1 for each id that reaches it."""
    top = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    reach = [len(ids), *(int((ids >= 1 << b).sum()) for b in range(1, top)), 0]     # ids longer than b bits
    best, cut = [0.0] * (top + 1), [0] * (top + 1)
    for b in range(top - 1, -1, -1):                                # cost of all bits from b on
        best[b], cut[b] = min((int(reach[b]) * (e - b + (e < top)) + best[e], e) for e in range(b + 1, top + 1))
    out, b = [], 0
    while b < top:
        out.append(cut[b] - b)
        b = cut[b]
    return out


def pack(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bits each, behind one another, least significant bit
    first: eight of them fill ``width`` bytes."""
    n = len(values)
    if width > 16:
        shift = np.arange(width, dtype=np.uint32)
        return b"".join(np.packbits((values[i:i + PIECE, None] >> shift & 1).astype(np.uint8), bitorder="little").tobytes()
                        for i in range(0, n, PIECE))
    eight = np.zeros(n + -n % 8, np.uint64)
    eight[:n] = values
    eight = eight.reshape(-1, 8)
    low, high = (eight[:, h] for h in (0, 4))
    low, high = low.copy(), high.copy()
    for k in range(1, 4):
        low |= eight[:, k] << np.uint64(k * width)
        high |= eight[:, 4 + k] << np.uint64(k * width)
    out = np.zeros((len(eight), 2), "<u8")
    out[:, 0] = low | high << np.uint64(4 * width) if width < 16 else low
    out[:, 1] = high >> np.uint64(64 - 4 * width)
    return out.view(np.uint8)[:, :width].tobytes()[:-(-n * width // 8)]


def unpack(data: np.ndarray, width: int, start: int, stop: int) -> np.ndarray:
    """The values [start, stop) of packed bytes, each from the few bytes it lies in."""
    low = start * width // 8
    held = np.concatenate([data[low:-(-stop * width // 8)], np.zeros(8, np.uint8)])
    bit = np.arange(start * width - 8 * low, stop * width - 8 * low, width, dtype=np.int64)
    kind = np.dtype("<u4") if width <= 25 else np.dtype("<u8")
    # The integer that begins at each byte, whatever its alignment.
    words = np.ndarray(len(held) - kind.itemsize + 1, kind, held.data, strides=(1,))
    out = words[bit >> 3] >> (bit & 7).astype(kind)
    return (out & kind.type((1 << width) - 1)).astype(np.uint32)


def _padded(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 8)


def dump(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A file's bytes for documents and the ids of all of them in order."""
    ids = ids.astype(np.uint32)
    plan = widths(ids)
    head, body, rest = [], [], ids
    for k, w in enumerate(plan):
        last = k + 1 == len(plan)
        head.append(struct.pack("<QQ", w, len(rest)))
        body.append(_padded(pack(rest & np.uint32((1 << w) - 1), w)))
        if not last:
            more = rest >> np.uint32(w) > 0
            ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint64) if len(more) else np.empty(0, np.uint64)
            body.append(_padded(np.packbits(more, bitorder="little").tobytes()))
            body.append(np.concatenate([[0], np.cumsum(ones)]).astype("<u8").tobytes())
            rest = rest[more] >> np.uint32(w)
    known = np.array([i or 0 for i in doc_ids], "<i8").tobytes()
    nulls = _padded(bytes(i is None for i in doc_ids))
    starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.uint64)]).astype("<u8").tobytes()
    return _padded(MAGIC) + struct.pack("<QQQ", len(doc_ids), len(ids), len(plan)) + b"".join([*head, known, nulls, starts, *body])


class Reader:
    """Random access to the tokens of a file's bytes."""

    def __init__(self, data):
        data = np.frombuffer(data, np.uint8)
        if data[:4].tobytes() != MAGIC:
            raise ValueError("not a token file")
        docs, self.tokens, levels = (int(x) for x in data[8:32].view("<u8"))
        at = 32

        def part(size: int, kind: str = "u1") -> np.ndarray:
            nonlocal at
            found = data[at:at + size]
            at += size + -size % 8
            return found.view(kind)

        plan = part(16 * levels, "<u8").reshape(-1, 2).astype(np.int64).tolist()
        doc_ids, nulls, starts = part(8 * docs, "<i8"), part(docs), part(8 * docs + 8, "<u8")
        self.doc_ids = [None if n else int(i) for i, n in zip(doc_ids, nulls)]
        self.starts = starts.astype(np.int64)
        self.levels = []
        for k, (w, n) in enumerate(plan):
            chunks = part(-(-w * n // 8))
            last = k + 1 == len(plan)
            self.levels.append((w, chunks, None, None) if last else (w, chunks, part(-(-n // 8)), part(8 * (-(-n // BLOCK) + 1), "<u8")))

    def _rank(self, level: int, position: int) -> int:
        """Ones of a level's bitmap before a position: a directory entry and the bits behind it."""
        _, _, bitmap, directory = self.levels[level]
        block = position // BLOCK
        bits = np.unpackbits(bitmap[block * BLOCK // 8:-(-position // 8)], bitorder="little")[:position - block * BLOCK]
        return int(directory[block]) + int(bits.sum())

    def token(self, position: int) -> int:
        """One token, read without its neighbours."""
        return int(self.slice(position, position + 1)[0])

    def slice(self, start: int, stop: int, level: int = 0) -> np.ndarray:
        w, chunks, bitmap, _ = self.levels[level]
        out = unpack(chunks, w, start, stop)
        if bitmap is not None and stop > start:
            more = np.unpackbits(bitmap[start // 8:-(-stop // 8)], bitorder="little")[start % 8:start % 8 + stop - start].astype(bool)
            if more.any():
                low = self._rank(level, start)
                out[more] |= self.slice(low, low + int(more.sum()), level + 1) << np.uint32(w)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.starts[k]), int(self.starts[k + 1]))


def _file_system(folder: str):
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else "file://" + os.path.abspath(folder))


def _uri(folder: str) -> str:
    """Spark's "file:/x" as a URI that Arrow reads."""
    return "file://" + folder[5:] if folder.startswith("file:/") and not folder.startswith("file://") else folder


def _written(batches, path: str, end_id: int, folder: str, file_tokens: int):
    files, root = _file_system(folder)
    files.create_dir(root, recursive=True)
    enc = encoder(path)
    doc_ids, lengths, runs, first, held = [], [], [], 0, 0

    def close():
        name = f"{uuid.uuid4().hex}.dac"
        data = dump(doc_ids, lengths, np.concatenate(runs))
        with files.open_output_stream(f"{root}/{name}") as f:
            f.write(data)
        return batch(MANIFEST, [[x] for x in (name, doc_ids[0], first, len(doc_ids), sum(lengths), len(data))])

    with no_cycles():
        for b in batches:
            rows = zip(b.column(0).to_pylist(), b.column(2).to_pylist(), enc.encode(b.column(1).to_pylist()))
            for doc_id, h, ids in rows:
                if not doc_ids:
                    first = h
                doc_ids.append(doc_id)
                lengths.append(len(ids) + 1)
                runs += [ids, np.array([end_id], "<i4")]
                held += len(ids) + 1
                if held >= file_tokens:
                    yield close()
                    doc_ids, lengths, runs, held = [], [], [], 0
    if doc_ids:
        yield close()


def write_tokens(docs: DataFrame, path: str, end_id: int, folder: str, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the ids of every text, ``end_id`` behind each, as files in
    ``folder`` (a URI that Arrow's file systems open); the manifest with each file's start."""
    spark = tune(docs.sparkSession)
    folder = _uri(folder)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    manifest = keep(rows.mapInArrow(lambda it: _written(it, path, end_id, folder, file_tokens), MANIFEST), "manifest")
    # A row for each file of millions of tokens.
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_hash", "file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _read(batches, folder: str):
    files, root = _file_system(folder)
    for b in batches:
        for name, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist()):
            with files.open_input_file(f"{root}/{name}") as f:
                reader = Reader(f.read())
            starts = reader.starts.tolist()
            sums, k = [], 0
            while k < len(reader.doc_ids):                # documents of about RUN ids together
                end = max(k + 1, int(np.searchsorted(reader.starts, starts[k] + RUN, "right")) - 1)
                ids = memoryview(reader.slice(starts[k], starts[end]).astype("<u4")).cast("B")
                sums += [zlib.crc32(ids[4 * (a - starts[k]):4 * (b - starts[k])]) for a, b in zip(starts[k:end], starts[k + 1:end + 1])]
                k = end
            yield batch("doc_id long, start long, n_tokens long, ids_crc32 long", (
                reader.doc_ids, [start + s for s in starts[:-1]], np.diff(reader.starts), sums))


def read_summary(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    folder = _uri(folder)
    rows = manifest.select("file", "start")
    # A task for a few files each: rows this small would else be put in one task.
    rows = rows.repartition(max(1, rows.count() // 2), "file")
    return rows.mapInArrow(lambda it: _read(it, folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    folder = folder or scratch(docs.sparkSession, "tokens")
    return read_summary(write_tokens(docs, path, end_id, folder), folder)
