"""Token-id files made of independent zstandard frames with a trailing seek table.

Layout of one file (all integers little-endian):

* data frames: each an independent zstandard frame holding the ids (unsigned
  32-bit) of consecutive documents, about ``FRAME_BYTES`` before compression; a
  document never spans two frames (a longer one has a frame of its own)
* a skippable frame ``DOC_MAGIC`` with a zstandard-compressed document table:
  per document its id, frame, first id in the frame, and number of ids
* the seek table, a skippable frame ``SEEK_MAGIC``: for each data frame its
  compressed size, decompressed size and checksum (low 32 bits of xxh64 of the
  decompressed bytes); then the number of frames, a descriptor byte and
  ``FOOTER_MAGIC``

Plain zstandard tools decompress such a file (they skip the tables).  A reader
fetches the footer, the tables, and then only the frames of the documents it
wants, and checks each frame's checksum.

Writing: documents are range-partitioned and sorted by id, and each partition
writes one file under a name of its own attempt.  Only the files that the
successful attempts report become part of the manifest, so a retried or
speculative task never mixes in a half-written file.

Defined results: a null or empty text holds the end id only; null document ids
come first; rows that repeat an id are all written, ordered by their text; a text of
any length is encoded whole and has a frame of its own if it fills one; an empty table gives an empty manifest and no rows.
"""

from __future__ import annotations

import io
import json
import re
import struct
import sys
import uuid
from array import array

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrank.llm.common import Recent, text_or_empty
from docrank.llm.token_counts import tokenizer
from docrank.session import scratch_path

FRAME_BYTES = 1 << 20
LEVEL = 3
CACHE_ENTRIES = 400_000   # of each of two generations
KEEP_CHARS = 200          # longer pieces are not kept
STEP_BYTES = 4 << 20
JOINED = 512              # new words that the library encodes as one text
SLICE_ROWS = 1_000
# the machine's array type that is unsigned, of four bytes and little-endian
ARRAY_TYPE = "I" if array("I").itemsize == 4 and sys.byteorder == "little" else None

# Fixed values of the seekable zstandard format
SEEK_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
# a skippable frame of our own for the document table
DOC_MAGIC = 0x184D2A50

MANIFEST = "path string, first_id long, last_id long, first_null boolean, n_docs long, n_ids long"
NO_ID = -(2**63)

# The byte-level split, for pieces of characters whose classes are known
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_PLAIN = re.compile("[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]*")
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\\t-\\r {_LETTER}0-9]+"
                    "|[\\t-\\r ]+(?![^\\t-\\r ])|[\\t-\\r ]+")
# Pieces that stay pieces in a text of such pieces
_ALONE = re.compile(f" (?:[{_LETTER}]+|[0-9]+)")

_encoders: dict = {}


# ---- files ---------------------------------------------------------------------
def open_path(path: str, mode: str):
    """A file of a folder that all executors share: a plain path or a URI."""
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        path = "file://" + path
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    where, rest = fs.FileSystem.from_uri(path)
    if mode == "r":
        return where.open_input_file(rest)
    where.create_dir(rest.rsplit("/", 1)[0], recursive=True)
    return where.open_output_stream(rest, compression=None)


class Writer:
    """Appends documents to one file; ``close`` writes the tables."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.out, self.frame_bytes = out, frame_bytes
        self.z = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int, int]] = []
        self.buffer, self.size, self.n_ids = [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.size and self.size + len(ids) > self.frame_bytes:
            self._flush()
        self.docs.append((NO_ID if doc_id is None else doc_id, len(self.frames), self.size // 4, len(ids) // 4))
        self.buffer.append(ids)
        self.size += len(ids)
        self.n_ids += len(ids) // 4

    def _flush(self) -> None:
        if self.size:
            raw = b"".join(self.buffer)
            packed = self.z.compress(raw)
            self.out.write(packed)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.buffer, self.size = [], 0

    def close(self) -> None:
        self._flush()
        table = self.z.compress(np.array(self.docs, "<i8").tobytes())
        self.out.write(struct.pack("<II", DOC_MAGIC, len(table)) + table)
        body = b"".join(struct.pack("<III", *f) for f in self.frames)
        body += struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(body)) + body)
        self.out.close()


class Reader:
    """Random access to the documents of one file."""

    def __init__(self, f):
        self.f, self.z = f, zstandard.ZstdDecompressor()
        size = f.seek(0, io.SEEK_END) or f.tell()
        n, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or not flag & CHECKSUM_FLAG:
            raise ValueError("no seek table")
        start = size - 9 - 12 * n - 8
        head = struct.unpack("<II", self._at(start, 8))
        if head != (SEEK_MAGIC, 12 * n + 9):
            raise ValueError("bad seek table")
        self.frames = np.frombuffer(self._at(start + 8, 12 * n), "<u4").reshape(n, 3)
        self.offsets = np.r_[0, np.cumsum(self.frames[:, 0].astype(np.int64))]
        magic, length = struct.unpack("<II", self._at(int(self.offsets[-1]), 8))
        if magic != DOC_MAGIC:
            raise ValueError("no document table")
        raw = self.z.decompress(self._at(int(self.offsets[-1]) + 8, length))
        self.docs = np.frombuffer(raw, "<i8").reshape(-1, 4)
        self.last = (-1, b"")

    def _at(self, pos: int, n: int) -> bytes:
        self.f.seek(pos)
        return self.f.read(n)

    def frame(self, i: int) -> bytes:
        if self.last[0] != i:
            raw = self.z.decompress(self._at(int(self.offsets[i]), int(self.frames[i, 0])))
            if len(raw) != self.frames[i, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[i, 2]:
                raise ValueError(f"frame {i} is damaged")
            self.last = (i, raw)
        return self.last[1]

    def ids(self, row: int) -> bytes:
        """Ids of the document in that row of the document table."""
        _, frame, first, n = (int(x) for x in self.docs[row])
        return self.frame(frame)[4 * first:4 * (first + n)] if n else b""

    def find(self, doc_id: int) -> list[int]:
        """Rows of a document id; the table is sorted by id."""
        a, b = (int(np.searchsorted(self.docs[:, 0], doc_id, s)) for s in ("left", "right"))
        return list(range(a, b))


# ---- encoding ------------------------------------------------------------------
class ByteLevelEncoder:
    """Ids of whole texts by the tokenizers library, with a bounded cache.

    A text of known characters is split whole by one pattern, and each piece of the
    split is encoded once.  Any other text falls apart at single spaces between two
    other characters: the byte-level split never joins characters across such a space,
    except that the space begins the piece after it, so these parts encode
    independently too."""

    def __init__(self, path: str):
        self.lib = tokenizer(path)
        self.cache = Recent(CACHE_ENTRIES)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        added = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.added = re.compile("|".join(added)) if added else None
        self.known_split = (spec["normalizer"] is None and pre.get("type") == "ByteLevel"
                            and pre.get("use_regex", True) and not pre.get("add_prefix_space"))

    def _ids(self, texts: list[str]) -> list[bytes]:
        got = self.lib.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() if ARRAY_TYPE is None else array(ARRAY_TYPE, x.ids).tobytes() for x in got]

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of each piece.  Words of letters or digits after a space are encoded many
        to a text, whose split is at these spaces again; the library tells the word of
        each id."""
        alone = list(filter(_ALONE.fullmatch, pieces)) if self.known_split else []
        groups = [alone[i:i + JOINED] for i in range(0, len(alone), JOINED)]
        texts = ["".join(g) for g in groups]
        out: dict[str, bytes] = {}
        for g, text, x in zip(groups, texts, self.lib.encode_batch(texts, add_special_tokens=False)):
            n = np.bincount(np.array(x.word_ids, np.int64), minlength=len(g)) if None not in x.word_ids else []
            if len(n) == len(g) and all(n) and not (self.added and self.added.search(text)):
                raw, ends = np.array(x.ids, "<u4").tobytes(), (4 * np.cumsum(n)).tolist()
                out.update((p, raw[a:b]) for p, a, b in zip(g, [0, *ends], ends))
        rest = [p for p in pieces if p not in out]
        out.update(zip(rest, self._ids(rest)))
        return out

    def _pieces(self, text: str) -> list[str]:
        """Pieces of a text that encode independently."""
        if self.known_split and _PLAIN.fullmatch(text) and not (self.added and self.added.search(text)):
            return _SPLIT.findall(text)
        head, *tail = text.split(" ")
        out = [head]
        for p in tail:
            if out[-1] and p and not out[-1][-1].isspace() and not p[0].isspace():
                out.append(" " + p)
            else:
                out[-1] += " " + p
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        out, step, size = [], [], 0
        for t in texts:
            step.append(t)
            size += len(t)
            if size >= STEP_BYTES:
                out += self._step(step)
                step, size = [], 0
        return out + self._step(step)

    def _step(self, texts: list[bytes]) -> list[bytes]:
        pieces = [self._pieces(t.decode()) for t in texts]
        found = [list(map(self.cache.now.get, p)) for p in pieces]
        # most pieces are known: only the others go through a set
        new = list(self.cache.missing({x for p, ids in zip(pieces, found) if None in ids for x, y in zip(p, ids) if y is None}))
        self.cache.now.update(self._learn(new))
        now = self.cache.now
        out = [b"".join([now[x] if y is None else y for x, y in zip(p, ids)] if None in ids else ids) for p, ids in zip(pieces, found)]
        for p in new:
            if len(p) > KEEP_CHARS:
                del now[p]
        return out


def encoder(path: str) -> ByteLevelEncoder:
    if path not in _encoders:
        _encoders[path] = ByteLevelEncoder(path)
    return _encoders[path]


# ---- jobs ----------------------------------------------------------------------
def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = 0,
                      frame_bytes: int = FRAME_BYTES) -> list:
    """Encode every text, append ``end_id``, and write the ids to files below
    ``folder`` (shared by all executors) in ascending ``doc_id`` order.  Returns
    the manifest, one row per file in that order."""
    end = np.uint32(end_id).astype("<u4").tobytes()

    def write(batches):
        w = name = None
        ends: list = []
        for b in (b.slice(i, SLICE_ROWS) for b in batches for i in range(0, b.num_rows, SLICE_ROWS)):
            if w is None:
                name = f"{folder.rstrip('/')}/tokens-{uuid.uuid4().hex}.zst"
                w = Writer(open_path(name, "w"), frame_bytes)
            ids = b.column("doc_id").to_pylist()
            texts = b.column("text").cast(pa.binary()).to_pylist()
            for doc_id, got in zip(ids, encoder(path).encode(texts)):
                w.add(doc_id, got + end)
            ends = [ends[0] if ends else ids[0], ids[-1]]
        if w is not None:
            w.close()
            yield pa.RecordBatch.from_pylist([{"path": name, "first_id": ends[0], "last_id": ends[1],
                                               "first_null": ends[0] is None, "n_docs": len(w.docs), "n_ids": w.n_ids}],
                                             schema=pa.schema([("path", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64()),
                                                               ("first_null", pa.bool_()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first())
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    files = rows.mapInArrow(write, MANIFEST).collect()  # one row per file
    return sorted(files, key=lambda r: (not r.first_null, r.first_id if r.first_id is not None else NO_ID))


def read_token_files(spark: SparkSession, manifest: list) -> DataFrame:
    """``doc_id, start, ids`` of every document of the files: ``start`` counts the
    ids of all documents before it."""
    parts, before = [], 0
    for r in manifest:
        parts.append((r.path, before))
        before += r.n_ids

    def read(batches):
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("before").to_pylist()):
                with open_path(path, "r") as f:
                    rd = Reader(f)
                    at, rows, size = start, [], 0
                    for i in range(len(rd.docs)):
                        ids = rd.ids(i)
                        doc_id = int(rd.docs[i, 0])
                        rows.append((None if doc_id == NO_ID else doc_id, at, ids))
                        at += len(ids) // 4
                        size += len(ids)
                        if size > 8 * FRAME_BYTES:
                            yield _batch(rows)
                            rows, size = [], 0
                    yield _batch(rows)

    files = spark.createDataFrame(parts, "path string, before long")
    return files.repartition(max(1, len(parts))).mapInArrow(read, "doc_id long, start long, ids binary")


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                                      names=["doc_id", "start", "ids"])


def crc32_of(ids: str = "ids"):
    return F.crc32(F.col(ids))


def file_report(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from
    the files."""
    spark = docs.sparkSession
    manifest = write_token_files(docs, path, scratch_path(spark, "token-files"), end_id)
    rows = read_token_files(spark, manifest)
    return rows.select("doc_id", "start", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
                       crc32_of().alias("ids_crc32"))
