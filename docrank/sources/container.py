"""Many documents in one file: a Spark data source, ``packed_docs``, of ``(doc_id, text)``.

A corpus of one file per document needs as many files as documents.  Here a task writes
its documents one after the other into container files of bounded size::

    <path>/<uuid>.docs     texts (UTF-8) end to end, then a table of one entry per document
                           (bytes of the id, bytes of the text, crc32 of the text, the id),
                           then a footer (where the table begins, documents, crc32 of the table)
    <path>/_MANIFEST       JSON: the committed containers with their documents and bytes

Spark's commit protocol makes a write whole or void: each task tells the driver which
containers it closed, and the job's commit names them in a new manifest that is moved over
the old one.  What a failed or repeated attempt left is in no manifest, so no reader sees
it; an aborted job removes the containers it was told of.  An overwrite keeps the files of
the manifest before it for readers that are open, and removes those that were kept before.

The driver holds one manifest entry per container.  A container is read in several
partitions if it is large; each document's checksum is compared.

Files are reached through ``pyarrow.fs``, as in ``docrank.sources.listing``.  A null text is
an empty document; a null id stays null; ids are kept as text; an empty table gives an
empty container list.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from docrank.sources.listing import _open

SCHEMA = "doc_id string, text string"
MANIFEST = "_MANIFEST"
MAGIC = b"DOCPACK1"
ENTRY = struct.Struct("<IQI")          # bytes of the id (NO_ID: null), bytes of the text, crc32
FOOTER = struct.Struct("<QQI8s")       # start of the table, documents, crc32 of the table, MAGIC
NO_ID = 0xFFFFFFFF
CONTAINER_BYTES = 256 << 20            # a container is closed when its texts reach this,
CONTAINER_DOCS = 262_144               # or it holds so many documents
PARTITION_BYTES = 64 << 20             # texts of a read partition, about
BATCH_BYTES = 16 << 20


def _manifest(path: str) -> dict:
    where, rest, _ = _open(path)
    if where.get_file_info(f"{rest}/{MANIFEST}").type == fs.FileType.NotFound:
        return {"files": [], "before": []}
    with where.open_input_stream(f"{rest}/{MANIFEST}") as f:
        return json.loads(f.read())


class PackedDocs(DataSource):
    """Options: ``path``; for writing also ``container_bytes`` and ``container_docs``, for
    reading ``partition_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "packed_docs"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if schema.names != ["doc_id", "text"]:
            raise ValueError(f"columns must be doc_id and text, not {schema.names}")
        return _Writer(self.options["path"], overwrite, int(self.options.get("container_bytes", CONTAINER_BYTES)),
                       int(self.options.get("container_docs", CONTAINER_DOCS)))


# ---- writing -----------------------------------------------------------------------
@dataclass
class _Closed(WriterCommitMessage):
    files: list                        # [name, documents, bytes of the texts]


class _Container:
    """An open container file of one task attempt."""

    def __init__(self, where, folder: str):
        self.name = f"{uuid.uuid4().hex}.docs"
        self.out = where.open_output_stream(f"{folder}/{self.name}")
        self.table, self.docs, self.size = bytearray(), 0, 0

    def add(self, doc_id: str | None, text: str | None) -> None:
        raw = (text or "").encode()
        name = (doc_id or "").encode()
        self.out.write(raw)
        self.table += ENTRY.pack(NO_ID if doc_id is None else len(name), len(raw), zlib.crc32(raw)) + name
        self.docs += 1
        self.size += len(raw)

    def close(self) -> list:
        self.out.write(bytes(self.table))
        self.out.write(FOOTER.pack(self.size, self.docs, zlib.crc32(self.table), MAGIC))
        self.out.close()
        return [self.name, self.docs, self.size]


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, most_bytes: int, most_docs: int):
        self.path, self.overwrite, self.most_bytes, self.most_docs = path, overwrite, most_bytes, most_docs

    def write(self, iterator) -> WriterCommitMessage:
        where, folder, _ = _open(self.path)
        where.create_dir(folder, recursive=True)
        closed, at = [], None
        for batch in iterator:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                at = at or _Container(where, folder)
                at.add(doc_id.as_py(), text.as_py())
                if at.size >= self.most_bytes or at.docs >= self.most_docs:
                    closed.append(at.close())
                    at = None
        if at:
            closed.append(at.close())
        return _Closed(closed)

    def commit(self, messages: list) -> None:
        where, folder, _ = _open(self.path)
        where.create_dir(folder, recursive=True)
        files = [f for m in messages if m for f in m.files]
        old = _manifest(self.path)
        new = {"files": files, "before": old["files"]} if self.overwrite else {"files": old["files"] + files, "before": old["before"]}
        draft = f"{folder}/_{uuid.uuid4().hex}"
        with where.open_output_stream(draft) as f:
            f.write(json.dumps(new).encode())
        where.move(draft, f"{folder}/{MANIFEST}")
        if self.overwrite:
            _remove(where, folder, old["before"])

    def abort(self, messages: list) -> None:
        where, folder, _ = _open(self.path)
        _remove(where, folder, [f for m in messages if m for f in m.files])


def _remove(where, folder: str, files: list) -> None:
    for name, *_ in files:
        if where.get_file_info(f"{folder}/{name}").type != fs.FileType.NotFound:
            where.delete_file(f"{folder}/{name}")


# ---- reading -----------------------------------------------------------------------
@dataclass
class _Part(InputPartition):
    """Documents ``first`` to ``last`` (exclusive) of a container."""
    name: str
    first: int
    last: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, part_bytes: int):
        self.path, self.part_bytes = path, part_bytes

    def partitions(self) -> list:
        parts = []
        for name, docs, size in _manifest(self.path)["files"]:
            n = max(1, min(docs, -(-size // self.part_bytes)))
            parts += [_Part(name, docs * i // n, docs * (i + 1) // n) for i in range(n)]
        return parts

    def read(self, partition):
        if partition is None:          # nothing is committed
            return
        where, folder, _ = _open(self.path)
        with where.open_input_file(f"{folder}/{partition.name}") as f:
            ids, sizes, sums = _table(f, partition.name)
            at = sum(sizes[:partition.first])
            held_ids, held, many = [], [], 0
            for i in range(partition.first, partition.last):
                raw = f.read_at(sizes[i], at)
                if len(raw) != sizes[i] or zlib.crc32(raw) != sums[i]:
                    raise OSError(f"document {i} of {partition.name} is damaged")
                at += sizes[i]
                held_ids.append(ids[i])
                held.append(raw.decode())
                many += len(raw)
                if many >= BATCH_BYTES:
                    yield _rows(held_ids, held)
                    held_ids, held, many = [], [], 0
            if held:
                yield _rows(held_ids, held)


def _table(f, name: str) -> tuple[list, list, list]:
    """Ids, sizes and checksums of a container's documents."""
    end = f.size() - FOOTER.size
    start, docs, crc, magic = FOOTER.unpack(f.read_at(FOOTER.size, end)) if end >= 0 else (0, 0, 0, b"")
    raw = f.read_at(end - start, start) if magic == MAGIC and start <= end else b""
    if magic != MAGIC or zlib.crc32(raw) != crc:
        raise OSError(f"{name} is damaged or no container")
    ids, sizes, sums, at = [], [], [], 0
    for _ in range(docs):
        n, size, crc = ENTRY.unpack_from(raw, at)
        at += ENTRY.size
        ids.append(None if n == NO_ID else raw[at:at + n].decode())
        at += 0 if n == NO_ID else n
        sizes.append(size)
        sums.append(crc)
    return ids, sizes, sums


def _rows(ids: list, texts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=["doc_id", "text"])


# ---- use ---------------------------------------------------------------------------
def register(spark: SparkSession) -> None:
    """Make ``packed_docs`` a format of the session."""
    spark.dataSource.register(PackedDocs)


def write_container(docs: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """Write ``docs(doc_id, text)`` as containers at ``path``: at most one open file per
    task, so as many files as tasks and one more per ``container_bytes`` of text.
    ``mode='append'`` adds to what is there."""
    register(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows.write.format("packed_docs").mode(mode).options(**options).save(path)


def read_container(spark: SparkSession, path: str, **options) -> DataFrame:
    """``(doc_id, text)`` of all documents of the containers at ``path``."""
    register(spark)
    return spark.read.format("packed_docs").options(**options).load(path)


def write_per_doc_container(rows: DataFrame, path: str, value_col: str) -> None:
    """The per-document outputs (``word<TAB>value`` lines in word order, one text per
    document) in containers.  A group holds the words of one document."""
    line = F.concat(F.col("word"), F.lit("\t"), F.col(value_col).cast("string"))
    texts = rows.groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("text"))
    write_container(texts, path)


def read_per_doc_container(spark: SparkSession, path: str, value_name: str, value_type: str = "bigint",
                           id_type: str = "string") -> DataFrame:
    """``(doc_id, word, value)`` of ``write_per_doc_container``; an empty word stays one."""
    lines = read_container(spark, path).select(F.col("doc_id").cast(id_type).alias("doc_id"), F.explode(F.split("text", "\n")).alias("line"))
    return lines.select("doc_id", F.substring_index("line", "\t", 1).alias("word"),
                        F.substring_index("line", "\t", -1).cast(value_type).alias(value_name))
