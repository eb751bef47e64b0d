"""Corpora of one file per document, listed, read and written on the executors.

Spark's file sources list every file on the driver and skip files of length zero.  Here a
listing is a job: each task lists some folders, the folders found are the next job's
input, until there are none (as many jobs as the tree is deep).  Paths stay in a table; the
driver holds no row per file, and empty files are files like others.

Outputs of one directory per document (``write_doc_lines``) are written by the tasks too:
Spark's partitioned writer moves every directory on the driver when the job ends.

Folders are reached through ``pyarrow.fs``, so a path is a local one shared by all
executors or a URI that it knows (``file:``, ``hdfs:``, ``s3:``, ``gs:``).
"""

from __future__ import annotations

import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrank.session import scratch_path

FOLDERS = 256              # of a written corpus
READ_BYTES = 16 << 20      # texts that a task holds at a time
LIST_ROWS = 65_536

# Names of partition directories, as Spark writes and reads them
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")


def _open(path: str):
    """File system of a path, its path there, and what to put before paths found."""
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/"), "file:"
    where, rest = fs.FileSystem.from_uri(path)
    return where, rest, path[:path.index(rest)] if rest in path else path.split("://")[0] + "://"


def _entries(batches):
    """Files and folders in the folders of the batches; names that begin with ``_`` or
    ``.`` are left out, as Spark does."""
    for b in batches:
        for folder in b.column("path").to_pylist():
            where, rest, lead = _open(folder)
            here = where.get_file_info(rest)
            listed = [here] if here.is_file else where.get_file_info(fs.FileSelector(rest))
            for i in range(0, max(1, len(listed)), LIST_ROWS):
                found = [f for f in listed[i:i + LIST_ROWS] if f.base_name[0] not in "._"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lead + f.path for f in found], pa.string()), pa.array([f.type == fs.FileType.Directory for f in found], pa.bool_()),
                     pa.array([f.size or 0 for f in found], pa.int64())], names=["path", "folder", "length"])


def _roots(spark: SparkSession, path: str) -> list[str]:
    """What a path with wildcards names, else the path itself."""
    if not re.search(r"[*?\[{]", path):
        return [path]
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return [f.getPath().toString() for f in found or [] if f.getPath().getName()[0] not in "._"]


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length)`` of all files below ``path``, empty ones too."""
    levels, folders = [], spark.createDataFrame([(p,) for p in _roots(spark, path)], "path string")
    out = scratch_path(spark, "listing")
    while True:
        at = f"{out}/{len(levels)}"
        dealt = folders.repartition(spark.sparkContext.defaultParallelism, F.xxhash64("path")) if levels else folders
        dealt.mapInArrow(_entries, "path string, folder boolean, length long").write.parquet(at)
        levels.append(spark.read.schema("path string, folder boolean, length long").parquet(at))
        folders = levels[-1].where("folder").select("path")
        if folders.isEmpty():
            break
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found.where("not folder").select("path", "length")


def _texts(batches):
    """The whole text of each file."""
    for b in batches:
        paths, texts, size = [], [], 0
        for path in b.column("path").to_pylist():
            where, rest, _ = _open(path)
            with where.open_input_stream(rest) as f:
                raw = f.read()
            paths.append(path)
            texts.append(raw.decode("utf-8", "replace"))
            size += len(raw)
            if size >= READ_BYTES:
                yield _rows(paths, texts)
                paths, texts, size = [], [], 0
        if paths:
            yield _rows(paths, texts)


def _rows(paths: list, texts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], names=["path", "text"])


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _lines(batches):
    """The text of each file in chunks of whole lines."""
    for b in batches:
        paths, texts, size = [], [], 0
        for path in b.column("path").to_pylist():
            where, rest, _ = _open(path)
            left, first = b"", True
            with where.open_input_stream(rest) as f:
                while True:
                    raw = f.read(READ_BYTES)
                    got = left + (raw.removeprefix(b"\xef\xbb\xbf") if first else raw)
                    first = False
                    cut = got.rfind(b"\n") + 1 if raw else len(got)
                    left = got[cut:]
                    if cut:
                        paths.append(path)
                        texts.append(got[:cut].decode("utf-8", "replace"))
                        size += cut
                    if size >= READ_BYTES or len(paths) >= LIST_ROWS:
                        yield _rows(paths, texts)
                        paths, texts, size = [], [], 0
                    if not raw:
                        break
        if paths:
            yield _rows(paths, texts)


def _dealt(files: DataFrame) -> DataFrame:
    """The paths of files, dealt to tasks by a hash."""
    n = files.sparkSession.sparkContext.defaultParallelism
    return files.select("path").repartition(4 * n, F.xxhash64("path"))


def read_whole(files: DataFrame) -> DataFrame:
    """``(path, text)`` of the files of ``list_files``."""
    return _dealt(files).mapInArrow(_texts, "path string, text string")


def read_lines(files: DataFrame, key: Column) -> DataFrame:
    """``key`` (made of the ``path``, once per chunk) and ``line`` of the files of
    ``list_files``, lines as Spark's text reader cuts them; a file of any size is read in
    chunks of whole lines."""
    chunks = _dealt(files).mapInArrow(_lines, "path string, text string")
    # a text without "\r" is cut at one plain character, which takes no pattern search
    any_break = F.split(F.regexp_replace("text", "(\r\n|\r|\n)\\z", ""), "\r\n|\r|\n")
    last = F.expr("if(endswith(text, '\n'), left(text, length(text) - 1), text)")
    lines = F.when(F.contains("text", F.lit("\r")), any_break).otherwise(F.split(last, "\n"))
    return chunks.select(key, "text").select(F.col("*"), F.explode(lines).alias("line")).drop("text")


def url_of(path: Column) -> Column:
    """A listed path as Spark's ``_metadata.file_path`` gives it (URL-encoded)."""
    for c in "%" + "".join(map(chr, range(1, 33))) + "\x7f\"#<>?[\\]^`{|}":
        path = F.replace(path, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return F.regexp_replace(path, "^file:/+", "file:///")


def read_file_texts(files: DataFrame, id_pattern: str = r"^([^.]*)") -> DataFrame:
    """``(doc_id, text)`` of the files of ``list_files``: ``doc_id`` is group 1 of ``id_pattern``
    in the file name.  Files are dealt to tasks by a hash of their path."""
    texts = read_whole(files)
    return texts.select(F.regexp_extract(file_name(F.col("path")), id_pattern, 1).alias("doc_id"), "text")


def write_file_texts(docs: DataFrame, path: str, suffix: str = ".txt", folders: int = FOLDERS) -> None:
    """One file ``<doc_id><suffix>`` per document with its whole text, in ``folders`` folders by
    a hash of the id.  A file is written beside its place and moved there, so an attempt
    that is lost or repeated leaves whole files only.  Ids must be unique and fit for file
    names."""
    def write(batches):
        n = 0
        for b in batches:
            for folder, name, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                where, rest, _ = _open(f"{path.rstrip('/')}/{folder}")
                where.create_dir(rest, recursive=True)
                draft = f"{rest}/_{uuid.uuid4().hex}"
                with where.open_output_stream(draft) as f:
                    f.write(text.encode())
                where.move(draft, f"{rest}/{name}{suffix}")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    name = F.col("doc_id").cast("string")
    rows = docs.select(F.lower(F.hex(F.pmod(F.xxhash64(name), F.lit(folders)))).alias("folder"), name.alias("name"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def partition_name(value: str | None) -> str:
    """Value of a partition directory's name: as Spark escapes it."""
    return _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else NO_VALUE


def partition_value(path: Column, name: str) -> Column:
    """The value of ``name=<value>`` among the directories of a listed path, unescaped."""
    value = F.regexp_extract(path, f"/{re.escape(name)}=([^/]*)/[^/]*$", 1)
    return F.when(value != NO_VALUE, F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))))


def id_name(doc_id: str = "doc_id") -> Column:
    """An id as its directory tells it (a null id has the directory of the empty one, as
    Spark's writer gives them)."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def write_doc_lines(rows: DataFrame, path: str, mode: str = "overwrite", folders: int | None = None, grouped: bool = False) -> None:
    """``rows(doc_id, line)`` as text files in one directory ``doc_id=<id>`` per document,
    below ``path`` or, with ``folders``, in that many folders by a hash of the id: a
    directory of all documents of a large corpus is listed by one task.

    Each task sorts its rows by id (``grouped``: the rows of an id come one after the other
    in a task already, which is checked) and writes one file per document, beside its place,
    and moves it there under the name of the partition, so an attempt that is lost or repeated
    leaves one whole file.  All is written beside ``path`` and becomes visible by one rename;
    ``mode='append'`` adds to what is there."""
    spark, run = rows.sparkSession, uuid.uuid4().hex[:12]
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    target = jvm(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    there = files.exists(target)
    if mode not in ("overwrite", "append", "ignore", "error", "errorifexists"):
        raise ValueError(f"unknown mode {mode!r}")
    if there and mode == "ignore":
        return
    if there and mode.startswith("error"):
        raise FileExistsError(path)
    above, _, base = path.rstrip("/").rpartition("/")
    draft = path.rstrip("/") if mode == "append" else f"{above}/_{base}-{run}"

    def write(batches):
        where, root, _ = _open(draft)
        file = f"part-{TaskContext.get().partitionId():05d}-{run}.txt"
        seen, name, out, place = set(), None, None, ""
        for b in batches:
            names = b.column("name")
            coded = names.dictionary_encode()
            codes, values = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            cuts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
            offsets = pa.array(np.r_[cuts, len(codes)].astype(np.int32))
            texts = pc.binary_join(pa.ListArray.from_arrays(offsets, b.column("line")), "\n")
            for at, text in zip(cuts, texts):
                if out is None or values[codes[at]] != name:
                    if out is not None:
                        out.close()
                        where.move(f"{place}/_{file}", f"{place}/{file}")
                    name = values[codes[at]]
                    if name in seen:
                        raise ValueError(f"rows of the document {name!r} do not come one after the other")
                    seen.add(name)
                    folder = f"{zlib.crc32(name.encode()) % folders:x}/" if folders else ""
                    place = f"{root}/{folder}doc_id={partition_name(name)}"
                    where.create_dir(place, recursive=True)
                    out = where.open_output_stream(f"{place}/_{file}")
                out.write(text.as_py().encode())
                out.write(b"\n")
        if out is not None:
            out.close()
            where.move(f"{place}/_{file}", f"{place}/{file}")
        yield pa.RecordBatch.from_arrays([pa.array([len(seen)], pa.int64())], names=["n"])

    named = rows.select(id_name().alias("name"), F.coalesce("line", F.lit("")).alias("line"))
    try:
        files.mkdirs(jvm(draft))
        (named if grouped else named.sortWithinPartitions("name")).mapInArrow(write, "n long").agg(F.sum("n")).collect()
        if draft != path.rstrip("/"):
            if there:
                files.delete(target, True)
            if not files.rename(jvm(draft), target):
                raise OSError(f"{draft} could not be moved to {path}")
    finally:
        if draft != path.rstrip("/") and files.exists(jvm(draft)):
            files.delete(jvm(draft), True)
