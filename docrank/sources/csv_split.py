"""One large multi-line CSV file read by many tasks.

A line break ends a record where an even number of quotes stands before it in the file
(doubled quotes count as two).  So:

1. every block (byte range of a file, as Spark splits it) counts its quotes; a running
   sum over the blocks of a file says which blocks begin inside a quoted field;
2. every task joins the physical lines of its blocks to records.  A block yields whole
   records, and at its ends at most two pieces of records that go on in other blocks;
3. pieces of one record meet by the block in which the record began.  Only pieces are
   shuffled, never whole records.

The first pass is an aggregate of built-in functions; the second works on Arrow batches
(running quote counts and joined lines, no code per line), as no built-in operator keeps the
order of lines within a block without shuffling them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3
PIECES = "path string, start long, kind int, first boolean, record string"
BAD = "__bad_record"


class _Block:
    """Lines of one block so far: those of the record that is still open."""

    def __init__(self, path: str, start: int, inside: bool):
        self.path, self.start, self.inside = path, start, inside
        self.from_before = inside      # no record has begun in this block yet
        self.first = start == 0 and not inside
        self.held: list[pa.Array] = []

    def add(self, lines: pa.Array):
        """Records that end in these lines."""
        odd = pc.count_substring(lines, '"').to_numpy().astype(np.int64) & 1
        inside_after = (np.cumsum(odd) + self.inside) & 1
        ends = np.flatnonzero(inside_after == 0) + 1
        at = 0
        if len(ends) and (self.held or self.inside):       # the open record ends here
            at = int(ends[0])
            self.held.append(lines.slice(0, at))
            yield self._one(HEAD if self.from_before else WHOLE)
            self.from_before = False
            ends = ends[1:]
        if len(ends):
            offsets = pa.array(np.r_[at, ends], pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")
            yield self._batch(joined, WHOLE)
            at = int(ends[-1])
        if at < len(lines):
            self.held.append(lines.slice(at))
        self.inside = bool(inside_after[-1]) if len(lines) else self.inside

    def close(self):
        if self.held:
            yield self._one(MIDDLE if self.from_before else TAIL)

    def _one(self, kind: int) -> pa.RecordBatch:
        lines = pa.concat_arrays(self.held)
        self.held = []
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "\n")
        return self._batch(joined, kind)

    def _batch(self, records: pa.Array, kind: int) -> pa.RecordBatch:
        n, first = len(records), self.first
        self.first = False
        return pa.RecordBatch.from_arrays(
            [pa.array([self.path] * n, pa.string()), pa.array(np.full(n, self.start)), pa.array(np.full(n, kind, np.int32)),
             pa.array([first] + [False] * (n - 1), pa.bool_()), records], names=["path", "start", "kind", "first", "record"])


def _pieces(batches):
    """Records and pieces of the lines ``path, start, inside, line`` in their order."""
    block = None
    for b in batches:
        path, start = b.column("path"), b.column("start").to_numpy()
        cuts = np.flatnonzero(np.r_[True, start[1:] != start[:-1]])
        for a, z in zip(cuts, np.r_[cuts[1:], b.num_rows]):
            # blocks of two files may begin at the same place
            names = path.slice(a, z - a).dictionary_encode()
            codes = names.indices.to_numpy()
            inner = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) + a
            for i, j in zip(inner, np.r_[inner[1:], z]):
                key = (path[int(i)].as_py(), int(start[i]))
                if block is None or (block.path, block.start) != key:
                    if block is not None:
                        yield from block.close()
                    block = _Block(*key, b.column("inside")[int(i)].as_py())
                yield from block.add(b.column("line").slice(i, j - i).cast(pa.string()))
    if block is not None:
        yield from block.close()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(record, first)``: the records of CSV files, line breaks in quotes kept, and whether
    one is the first of its file.  Every byte range of a file is a task of its own; records
    come in no order.  A quote that is never closed takes the rest of its file."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))
    quotes = lines.groupBy("path", "start").agg(F.sum(F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))).alias("n"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = quotes.select("path", "start", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    # one row per block (file bytes / split size)
    pieces = lines.join(F.broadcast(blocks), ["path", "start"]).select("path", "start", "inside", "line").mapInArrow(_pieces, PIECES)
    whole = pieces.where(F.col("kind") == WHOLE).select("record", "first")
    parts = pieces.where(F.col("kind") != WHOLE)
    so_far = Window.partitionBy("path").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most two rows per block and no text in them
    began = parts.select("path", "start", "kind", F.last(F.when(F.col("kind") == TAIL, F.col("start")), ignorenulls=True).over(so_far).alias("began"))
    joined = (parts.join(began, ["path", "start", "kind"]).groupBy("path", "began")
              .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "record"))).alias("p"), F.max("first").alias("first"))
              .select(F.array_join("p.record", "\n").alias("record"), "first"))
    return whole.unionByName(joined)


def read_split_csv(spark: SparkSession, path: str, columns: list[str], strict_arity: bool = False, header: bool = True) -> DataFrame:
    """The named string columns of multi-line CSV files with RFC 4180 quoting, however
    large a file is.  ``strict_arity`` drops records whose number of fields is not that of
    ``columns``."""
    records = csv_records(spark, path)
    if header:
        records = records.where(~F.col("first"))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, BAD]])
    record = F.regexp_replace("record", "\r\\z", "")
    row = F.from_csv(record, schema.simpleString()[len("struct<"):-1].replace(":", " "),
                     {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": BAD, "mode": "PERMISSIVE", "maxCharsPerColumn": "-1",
                      "columnPruning": "false"})
    rows = records.where(record != "").select(row.alias("r")).select("r.*")
    if strict_arity:
        rows = rows.where(F.col(BAD).isNull())
    return rows.drop(BAD)
