"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrank.session import scratch_path


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: cuts the lineage, fixes generated row ids, and survives the loss of
    any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def crc_mod(id_col: str, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m`` (a null id counts as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % m


def split_cells(rows: DataFrame, key: str, pick: Column, chunk: int, weight: Column | None = None) -> DataFrame:
    """Deal the rows of each ``key`` into cells such that every two rows of a
    key meet in some cell and no cell holds more than about ``2 * chunk`` rows (or
    ``weight``, if given).

    A key of up to ``2 * chunk`` is one cell.  A larger one is cut into k chunks by
    ``pick`` (an integer column expression, equal for nothing but luck) and a row
    goes to the k cells that pair its chunk with each other one.  Adds ``cell_a``,
    ``cell_b`` (the two chunks) and ``cell_c`` (the row's own chunk); group by ``key,
    cell_a, cell_b``.  In a cell with ``cell_a < cell_b`` only pairs across the two
    chunks are new: pairs inside chunk a are compared in the cell ``(a, a)``."""
    w = F.lit(1) if weight is None else weight
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("cell_n"), F.sum(w).alias("cell_w")).where("cell_n > 1")
    k = F.when(F.col("cell_w") > 2 * chunk, F.least(F.ceil(F.col("cell_w") / F.lit(chunk)), F.col("cell_n")).cast("int")).otherwise(F.lit(1))
    out = rows.join(sizes, key).withColumn("cell_k", k)
    out = out.withColumn("cell_c", F.pmod(pick, F.col("cell_k")).cast("int"))
    out = out.withColumn("cell_o", F.explode(F.sequence(F.lit(0), F.col("cell_k") - 1)))
    return (out.withColumn("cell_a", F.least("cell_c", "cell_o").cast("int"))
            .withColumn("cell_b", F.greatest("cell_c", "cell_o").cast("int"))
            .drop("cell_n", "cell_w", "cell_k", "cell_o"))


def by_group(rows: DataFrame, keys: list[str], fn, schema: str, batch_rows: int = 4_096,
             batch_bytes: int = 8 << 20) -> DataFrame:
    """Run ``fn`` over the rows of whole groups: it gets a ``pyarrow.Table`` of one or
    more complete groups, the rows of a group together, and returns a table of
    ``schema``.  For many small groups (cells of ``split_cells``): a call takes as many
    as make about ``batch_rows`` rows or ``batch_bytes``, and no group is larger than a
    task can hold."""
    def run(batches):
        held: list = []
        size = many = 0
        rows_at, bytes_at = batch_rows, batch_bytes
        for b in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            held.append(b)
            size += b.num_rows
            many += b.nbytes
            if size >= rows_at or many >= bytes_at:
                table = pa.Table.from_batches(held)
                # all but the last group are complete: the rows are sorted by the keys
                cut = _last_group(table, keys)
                if cut:
                    yield from fn(table.slice(0, cut)).to_batches()
                held = table.slice(cut).to_batches()
                size, many = table.num_rows - cut, table.slice(cut).nbytes
                # a group that goes on is looked at again when it has doubled
                rows_at, bytes_at = max(batch_rows, 2 * size), max(batch_bytes, 2 * many)
        if size:
            yield from fn(pa.Table.from_batches(held)).to_batches()

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, schema)


def _last_group(table: pa.Table, keys: list[str]) -> int:
    """Row where the last group begins."""
    return int(group_starts(table, keys)[-1])


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


_kept: dict = {}


def keep_one(key, make):
    """What ``make`` gives, kept by this worker until it is asked for another key: a worker
    that serves several operators one after the other holds the tables and caches of one
    of them."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


class Recent:
    """A worker's cache of two generations: when the young one is full it becomes
    the old one; what is asked for again moves back.  Holds at most about twice
    ``limit`` entries and keeps the frequent ones."""

    def __init__(self, limit: int):
        self.limit, self.now, self.old = limit, {}, {}

    def missing(self, keys: set) -> set:
        """The keys that are not known; the others are in ``now`` afterwards."""
        if len(self.now) > self.limit:
            self.old, self.now = self.now, {}
        new = keys.difference(self.now)
        # (set.intersection would walk the whole of the old generation)
        again = {k: self.old[k] for k in new if k in self.old}
        self.now.update(again)
        return new.difference(again)
