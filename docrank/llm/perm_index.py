"""Nearest vectors by a permutation index.

``PIVOTS`` vectors of the table, chosen by a hash, are pivots.  A vector is
represented by its ``PREFIX`` nearest pivots in order.  A block of rows is indexed by
inverted files: for each pivot the rows that list it, with the weight
``PREFIX - position``.  For a query, the posting lists of its own pivots add up
``min(weight of the query, weight of the row)``; as the footrule distance of two
prefixes (an absent pivot counts as position ``PREFIX``) is
``PREFIX (PREFIX + 1) - 2 * sum``, the largest sums are the smallest distances.  The
nearest ``CANDIDATES`` share of each block, and every vector as near as the last of
them, is reranked by the exact inner product in double precision, and the best of
all blocks are kept.

Equal vectors are indexed once, with the k + 1 smallest ids of their rows (no query
needs more), so copies take one place of the share; the best are expanded to rows
after the rerank.

Inner products become distances by one more coordinate, sqrt(M^2 - |x|^2) with M
the largest length (0 for a query), so long vectors attract as they should.

The query set meets all rows in blocks: ``BLOCK_ROWS`` rows and ``BLOCK_QUERIES`` queries
share a task, whatever the size of the table.  The share of reranked rows is the same
at every size.  Every vector is indexed; only the pivots come from a sample of the
distinct ones.

Defined results: vectors that are null, empty, zero, hold a null or non-finite
component, or whose length is not the table's most frequent one, take no part
(neither as query nor as candidate); rows that repeat an id are rows of their own
and may find each other; rows with a null id are candidates only; with fewer than k
candidates all are returned; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docrank.llm.common import store
from docrank.llm.vectors import as_doubles, common_dim, matrix, takes_part

PIVOTS = 256
PREFIX = 64
CANDIDATES = 0.15         # share of a block's distinct vectors that is reranked
LEAST_CANDIDATES = 512
NO_ID = 2**63 - 1         # stands for a null id inside the tasks
BLOCK_ROWS = 4_096
BLOCK_QUERIES = 4_096


def prefixes(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` nearest pivots of each row, nearest first (ties: smaller pivot)."""
    near = np.hstack([x, extra[:, None]]) @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :length].astype("<u2")


class InvertedFiles:
    """Posting lists of one block: rows and weights by pivot."""

    def __init__(self, prefix: np.ndarray, n_pivots: int):
        n, self.length = prefix.shape
        pivot = prefix.ravel()
        order = np.argsort(pivot, kind="stable")
        cut = np.searchsorted(pivot[order], np.arange(1, n_pivots))
        self.rows = np.split(order // self.length, cut)
        self.weights = np.split((self.length - order % self.length).astype(np.int16), cut)
        self.n = n

    def nearest(self, prefix: np.ndarray, most: int, ties: bool = False) -> np.ndarray:
        """The ``most`` rows of least footrule distance from a query's prefix; with
        ``ties`` also all rows as near as the last of them."""
        total = np.zeros(self.n, np.int16)
        for at, p in enumerate(prefix):
            total[self.rows[p]] += np.minimum(self.weights[p], self.length - at)
        if most >= self.n:
            return np.arange(self.n)
        if ties:
            return np.flatnonzero(total >= np.partition(total, self.n - most)[self.n - most])
        return np.argpartition(total, self.n - most)[self.n - most:]


def search_block(data: pd.DataFrame, queries: pd.DataFrame, dim: int, n_pivots: int, k: int) -> pd.DataFrame:
    """Best k of one block for each query of one block."""
    empty = pd.DataFrame({"q_rid": np.empty(0, np.int64), "q_id": np.empty(0, np.int64),
                          "vec_id": np.empty(0, np.int64), "rid": np.empty(0, np.int64), "score": np.empty(0)})
    if not len(data) or not len(queries):
        return empty
    x, q = (np.frombuffer(b"".join(d["vec"]), "<f8").reshape(-1, dim) for d in (data, queries))
    px, pq = (np.frombuffer(b"".join(d["prefix"]), "<u2").reshape(len(d), -1) for d in (data, queries))
    ids, rid = np.concatenate(data["vec_ids"].to_list()), np.concatenate(data["rids"].to_list())
    many = data["rids"].map(len).to_numpy()
    start = np.cumsum(many) - many
    # vectors in the order of their smallest row
    order = np.lexsort((rid[start], ids[start]))
    x, px, many, start = x[order], px[order], many[order], start[order]
    files = InvertedFiles(px, n_pivots)
    most = max(LEAST_CANDIDATES, k + 1, math.ceil(CANDIDATES * len(x)))
    out_q, out_i, out_s = [], [], []
    for i, (own, p) in enumerate(zip(queries["rid"].to_numpy(), pq)):
        found = np.sort(files.nearest(p, most, ties=True))
        score = (x[found] * q[i]).sum(axis=1)
        # the k best rows are of the k best vectors and the query's own
        best = np.argsort(-score, kind="stable")[:k + 1]           # ties: the smaller id comes first
        n = many[found[best]]
        rows = np.repeat(start[found[best]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        score = np.repeat(score[best], n)
        other = rid[rows] != own
        rows, score = rows[other], score[other]
        best = np.lexsort((rid[rows], ids[rows], -score))[:k]
        out_q.append(np.full(len(best), i))
        out_i.append(rows[best])
        out_s.append(score[best])
    at_q, at = np.concatenate(out_q), np.concatenate(out_i)
    return pd.DataFrame({"q_rid": queries["rid"].to_numpy()[at_q], "q_id": queries["vec_id"].to_numpy()[at_q],
                         "vec_id": ids[at], "rid": rid[at], "score": np.concatenate(out_s)})


def search(table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           pivots: int = PIVOTS, prefix: int = PREFIX) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` holds (over
    ``vec_id``) its k nearest other rows found, by inner product."""
    source = table.select(F.col(id_col).cast("long").alias("vec_id"), as_doubles(vec_col).alias("vec"))
    dim = common_dim(source, "vec")
    good = source.where(takes_part(F.col("vec"), dim))
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v))
    stats = good.agg(F.max(length).alias("m"), F.count(F.lit(1)).alias("n")).first()
    if not stats.n:
        return good.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    most = float(stats.m)
    # 128 bits name a class of equal vectors
    rows = store(good.select(F.monotonically_increasing_id().alias("rid"), F.coalesce("vec_id", F.lit(NO_ID)).alias("vec_id"),
                             F.coalesce(is_query, F.lit(False)).alias("is_query"), "vec",
                             F.xxhash64("vec").alias("k1"), F.xxhash64(F.lit(1), "vec").alias("k2")), "perm-rows")
    picked = [r.rid for r in rows.groupBy("k1", "k2").agg(F.min("rid").alias("rid")).orderBy("k1", "k2").limit(pivots).collect()]
    n_pivots = len(picked)
    p = matrix(rows.where(F.col("rid").isin(picked)).select("k1", "k2", "vec").toArrow()
               .sort_by([("k1", "ascending"), ("k2", "ascending")]).column("vec").combine_chunks(), dim)
    bc = table.sparkSession.sparkContext.broadcast(np.hstack([p, _lift(p, most)[:, None]]))
    size = min(prefix, n_pivots)

    def represent(lifted: bool):
        # a query has no extra coordinate, so its order may differ
        def run(batches):
            for b in batches:
                x = matrix(b.column("vec"), dim)
                own = prefixes(x, _lift(x, most) if lifted else np.zeros(len(x)), bc.value, size)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:3], pa.array([r.tobytes() for r in x.astype("<f8")], pa.binary()),
                     pa.array([r.tobytes() for r in own], pa.binary())],
                    names=[*b.schema.names[:3], "vec", "prefix"])
        return run

    smallest = Window.partitionBy("k1", "k2").orderBy("vec_id", "rid")
    nodes = rows.withColumn("at", F.row_number().over(smallest)).where(F.col("at") <= k + 1).groupBy("k1", "k2").agg(
        F.array_sort(F.collect_list(F.struct("vec_id", "rid"))).alias("ids"), F.first("vec").alias("vec"))
    nodes = nodes.select("k1", F.col("ids.vec_id").alias("vec_ids"), F.col("ids.rid").alias("rids"), "vec")
    nodes = store(nodes.mapInArrow(represent(True), "k1 long, vec_ids array<long>, rids array<long>, vec binary, prefix binary"), "perm-nodes")
    asked = rows.where("is_query").select("rid", "vec_id", "is_query", "vec").mapInArrow(
        represent(False), "rid long, vec_id long, is_query boolean, vec binary, prefix binary")
    n, n_queries = nodes.count(), rows.where("is_query").count()
    row_blocks, query_blocks = math.ceil(n / BLOCK_ROWS), max(1, math.ceil(n_queries / BLOCK_QUERIES))

    def block(of: int, by: str) -> Column:
        return F.pmod(F.xxhash64(by), F.lit(of)).cast("int")

    def each(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    data = nodes.select("vec_ids", "rids", "vec", "prefix", block(row_blocks, "k1").alias("rb"), each(query_blocks).alias("qb"))
    ask = asked.select("rid", "vec_id", "vec", "prefix", block(query_blocks, "rid").alias("qb"), each(row_blocks).alias("rb"))
    found = data.groupBy("rb", "qb").cogroup(ask.groupBy("rb", "qb")).applyInPandas(
        lambda d, q: search_block(d, q, dim, n_pivots, k), "q_rid long, q_id long, vec_id long, rid long, score double")
    order = Window.partitionBy("q_rid").orderBy(F.desc("score"), "vec_id", "rid")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select(F.col("q_id").alias("query_id"), "rank",
                       F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score")


def _lift(x: np.ndarray, most: float) -> np.ndarray:
    """The extra coordinate that brings every row to length ``most``."""
    return np.sqrt(np.maximum(0.0, most * most - (x * x).sum(axis=1)))


def search_report(table: DataFrame, k: int = 20) -> DataFrame:
    """The k nearest rows of every row whose ``vec_id`` is divisible by 20."""
    return search(table, F.col("vec_id") % 20 == 0, k)
