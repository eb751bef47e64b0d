"""Near-duplicate vectors by a forest of random-projection trees with spill.

Trees are fitted on a bounded sample: a node is cut at the median of a random
projection, and points within a margin of the cut go to both sides.  The margin
is ``SPILL`` standard deviations of the projected difference of a pair at the
threshold, so a linked pair seldom parts at a cut, and hardly ever in all trees.
Cutting ends at leaves of about ``LEAF_ROWS`` rows of the whole table (at
``MIN_SAMPLE`` sample points at the least), or where a cut would not help (a
dense clump stays whole).  Every row goes down every tree.

Within a leaf all rows of equal label are compared exactly, in double precision;
a leaf that holds more than ``2 * CHUNK`` rows of a label is compared in blocks.  A
pair is counted in the first leaf, over all trees, that both rows share, so link
counts are sums and no pair is ever emitted; each block emits a spanning forest of
its links, and the union gives the components.

Equal vectors of a label are one node that weighs as many rows as it has.

Defined results: vectors that are null, empty, zero, hold a null or non-finite
component, or whose length is not the table's most frequent one, and rows without
label, link with nothing; rows that repeat an id are vectors of their own; null
ids never become a component's id unless all its ids are null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrank.llm.common import split_cells, store
from docrank.llm.components import components
from docrank.llm.vectors import as_doubles, common_dim, matrix, takes_part, unit

TREES = 6
SAMPLE_ROWS = 65_536
LEAF_ROWS = 4_096
MIN_SAMPLE = 16
SPILL = 1.3
CHUNK = 2_048
BLOCK = 512


# ---- trees -------------------------------------------------------------------------
class Forest:
    """Trees as flat arrays: a node has a direction, a cut, and its two children;
    a negative child -1 - i is leaf i.  Leaves are numbered over all trees."""

    def __init__(self, sample: np.ndarray, trees: int, leaf: int, margin: float, seed: int = 0):
        self.margin, self.n_leaves = margin, 0
        self.dirs, self.cuts, self.kids, self.roots = [], [], [], []
        rng = np.random.default_rng(seed)
        for _ in range(trees):
            self.roots.append(self._grow(sample, np.arange(len(sample)), leaf, rng))
        self.dirs = np.array(self.dirs) if self.dirs else np.empty((0, sample.shape[1]))

    def _grow(self, x, idx, leaf, rng) -> int:
        for _ in range(3 if len(idx) > leaf else 0):
            d = rng.standard_normal(x.shape[1])
            d /= np.linalg.norm(d)
            p = x[idx] @ d
            cut = float(np.quantile(p, rng.uniform(0.4, 0.6)))
            low, high = idx[p <= cut + self.margin], idx[p >= cut - self.margin]
            if max(len(low), len(high)) <= 0.85 * len(idx):
                at = len(self.cuts)
                self.dirs.append(d)
                self.cuts.append(cut)
                self.kids.append(None)
                self.kids[at] = (self._grow(x, low, leaf, rng), self._grow(x, high, leaf, rng))
                return at
        self.n_leaves += 1
        return -self.n_leaves

    def leaves(self, x: np.ndarray) -> list[list[int]]:
        """The leaves of each row, ascending."""
        rows, at = [], []
        for root in self.roots:
            todo = [(root, np.arange(len(x)))]
            while todo:
                node, idx = todo.pop()
                if node < 0:
                    rows.append(idx)
                    at.append(np.full(len(idx), -1 - node))
                elif len(idx):
                    p = x[idx] @ self.dirs[node]
                    a, b = self.kids[node]
                    todo.append((a, idx[p <= self.cuts[node] + self.margin]))
                    todo.append((b, idx[p >= self.cuts[node] - self.margin]))
        rows, at = np.concatenate(rows), np.concatenate(at)
        order = np.lexsort((at, rows))
        return np.split(at[order], np.searchsorted(rows[order], np.arange(1, len(x)))) if len(x) else []


def fit_forest(nodes: DataFrame, n: int, dim: int, threshold: float, trees: int = TREES, seed: int = 0) -> Forest:
    """A forest for ``n`` nodes (``node``, ``vec``) from about ``SAMPLE_ROWS`` of them, chosen by
    a hash of the vector."""
    part = min(1.0, SAMPLE_ROWS / max(1, n))
    if part < 1:
        nodes = nodes.where(F.pmod(F.xxhash64("vec"), F.lit(1_000_000)) < int(part * 1_000_000))
    got = nodes.select("node", "vec").toArrow().sort_by("node")
    sample = unit(matrix(got.column("vec").combine_chunks(), dim))
    leaf = max(MIN_SAMPLE, int(LEAF_ROWS * len(sample) / max(1, n)))
    margin = SPILL * math.sqrt(max(0.0, 2 - 2 * threshold) / dim) / 2
    return Forest(sample, trees, leaf, margin, seed)


# ---- comparison --------------------------------------------------------------------
def compare(pdf: pd.DataFrame, dim: int, threshold: float) -> pd.DataFrame:
    """Links of one block: per row the weight of the partners first met here, and
    the smallest node it is connected with inside the block."""
    pdf = pdf.sort_values("node", kind="stable")
    node, weight, part = (pdf[c].to_numpy() for c in ("node", "weight", "cell_c"))
    leaf = int(pdf["leaf"].iloc[0])
    crossing = pdf["cell_a"].iloc[0] != pdf["cell_b"].iloc[0]
    x = np.stack(pdf["vec"].to_numpy()).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    norm = np.linalg.norm(x, axis=1)
    # which earlier leaves each row is in
    earlier = [r[r < leaf] for r in (np.asarray(v) for v in pdf["leaves"])]
    names, pos = np.unique(np.concatenate(earlier), return_inverse=True)
    before = np.zeros((len(x), max(1, len(names))), np.float32)
    before[np.repeat(np.arange(len(x)), [len(r) for r in earlier]), pos] = 1
    met = np.zeros(len(x), np.int64)
    links: list[tuple[np.ndarray, np.ndarray]] = []
    for i in range(0, len(x), BLOCK):
        rows = slice(i, min(i + BLOCK, len(x)))
        linked = (x[rows] @ x.T) / (norm[rows, None] * norm[None, :]) >= threshold
        linked[np.arange(linked.shape[0]), np.arange(i, i + linked.shape[0])] = False
        if crossing:
            linked &= part[rows, None] != part[None, :]
        a, b = np.nonzero(linked)
        links.append((a + i, b))
        fresh = linked & ~((before[rows] @ before.T) > 0)
        met[rows] = fresh @ weight
    top = _smallest(len(x), np.concatenate([a for a, _ in links]), np.concatenate([b for _, b in links]))
    out = pd.DataFrame({"node": node, "met": met, "top": node[top]})
    return out[(out["met"] > 0) | (out["top"] != out["node"])]


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index connected with each of n indices by links a-b."""
    top = np.arange(n)
    while len(a):
        low = top.copy()
        np.minimum.at(low, a, top[b])
        np.minimum.at(low, top[a], top[b])
        low = low[low]
        if (low == top).all():
            break
        top = low
        live = top[a] != top[b]
        a, b = a[live], b[live]
    while (top[top] != top).any():
        top = top[top]
    return top


def near_vectors(table: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str | None = "label", trees: int = TREES, seed: int = 0) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row: links join vectors of equal label
    with cosine >= ``threshold``."""
    label = F.col(label_col).cast("string") if label_col else F.lit("")
    source = table.select(F.col(id_col).alias("vec_id"), as_doubles(vec_col).alias("vec"), label.alias("label"))
    dim = common_dim(source, "vec")
    good = takes_part(F.col("vec"), dim) & F.col("label").isNotNull()
    # 128 bits name a class of equal vectors of one label
    k = [F.when(good, F.xxhash64(F.lit(s), "label", "vec")) for s in (1, 2)]
    rows = store(source.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label",
                               F.when(good, F.col("vec")).alias("vec"), k[0].alias("k1"), k[1].alias("k2")), "rp-rows")
    nodes = store(rows.where("k1 is not null").groupBy("k1", "k2").agg(
        F.min(F.struct(F.col("vec_id").isNull().alias("no_id"), "vec_id", "rid")).alias("r"),
        F.first("label").alias("label"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("weight"),
    ).select("k1", "k2", F.col("r.rid").alias("node"), F.col("r.vec_id").alias("min_id"), "label", "vec", "weight"), "rp-nodes")
    n = nodes.count()
    if n == 0:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    forest = table.sparkSession.sparkContext.broadcast(fit_forest(nodes, n, dim, threshold, trees, seed))

    @F.arrow_udf("array<int>")
    def leaves_of(vec: pa.Array) -> pa.Array:
        return pa.array(forest.value.leaves(unit(matrix(vec, dim))), pa.list_(pa.int32()))

    spread = nodes.select("node", "vec", "weight", "label", leaves_of("vec").alias("leaves"))
    spread = spread.withColumn("leaf", F.explode("leaves")).withColumn("place", F.concat_ws(":", "leaf", "label")).drop("label")
    cells = split_cells(spread, "place", F.xxhash64("node"), CHUNK)
    found = store(cells.groupBy("place", "cell_a", "cell_b").applyInPandas(
        lambda pdf: compare(pdf, dim, threshold), "node long, met long, top long"), "rp-links")
    met = found.groupBy("node").agg(F.sum("met").alias("met"))
    comp = components(found.where("top <> node").select(F.col("node").alias("a"), F.col("top").alias("b")))
    named = nodes.select("node", "k1", "k2", "weight", "min_id").join(met, "node", "left").join(comp, "node", "left") \
        .withColumn("comp", F.coalesce("comp", "node"))
    first = named.groupBy("comp").agg(F.min("min_id").alias("component_id"))
    named = named.join(first, "comp").select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "component_id",
                                             (F.col("weight") - 1 + F.coalesce("met", F.lit(0))).alias("n"))
    out = rows.join(named, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
    component = F.when(F.col("k1").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
