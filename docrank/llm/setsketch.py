"""Near-duplicate documents by SetSketch registers.

A document is the set of its word shingles.  Its sketch has m registers; register
i is the truncated logarithm (base ``BASE``) of the smallest of exponential
values (rate ``RATE``) drawn per shingle: sketches merge by the maximum, and two
registers agree about as often as the sets overlap.

1. Documents with the same shingle set form a class; one class is one node.
2. Bands of ``BAND`` registers become bucket keys; classes that share a bucket are
   candidates.  The number of bands keeps the chance to miss a pair at the
   threshold below ``MISS``.
3. In each bucket every class meets one random centre; the best centre of each
   class goes on.  Registers of both sides give the joint maximum-likelihood
   similarity (sizes are known); pairs well below the threshold stop there, the
   rest is confirmed on the full shingle sets of the texts.
4. Connected classes need no further comparison.  Buckets that still hold several
   components compare all pairs across components, in blocks of bounded size: by
   registers first, then on the full sets, and only links that connect something
   leave the block.  So no connection is lost and no list of pairs is made.
5. Components of the confirmed links give the groups.

Links are confirmed on the sets of whole texts with exact integer arithmetic (a
shingle is a 64-bit hash of its words in step 4, the words themselves in step 3);
a class holds its members by a 128-bit hash of the whole set.

Defined results: a null or empty text, or one without words, has 0 shingles, is
linked with nothing and keeps its own id as component; rows that repeat an id
with equal text are one node, with other text they are nodes that share the id;
null ids never become a component's id unless all its ids are null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrank.llm.common import Recent, by_group, group_starts, keep_one, split_cells, store, text_or_empty
from docrank.llm.components import components
from docrank.llm.filter_audit import possible_member

BASE = 1.001
RATE = 20.0
TOP = 65_535              # largest register (16 bits)
BAND = 5                  # registers of a band
MISS = 1e-5
SLACK = 0.15              # estimates this far below the threshold still are confirmed
STAR_ROUNDS = 1
CHUNK = 1_024             # rows of a block of a large bucket
CHUNK_SHINGLES = 1_000_000  # shingles of a block whose sets are compared
CACHE_ENTRIES = 100_000   # of each of two generations
REPEATS = 4_096           # rows of one id and text that are dealt to one task
MOST_DEALS = 64


# ---- shingles and sketches ---------------------------------------------------------
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased; words ``[^\\x20\\x09-\\x0D]+``."""
    return text.lower().split()


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles; with fewer words the
    whole sequence is one."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = keep_one("shingles", lambda: Recent(CACHE_ENTRIES))
    new = hashes.missing(set(words))
    hashes.now.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
    h = np.fromiter(map(hashes.now.__getitem__, words), np.uint64, len(words))
    size = min(k, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - size + 1 + i])
    return np.unique(out)


def _each(texts: pa.Array):
    """The texts of a column as bytes, a few at a time."""
    for i in range(0, len(texts), 256):
        yield from texts.slice(i, 256).cast(pa.binary()).to_pylist()


def shingle_set(text: bytes, k: int) -> set:
    words = words_of(text)
    k = min(k, len(words))
    return set(zip(*(words[i:len(words) - k + 1 + i] for i in range(k)))) if words else set()


@lru_cache
def _multipliers(m: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20)
    return (r.integers(0, 2**63, m, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            r.integers(0, 2**63, m, dtype=np.uint64))


def registers(x: np.ndarray, m: int) -> np.ndarray:
    """SetSketch registers of a non-empty set of 64-bit hashes."""
    a, c = _multipliers(m)
    low = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(x), 1024):
        part = x[None, i:i + 1024]
        low = np.minimum(low, ((part ^ c[:, None]) * a[:, None]).min(axis=1))
    least = -np.log1p(-(low.astype(np.float64) + 1) / 2.0**64 * (1 - 2.0**-52)) / RATE
    return np.clip(np.floor(1 - np.log(least) / math.log(BASE)), 0, TOP).astype("<u2")


def likely_similarity(higher: np.ndarray, lower: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from the numbers of registers of a that
    are higher than, lower than and equal to b's, given both set sizes."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)

    def p(x):
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / math.log(BASE)

    def loglik(j):
        a, b = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
        return higher * np.log(a) + lower * np.log(b) + equal * np.log(np.maximum(1 - a - b, 1e-12))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the log-likelihood is concave in the similarity
        x, y = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        up = loglik(x) < loglik(y)
        lo, hi = np.where(up, x, lo), np.where(up, hi, y)
    return (lo + hi) / 2


def _likely(a: np.ndarray, b: np.ndarray, n_a, n_b) -> np.ndarray:
    return likely_similarity((a > b).sum(axis=1), (a < b).sum(axis=1), (a == b).sum(axis=1),
                             np.asarray(n_a, float), np.asarray(n_b, float))


def bands_for(similarity: float) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - similarity**BAND))


# ---- jobs --------------------------------------------------------------------------
def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``rid, doc_id, n_shingles, component_id, first`` per row of ``docs``: links join
    documents with 100 * intersection >= ``percent`` * union of their shingle sets;
    ``component_id`` is the smallest id that links lead to, ``first`` marks one row of
    each component.  ``rid`` numbers the rows of this result only."""
    bands = bands_for(percent / 100)
    m = bands * BAND

    @F.arrow_udf("n long, fp binary, sketch binary")
    def sketch(text: pa.Array) -> pa.Array:
        n, fp, regs = [], [], []
        for t in _each(text):
            x = shingle_hashes(t, words)
            n.append(len(x))
            fp.append(xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None)
            regs.append(registers(x, m).tobytes() if len(x) else None)
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(regs, pa.binary())],
                                          names=["n", "fp", "sketch"])

    source = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    keys = {"k1": F.xxhash64("text", F.col("doc_id").cast("string")), "k2": F.xxhash64(F.lit(2), "text", F.col("doc_id").cast("string"))}
    rows = source.withColumns(keys).withColumn("s", sketch("text"))
    rows = store(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "k1", "k2", "s.*"), "nd-rows")
    classes = store(rows.where("n > 0").groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid", "k1", "k2")).alias("r"),
        F.first("n").alias("n"), F.first("sketch").alias("sketch"),
    ).select(F.col("r.rid").alias("rep"), "r.k1", "r.k2", "fp", F.col("r.doc_id").alias("min_id"), "n", "sketch"), "nd-classes")

    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("sketch", 1 + 2 * BAND * i, 2 * BAND)) for i in range(bands)])
    band = classes.select("rep", F.posexplode(keys).alias("band", "bucket"))
    shared = band.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket")
    members = store(band.join(shared, "bucket"), "nd-members")
    nodes = store(classes.select("rep", "k1", "k2", "n", "sketch").join(members.select("rep").distinct(), "rep", "left_semi"), "nd-nodes")
    texts = _texts(source, rows, nodes)
    nodes = nodes.select("rep", "n", "sketch")

    links = comp = None
    for turn in range(STAR_ROUNDS):
        stars = _stars(members, comp, turn)
        good = _confirm(_likely_pairs(stars, nodes, percent / 100 - SLACK), texts, words, percent)
        links = good if links is None else links.unionByName(good)
        comp = store(components(links), "nd-comp")
    links = links.unionByName(store(_across(members, comp, nodes, texts, words, percent), "nd-links"))
    comp = components(links).withColumnRenamed("node", "rep")

    named = classes.select("rep", "fp", "min_id").join(comp, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    ids = named.groupBy("comp").agg(F.min(F.struct(F.col("min_id").isNull().alias("no_id"), "min_id", "rep")).alias("f"))
    named = named.join(ids, "comp").select("fp", F.col("f.min_id").alias("component_id"), F.col("f.rep").alias("first_rep"))
    out = rows.select("rid", "doc_id", "n", "fp").join(named, "fp", "left")
    return out.select("rid", "doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      ((F.col("n") == 0) | (F.col("rid") == F.col("first_rep"))).alias("first"), "fp")


def _texts(source: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rep, text`` of the classes that have candidates.  Other texts are neither shuffled,
    sorted nor grouped, but for the few that a Bloom filter of those classes' keys lets
    through; none are shuffled before the join where the keys can be broadcast."""
    need = store(nodes.select("rep", "k1", "k2"), "nd-keys")  # so that its size is known
    possible = possible_member(need.select(F.col("k1").alias("hash")))
    keyed = source.select(F.xxhash64("text", F.col("doc_id").cast("string")).alias("k1"),
                          F.xxhash64(F.lit(2), "text", F.col("doc_id").cast("string")).alias("k2"), "text").where(possible("k1"))
    # rows that repeat id and text go to several tasks, by the partition they come from
    most = rows.groupBy("k1", "k2").count().agg(F.max("count")).first()[0] or 0
    deals = min(MOST_DEALS, math.ceil(most / REPEATS))
    on = ["k1", "k2"]
    if deals > 1:
        keyed = keyed.withColumn("deal", F.pmod(F.spark_partition_id(), F.lit(deals)))
        need = need.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
        on = [*on, "deal"]
    found = keyed.join(need, on)
    if deals > 1:
        found = found.groupBy("rep", *on).agg(F.first("text").alias("text"))
    # (a class has one pair of keys: by all three, rows dealt by the keys stay where they are)
    return store(found.groupBy("k1", "k2", "rep").agg(F.first("text").alias("text")).select("rep", "text"), "nd-texts")


def _labelled(members: DataFrame, comp: DataFrame | None) -> DataFrame:
    """Members of the buckets that hold several components, with their component."""
    if comp is None:
        return members.withColumn("comp", F.col("rep"))
    rows = members.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    mixed = rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("bucket")
    return rows.join(mixed, "bucket")


def _stars(members: DataFrame, comp: DataFrame | None, turn: int) -> DataFrame:
    """``a, b``: for each class the centre, of another component, that it shares most
    buckets with.  A bucket's centre is its member of least hash."""
    rows = _labelled(members, comp)
    pick = F.xxhash64("rep", "bucket", F.lit(turn))
    centre = rows.groupBy("bucket").agg(F.min(F.struct(pick.alias("h"), "rep", "comp")).alias("c")) \
        .select("bucket", F.col("c.rep").alias("a"), F.col("c.comp").alias("ca"))
    meet = rows.join(centre, "bucket").where("comp <> ca").groupBy(F.col("rep").alias("b"), "a").agg(F.count(F.lit(1)).alias("k"))
    best = meet.groupBy("b").agg(F.max(F.struct("k", "a")).alias("best"))
    return best.select(F.col("best.a").alias("a"), "b")


def _likely_pairs(pairs: DataFrame, nodes: DataFrame, cut: float) -> DataFrame:
    """Pairs whose likely similarity reaches ``cut``."""
    @F.arrow_udf("double")
    def likely(sa: pa.Array, sb: pa.Array, na: pa.Array, nb: pa.Array) -> pa.Array:
        if not len(sa):
            return pa.array([], pa.float64())
        a, b = (np.frombuffer(b"".join(s.to_pylist()), "<u2").reshape(len(s), -1) for s in (sa, sb))
        return pa.array(_likely(a, b, na.to_numpy(), nb.to_numpy()))

    a = nodes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = nodes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return pairs.join(b, "b").join(a, "a").where(likely("sa", "sb", "na", "nb") >= cut).select("a", "b")


def _across(members: DataFrame, comp: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``a, b``: links between classes of different components that share a bucket,
    enough of them to connect what is connected.  Likely pairs are found by their
    registers, each in its first shared bucket, and confirmed on the full shingle
    sets inside the same cell; a pair that is connected already is skipped.  No
    pair leaves a task unless it is a link that joins two parts."""
    keys = ["bucket", "cell_a", "cell_b"]

    def likely(t: pa.Table) -> pa.Table:
        found = [np.concatenate(p) for p in _likely_in(t, keys, percent)]
        rows = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        return t.select(["bucket", "rep"]).take(pa.array(rows, pa.int64()))

    def confirm(t: pa.Table) -> pa.Table:
        rep, text = t.column("rep").to_numpy(), t.column("text")
        up, sets, a, b = {}, {}, [], []

        def find(x):
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        def shingles(i):
            if i not in sets:
                sets[i] = shingle_hashes(text[i].as_py().encode(), words)
            return sets[i]

        for i, j in _likely_in(t, keys, percent):
            for x, y in zip(i.tolist(), j.tolist()):
                p, q = find(rep[x]), find(rep[y])
                if p != q:
                    u, v = shingles(x), shingles(y)
                    both = len(np.intersect1d(u, v, assume_unique=True))
                    if 100 * both >= percent * (len(u) + len(v) - both):
                        up[q] = p
                        a.append(rep[x])
                        b.append(rep[y])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = _labelled(members, comp).join(nodes, "rep")
    cells = split_cells(rows, "bucket", F.xxhash64("rep"), CHUNK)
    need = store(by_group(cells, keys, likely, "bucket long, rep long").distinct(), "nd-need")
    full = rows.join(need, ["bucket", "rep"]).join(texts, "rep")
    cells = split_cells(full, "bucket", F.xxhash64("rep"), CHUNK_SHINGLES, F.col("n"))
    return by_group(cells, keys, confirm, "a long, b long")


def _likely_in(t: pa.Table, keys: list[str], percent: int):
    """Pairs of rows of a table of whole cells that are likely similar: arrays i, j."""
    own, n, part, low, high, band = (t.column(c).to_numpy() for c in ("comp", "n", "cell_c", "cell_a", "cell_b", "band"))
    sk = np.frombuffer(b"".join(t.column("sketch").to_pylist()), "<u2").reshape(t.num_rows, -1)
    cut = percent / 100 - SLACK
    for i, j in _pairs(group_starts(t, keys), t.num_rows):
        ok = own[i] != own[j]
        ok &= (low[i] == high[i]) | (part[i] != part[j])
        # sets so different in size cannot be similar enough
        ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        i, j = i[ok], j[ok]
        same = sk[i] == sk[j]
        ok = same.sum(axis=1) >= (cut - 0.1) * sk.shape[1]
        ok &= same.reshape(len(i), sk.shape[1] // BAND, BAND).all(axis=2).argmax(axis=1) == band[i]
        i, j = i[ok], j[ok]
        ok = _likely(sk[i], sk[j], n[i], n[j]) >= cut
        if ok.any():
            yield i[ok], j[ok]


def _pairs(starts: np.ndarray, rows: int, most: int = 1 << 16):
    """Index pairs (i, j) of rows of the same group, some ten thousand at a time;
    ``starts`` holds where the groups begin."""
    sizes = np.diff(np.r_[starts, rows])
    for size in np.unique(sizes):
        begin = starts[sizes == size]
        if size < 2:
            continue
        if size * (size - 1) // 2 <= most:
            a, b = np.triu_indices(size, 1)
            step = max(1, most // len(a))
            for k in range(0, len(begin), step):
                at = begin[k:k + step, None]
                yield (at + a).ravel(), (at + b).ravel()
        else:
            step = max(1, most // size)
            for s in begin:
                for k in range(0, size, step):
                    a, b = np.divmod(np.arange(min(step, size - k) * size), size)
                    a += k
                    yield s + a[a < b], s + b[a < b]


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    @F.arrow_udf("boolean")
    def linked(ta: pa.Array, tb: pa.Array) -> pa.Array:
        out, last, sa = [], None, set()
        for a, b in zip(_each(ta), _each(tb)):
            if a != last:
                last, sa = a, shingle_set(a, words)
            sb = shingle_set(b, words)
            both = len(sa & sb)
            out.append(100 * both >= percent * (len(sa) + len(sb) - both))
        return pa.array(out, pa.bool_())

    a = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))
    return store(pairs.join(b, "b").join(a, "a").where(linked("ta", "tb")).select("a", "b"), "nd-links")


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` less all but one of each group: the one of smallest id
    (rows without words stay)."""
    # the rows are fixed once, with a number of their own, so that the decision finds them again
    fixed = store(docs.withColumn("__row", F.monotonically_increasing_id()), "nd-docs")
    pick = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col("__row"))
    found = near_duplicates(fixed.withColumn("__pick", pick), words, percent, "__pick", text_col)
    # the rows to drop are few and stored: where their numbers can be broadcast no text is shuffled
    out = store(found.where(~F.coalesce("first", F.lit(False))).select(F.col("doc_id.__row").alias("__row")), "nd-out")
    return fixed.join(out, "__row", "left_anti").drop("__row")


def near_duplicate_report(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    return near_duplicates(docs, words, percent).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
