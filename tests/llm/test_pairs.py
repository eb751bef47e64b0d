"""Near duplicates, vector search and near vectors against brute force."""
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docrank.llm import perm_index, rp_forest, setsketch
from docrank.llm.common import split_cells
from docrank.llm.components import components
from docrank.llm.filter_audit import possible_member
from docrank.llm.queries import op1_permutation_index, op2_rp_forest, op7_setsketch

from .conftest import HARD, documents, save

SF = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<double>, label int"


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


# ---- components and cells ------------------------------------------------------------
def test_components(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(100, 180)] + [(200, 200 + i) for i in range(1, 50)] + [(5, 5)]
    links += [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)]
    u = Union()
    for a, b in links:
        u.join(a, b)
    got = {x.node: x.comp for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: u.find(x) for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_cells_bring_every_pair_together_once(spark):
    rows = spark.range(50).select(F.lit("k").alias("key"), "id").union(spark.createDataFrame([("one", 99)], "key string, id long"))
    cells = split_cells(rows, "key", F.col("id"), 8).collect()
    groups = defaultdict(list)
    for c in cells:
        groups[c.cell_a, c.cell_b].append((c.id, c.cell_c))
    met = []
    for (a, b), m in groups.items():
        met += [(x, y) for x, p in m for y, q in m if x < y and (a == b or p != q)]
    assert sorted(met) == [(x, y) for x in range(50) for y in range(x + 1, 50)]
    assert max(len(m) for m in groups.values()) <= 16 and len({c.key for c in cells}) == 1


# ---- near duplicates -----------------------------------------------------------------
def brute_documents(rows, words, percent):
    sets = [setsketch.shingle_set((t or "").encode(), words) for _, t in rows]
    u = Union()
    for i, a in enumerate(sets):
        u.find(i)
        for j in range(i):
            n = len(a & sets[j])
            if a and sets[j] and 100 * n >= percent * (len(a) + len(sets[j]) - n):
                u.join(i, j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[u.find(i)].append(d)
    low = {c: min((d for d in ds if d is not None), default=None) for c, ds in ids.items()}
    return [(d, len(sets[i]), low[u.find(i)], d is not None and d == low[u.find(i)]) for i, (d, _) in enumerate(rows)]


def near_texts(seed, groups=12, size=9):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    out = []
    for _ in range(groups):
        base = r.choices(vocabulary, k=r.randint(3, 200))
        for _ in range(r.randint(1, size)):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 5, 20])):
                t[r.randrange(len(t))] = r.choice(vocabulary)
            out.append(r.choice([" ", "\n", "  "]).join(t).swapcase() if r.random() < 0.2 else " ".join(t))
    return out


def key(r):
    return tuple("" if x is None else str(x) for x in r)


@pytest.mark.parametrize("words,percent,chunk", [(3, 85, 1024), (5, 80, 2)])
def test_near_duplicates(spark, words, percent, chunk, monkeypatch):
    monkeypatch.setattr(setsketch, "CHUNK", chunk)
    rows = [(i, t) for i, t in enumerate(near_texts(words), 100)] + HARD + [(30, "a b"), (31, "A B"), (32, "a"), (33, "a b c")]
    random.Random(1).shuffle(rows)
    got = setsketch.near_duplicate_report(documents(spark, rows), words, percent).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_documents(rows, words, percent), key=key)


def test_chain_of_links_without_a_common_centre(spark):
    # each text shares nine tenths with the next one only
    words = [f"x{i}" for i in range(600)]
    rows = [(i, " ".join(words[i * 10:i * 10 + 200])) for i in range(40)]
    got = setsketch.near_duplicate_report(documents(spark, rows), 3, 85).collect()
    assert {(r.component_id, r.kept) for r in got} == {(0, True), (0, False)}


def test_deduplicate_keeps_one_row_of_each_group(spark):
    rows = [(i, t) for i, t in enumerate(near_texts(7), 100)] + HARD
    docs = documents(spark, rows).withColumn("rid", F.lit(1)).withColumn("fp", F.lit("x"))
    got = setsketch.deduplicate(docs, 5, 80)
    assert got.columns == docs.columns
    brute = brute_documents(rows, 5, 80)
    want = sum(n == 0 for _, n, _, _ in brute) + len({c for _, n, c, _ in brute if n and c is not None})
    out = got.collect()
    assert len(out) == want + 2            # the row of a null id, and the second text of id 6
    assert {r.doc_id for r in out if r.text and r.text.strip()} - {None} == {d for d, n, c, k in brute if n and k}


def test_deduplicate_moves_no_text_for_a_few_rows_to_drop(spark, monkeypatch):
    # only texts of candidates are grouped, and the rows to drop go to the texts
    plans, keep = {}, setsketch.store
    monkeypatch.setattr(setsketch, "store", lambda df, name: plans.update(
        {name: df._jdf.queryExecution().executedPlan().toString()}) or keep(df, name))
    rows = [(i, t) for i, t in enumerate(near_texts(9), 100)] + HARD
    got = setsketch.deduplicate(documents(spark, rows), 5, 80)
    last = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in last and "SortMergeJoin" not in last and "Exchange hashpartitioning" not in last
    texts = plans["nd-texts"]
    assert texts.index("partial_first(text") < texts.index("Join")      # printed from the top: joined first


@pytest.mark.parametrize("repeats,threshold", [(2, "-1"), (2, "10m"), (4096, "-1")])
def test_rows_that_repeat_id_and_text(spark, repeats, threshold, monkeypatch):
    monkeypatch.setattr(setsketch, "REPEATS", repeats)
    base = [(i, t) for i, t in enumerate(near_texts(11, groups=6), 100)]
    rows = base + [base[0]] * 9 + [(None, base[3][1])] * 7 + [(None, None)] * 3 + HARD
    random.Random(2).shuffle(rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        docs = documents(spark, rows).repartition(6)
        got = setsketch.near_duplicate_report(docs, 5, 80).collect()
        brute = brute_documents(rows, 5, 80)
        assert sorted(map(tuple, got), key=key) == sorted(brute, key=key)
        out = setsketch.deduplicate(docs, 5, 80).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    sets = [setsketch.shingle_set((t or "").encode(), 5) for _, t in rows]
    assert sum(not r.text or not r.text.strip() for r in out) == sum(not s for s in sets)
    assert {r.doc_id for r in out if r.text and r.text.strip()} - {None} == {d for d, n, c, k in brute if n and k}


def moved(df, column):
    """Rows of each shuffle that holds ``column``, of the plan that ran."""
    df.collect()
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        else:
            if name == "ShuffleExchangeExec" and f"{column}#" in p.output().mkString(","):
                out.append(p.metrics().apply("shuffleRecordsWritten").value())
            todo += [p.children().apply(i) for i in range(p.children().size())]
    return out


def test_texts_without_candidates_are_not_shuffled_when_keys_cannot_be_broadcast(spark, monkeypatch):
    frames, keep = {}, setsketch.store
    monkeypatch.setattr(setsketch, "store", lambda df, name: frames.update({name: df}) or keep(df, name))
    alone = [(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(1000, 1400)]
    rows = alone + [(i, t) for i, t in enumerate(near_texts(13, groups=4, size=5), 100)] + HARD
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = setsketch.near_duplicate_report(documents(spark, rows), 5, 80).collect()
        assert sorted(map(tuple, got), key=key) == sorted(brute_documents(rows, 5, 80), key=key)
        need = keep(frames["nd-texts"], "again").count()
        texts = moved(frames["nd-texts"], "text")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert 0 < need < 40 and len(texts) == 1 and need <= texts[0] < 60


def test_possible_members(spark):
    rows = spark.range(3_000).select("id", F.xxhash64("id").alias("hash"))
    may = possible_member(rows.where("id % 3 = 0").select("hash"))
    got = {r.id: r.may for r in rows.select("id", may("hash").alias("may")).collect()}
    assert all(got[i] for i in range(0, 3_000, 3)) and sum(got.values()) < 1_200
    none = possible_member(rows.where("id < 0").select("hash"))
    assert rows.where(none("hash")).count() == 0


def test_registers_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(0)
    for overlap in (0.3, 0.6, 0.9):
        shared, own = int(2000 * overlap), int(2000 * (1 - overlap) / 2)
        x = rng.integers(0, 2**63, shared + 2 * own, dtype=np.uint64)
        a, b = x[:shared + own], np.r_[x[:shared], x[shared + own:]]
        m = 1000
        ra, rb = setsketch.registers(np.unique(a), m), setsketch.registers(np.unique(b), m)
        assert abs((ra == rb).mean() - overlap) < 0.06
        assert abs(setsketch._likely(ra[None], rb[None], [len(a)], [len(b)])[0] - overlap) < 0.05
        merged = setsketch.registers(np.unique(x), m)
        assert (np.maximum(ra, rb) == merged).all()


def test_near_duplicate_query(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = op7_setsketch(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(brute_documents([tuple(d) for d in docs], 3, 85))
    empty = op7_setsketch(spark, save(documents(spark, HARD).limit(0), tmp_path, "documents"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]


# ---- vectors -------------------------------------------------------------------------
def good(v, dim):
    return v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v) and any(v)


def hard_vectors(seed=1, n=300, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    rows = [(int(i), (centres[i % 12] + 0.25 * rng.standard_normal(dim)).tolist(), int(i % 3)) for i in range(n)]
    rows += [(i + 1000, v, lab) for i, (_, v, lab) in enumerate(rows[:20])]            # equal vectors
    rows += [rows[0], (7, rows[7][1], 2), (None, rows[3][1], 0), (2000, [10 * x for x in rows[3][1]], 0),
             (2020, None, 0), (2040, [], 0), (2060, [0.0] * dim, 0), (2080, [float("nan")] + [1.0] * (dim - 1), 0),
             (2100, [float("inf")] + [1.0] * (dim - 1), 0), (2120, [None] + [1.0] * (dim - 1), 0), (2140, rows[1][1], None),
             (2160, [1.0, 2.0], 0), (2180, [1e-200 * x for x in rows[3][1]], 0), (2200, [1e200 * x for x in rows[3][1]], 0)]
    return rows


def brute_vectors(rows, dim, threshold):
    ok = [good(v, dim) and lab is not None for _, v, lab in rows]
    units = [np.array(v) / max(map(abs, v)) if o else None for (_, v, _), o in zip(rows, ok)]
    units = [x / np.linalg.norm(x) if x is not None else None for x in units]
    u, links = Union(), [0] * len(rows)
    for i in range(len(rows)):
        u.find(i)
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and units[i] @ units[j] >= threshold:
                u.join(i, j)
                links[i] += 1
                links[j] += 1
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[u.find(i)].append(r[0])
    low = {c: min((d for d in ds if d is not None), default=None) for c, ds in ids.items()}
    return sorted(((r[0], links[i], low[u.find(i)], r[0] is not None and r[0] == low[u.find(i)]) for i, r in enumerate(rows)), key=key)


@pytest.mark.parametrize("leaf,chunk", [(4096, 2048), (64, 2048), (64, 5)])
def test_near_vectors(spark, leaf, chunk, monkeypatch):
    monkeypatch.setattr(rp_forest, "LEAF_ROWS", leaf)
    monkeypatch.setattr(rp_forest, "CHUNK", chunk)
    rows = hard_vectors()
    table = spark.createDataFrame(rows, VEC).withColumn("rid", F.lit(0))
    got = rp_forest.near_vectors(table, 0.93, trees=12).collect()
    assert sorted(map(tuple, got), key=key) == brute_vectors(rows, 8, 0.93)


def test_near_vectors_query(spark, tmp_path):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op2_rp_forest(spark, SF).collect()), key=key) == brute_vectors(rows, len(rows[0][1]), 0.93)
    for part in (spark.createDataFrame([], VEC), spark.createDataFrame([(1, None, 1), (2, [0.0], 1)], VEC)):
        got = rp_forest.near_vectors(part).collect()
        assert [tuple(r) for r in sorted(got)] == [(i, 0, i, True) for i in (1, 2)[:part.count()]]


def test_forest_splits_and_spills():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    f = rp_forest.Forest(x, trees=3, leaf=200, margin=0.03)
    leaves = f.leaves(x)
    assert len(leaves) == 4000 and all(len(v) >= 3 for v in leaves) and max(map(len, leaves)) > 3
    sizes = np.bincount(np.concatenate(leaves))
    assert len(sizes) == f.n_leaves and sizes.max() <= 200


def recall(got, rows, dim, k=20):
    ok = [r for r in rows if good(r[1], dim)]
    x = np.array([r[1] for r in ok])
    found = defaultdict(list)
    for r in got:
        found[r.query_id].append(r)
    shares = []
    for i, (d, _, _) in enumerate(ok):
        if d is None or d % 20:
            continue
        s = x @ x[i]
        s[i] = -np.inf
        best = np.sort(s)[::-1][:min(k, len(ok) - 1)]
        mine = [r.score for r in sorted(found[d], key=lambda r: r.rank)]
        shares.append(np.mean([b <= min(mine) + 1e-9 or any(math.isclose(b, m, rel_tol=1e-9) for m in mine) for b in best]))
    return float(np.mean(shares))


def test_search(spark, monkeypatch):
    rows = [r for r in hard_vectors(5, 400) if r[0] not in (2200,)]
    table = spark.createDataFrame(rows, VEC)
    monkeypatch.setattr(perm_index, "BLOCK_ROWS", 150)
    monkeypatch.setattr(perm_index, "BLOCK_QUERIES", 10)
    got = perm_index.search_report(table).collect()
    queries = [r for r in rows if good(r[1], 8) and r[0] is not None and r[0] % 20 == 0]
    assert len(got) == 20 * len(queries) and recall(got, rows, 8) > 0.95
    by = defaultdict(list)
    for r in got:
        by[r.query_id].append(r)
    vec = defaultdict(list)
    for d, v, _ in rows:
        vec[d].append(v)
    for q, rs in by.items():
        rs.sort(key=lambda r: r["rank"])
        if len(vec[q]) == 1:
            assert [r["rank"] for r in rs] == list(range(1, 21))
            assert [r.score for r in rs] == sorted((r.score for r in rs), reverse=True)
            assert all(any(math.isclose(r.score, np.dot(v, vec[q][0]), rel_tol=1e-9) for v in vec[r.vec_id]) for r in rs)
            order = [(-r.score, 1e9 if r.vec_id is None else r.vec_id) for r in rs]
            assert order == sorted(order)


def test_search_finds_long_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 16)) * rng.lognormal(0, 0.7, (3000, 1))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = perm_index.search_report(spark.createDataFrame(rows, VEC)).collect()
    assert recall(got, rows, 16) > 0.9


def test_search_with_a_third_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(perm_index, "LEAST_CANDIDATES", 64)
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((40, 16))
    x = centres[rng.integers(0, 40, 6000)] + 0.3 * rng.standard_normal((6000, 16))
    copies = rng.permutation(6000)[:2000]
    x[copies] = x[copies[0]]
    rows = [(int(i), v.tolist(), 0) for i, v in zip(rng.permutation(6000), x)]
    found = defaultdict(dict)
    for r in perm_index.search_report(spark.createDataFrame(rows, VEC)).collect():
        found[r.query_id][r["rank"]] = r.vec_id
    ids, equal = np.array([r[0] for r in rows]), set(copies.tolist())
    near = [[], []]
    for i in np.flatnonzero(ids % 20 == 0):
        score = (x * x[i]).sum(axis=1)
        score[i] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]].tolist()
        mine = [found[ids[i]][rank] for rank in range(1, 21)]
        near[i in equal].append(len(set(mine) & set(best)) / 20)
        assert len(set(mine)) == 20
    assert np.mean(near[0]) > 0.9 and np.mean(near[1]) > 0.9
    assert sum(map(len, near)) == 300 and len(near[1]) > 50


def test_nearest_takes_all_rows_tied_at_the_cut():
    px = np.array([[0, 1], [0, 1], [0, 1], [2, 3], [0, 2]])
    files = perm_index.InvertedFiles(px, 4)
    assert files.nearest(np.array([0, 1]), 2, ties=True).tolist() == [0, 1, 2]
    assert files.nearest(np.array([0, 1]), 4, ties=True).tolist() == [0, 1, 2, 4]


def test_search_query(spark, tmp_path):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = op1_permutation_index(spark, "/root/testdata/sf0.1").collect()
    assert recall(got, rows, len(rows[0][1])) > 0.9
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (20, [0.5, 0.5], 1), (3, [0.0, 1.0], 1), (4, None, 1)], VEC)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in perm_index.search_report(few).collect())
    assert got == [(0, 1, 20, 0.5), (0, 2, 3, 0.0), (20, 1, 0, 0.5), (20, 2, 3, 0.5)]
    assert perm_index.search_report(spark.createDataFrame([], VEC)).collect() == []


def test_footrule_is_what_the_lists_add_up():
    rng = np.random.default_rng(1)
    n_pivots, length = 30, 8
    px = np.array([rng.permutation(n_pivots)[:length] for _ in range(50)])
    files = perm_index.InvertedFiles(px, n_pivots)

    def footrule(a, b):
        pa, pb = ({int(p): i for i, p in enumerate(v)} for v in (a, b))
        return sum(abs(pa.get(p, length) - pb.get(p, length)) for p in {*pa, *pb})

    for q in px[:10]:
        d = np.array([footrule(q, x) for x in px])
        for most in (1, 5, 20):
            got = files.nearest(q, most)
            assert sorted(d[got]) == sorted(d)[:most]
