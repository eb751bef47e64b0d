"""The filter audit and embedding whitening against brute force, and their edge cases."""
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from docrank.llm import filter_audit, whitening
from docrank.llm.queries import op12_filter_audit, op13_feast_whitening

from .conftest import HARD, documents, save

SF = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int"
VECTORS = "vec_id long, embedding array<float>, label int"


# ---- audit ---------------------------------------------------------------------------
def brute_masks(rows):
    """(part, doc_id, failed letters) of ``(doc_id, text, lang)`` rows."""
    out = []
    for doc_id, text, lang in rows:
        t = text or ""
        words = [w for w in t.encode().split()]
        first = [d for d, s, _ in rows if (s or "") == t and d is not None and doc_id is not None and d < doc_id]
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t), "E": bool(first)}
        out.append((lang or "", doc_id, {k for k, v in fails.items() if v}))
    return out


def brute_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    masks, out = brute_masks(rows), []
    for part in {p for p, _, _ in masks}:
        of = [(d, m) for p, d, m in masks if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        mine = []
        for order in map("".join, permutations("ABCDE")):
            for i, f in enumerate(order):
                before = set(order[:i])
                gone = [d for d, m in of if f in m and not m & before]
                shapley[f] += len(gone)
                mine.append([part, order, i + 1, sum(not m & (before | {f}) for _, m in of), len(gone),
                             sum(f in m and bool(m & before) for _, m in of), sum(m == {f} for _, m in of),
                             sum(d in good for d in gone), sum(d in toxic for d in gone)])
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in mine]
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_audit_of_hard_rows(spark, tmp_path):
    rows = [(*r, "en") for r in HARD] + [(20, "first", None), (21, "UPPER CASE # text", "de"), (22, " ".join(f"w{i}" for i in range(120)), ""),
                                         (23, "\x0bfirst\x0c", "de"), (24, "first", "de"), (25, "first", "de")]
    labels = [(1, 1, 0), (1, 0, None), (24, 1, 1), (24, 1, 1), (None, 1, 1), (99, 1, 1), (25, None, None), (21, 0, 1)]
    docs = documents(spark, rows)
    clashing = docs.withColumns({c: F.lit("x") for c in ("part", "mask", "key", "n", "words", "possible", "first", "good", "toxic", "s", "hash")})
    got = filter_audit.audit_report(clashing, spark.createDataFrame(labels, LABELS).withColumn("good", F.lit("x")))
    assert audited(got) == brute_audit(rows, labels)
    save(docs.limit(0), tmp_path, "documents")
    assert op12_filter_audit(spark, save(spark.createDataFrame([], LABELS), tmp_path, "labels")).collect() == []


def test_audit_of_the_table(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = op12_filter_audit(spark, SF)
    assert got.columns == COLUMNS and audited(got) == brute_audit(rows, labels)


def test_sketch_misses_no_repeat_and_clears_most(spark):
    n = 20_000
    docs = spark.range(n).select("id", F.concat(F.lit("text "), F.when(F.col("id") % 10 == 0, F.col("id") % 100).otherwise(F.col("id"))).alias("text"))
    test = filter_audit.possible_repeat(docs, F.col("text"))
    told = {r.id: r.p for r in docs.select("id", test(F.col("text")).alias("p")).collect()}
    assert all(told[i] for i in range(0, n, 10))
    assert sum(told[i] for i in range(n) if i % 10) < 0.1 * n


def test_full_sketch_changes_no_result(spark, monkeypatch):
    want = sorted(map(tuple, filter_audit.failure_masks(spark.read.parquet(f"{SF}/documents.parquet")).collect()))
    # what a sketch says in which every slot is full
    monkeypatch.setattr(filter_audit, "possible_repeat", lambda docs, text: lambda c: F.lit(True))
    got = sorted(map(tuple, filter_audit.failure_masks(spark.read.parquet(f"{SF}/documents.parquet")).collect()))
    assert got == want


# ---- whitening ------------------------------------------------------------------------
def brute_whiten(rows, k=4):
    """(n, {component: eigenvalue, explained}, whitened by id) with a dense solver."""
    x = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in rows}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, s = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T.astype(float), bias=True).reshape(fit.shape[1], -1)
    e, y = np.linalg.eigh(v)
    e, y = e[::-1][:k], y[:, ::-1][:, :k]
    deviation = {i: int(((n * a - s).astype(object) ** 2).sum()) for i, a in x.items()}
    return n, e / np.trace(v), {i: (a - s / n) @ y / np.sqrt(e) for i, a in x.items()}, deviation


def test_whitening_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, explained, white, deviation = brute_whiten(rows)
    got = op13_feast_whitening(spark, SF).collect()
    assert len(got) == 4 * len(rows)
    by = {(r.vec_id, r.component): r for r in got}
    for c in range(1, 5):
        a, b = np.array([by[i, c].whitened for i, _ in rows]), np.array([white[i][c - 1] for i, _ in rows])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8       # one sign for all rows
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    assert all(abs(r.explained / explained[r.component - 1] - 1) < 1e-10 and r.deviation == deviation[r.vec_id] for r in got)


def test_whitening_of_hard_rows(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 5), float(i * i % 7), 1.0]) for i in range(1, 12)]
    rows = [(i, v, 0) for i, v in good] + [(50, None, 0), (51, [nan, 1.0, 2.0], 0), (52, [inf, 1.0, 2.0], 0), (53, [1.0, None, 2.0], 0),
                                          (54, [1.0, 2.0], 0), (55, [], 0), (1, good[0][1], 0), (None, good[1][1], None)]
    table = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("y") for c in ("x", "at", "s", "component")})
    got = whitening.whiten(table).collect()
    n, explained, white, deviation = brute_whiten(good)
    assert {r.component for r in got} == {1, 2} and len(got) == 2 * 13     # the third entry is constant
    for r in got:
        if r.vec_id is not None:
            assert abs(abs(r.whitened) - abs(white[r.vec_id][r.component - 1])) < 1e-9 and r.deviation == deviation[r.vec_id] and r.n == n
    for left in (rows[:1], [], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], [(1, None, 0)]):
        out = whitening.whiten(spark.createDataFrame(left, VECTORS))
        assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_have_exact_deviations_or_null(spark):
    rows = [(i, [float(2.0**k * i), 1.0 * (i % 2)], 0) for i, k in enumerate([20, 20, 20, 50], 1)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    _, _, _, want = brute_whiten([(i, v) for i, v, _ in rows])
    assert got == {i: d if d < 2**63 else None for i, d in want.items()} and None in got.values()


@pytest.mark.parametrize("kind", ["gauss", "low", "tie", "geometric", "equal", "close"])
@pytest.mark.parametrize("d", [1, 2, 5, 40])
def test_eigenpairs_against_a_dense_solver(d, kind):
    rng = np.random.default_rng(d)
    values = {"gauss": rng.random(d) * 100, "low": np.r_[rng.random(min(d, 2)), np.zeros(max(0, d - 2))],
              "tie": np.r_[np.full(min(d, 6), 3.0), rng.random(max(0, d - 6))], "geometric": 10.0 ** -np.arange(d).clip(0, 15),
              "equal": np.ones(d), "close": 1 + 1e-9 * rng.random(d)}[kind]
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    v = q * values @ q.T
    e, y = whitening.leading((v + v.T) / 2)
    want = np.sort(values)[::-1][:4]
    want = want[want > d * whitening.EPS * values.sum()]
    assert np.allclose(e, want, rtol=1e-11, atol=1e-14) and np.allclose(y.T @ y, np.eye(len(e)), atol=1e-9)
    assert np.abs(v @ y - y * e).max() < 1e-12 * d * values.max()


def test_inertia_counts(spark):
    rng = np.random.default_rng(3)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    t = whitening.tridiagonal(a)
    e = np.linalg.eigvalsh(a)
    assert all(whitening.count_below(*t, s) == (e < s).sum() for s in np.r_[(e[1:] + e[:-1]) / 2, e[0] - 1, e[-1] + 1])
