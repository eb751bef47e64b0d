"""Property tests: Spark operators against brute-force Python on random
corpora (hypothesis generates the texts; one Spark job per example)."""
import math
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import corpus_df
from docrank import TfIdf
from docrank.functions.tokenize import ALPHA, NONWORD_SPLIT, WORD_LOWER, tokens
from docrank.operators import search as S

ALPHABET = "abcAB Z09_-.,;:'\"\n\té" + "ü"
texts = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=12)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def py_tokens(t, mode):
    if mode == WORD_LOWER:
        return re.findall(r"[A-Za-z0-9_]+", t.lower())
    if mode == ALPHA:
        return re.findall(r"[a-zA-Z]+", t)
    if t == "":
        return [""]
    parts = re.split(r"[^A-Za-z0-9_]", t)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@SETTINGS
@given(texts)
def test_tokenizers_match_python(spark, ts):
    df = spark.createDataFrame([(t,) for t in ts], "t string")
    got = df.select("t", *[tokens("t", m).alias(m) for m in (WORD_LOWER, NONWORD_SPLIT, ALPHA)]).collect()
    for r in got:
        for m in (WORD_LOWER, NONWORD_SPLIT, ALPHA):
            assert list(r[m]) == py_tokens(r["t"], m), (r["t"], m)


def brute_tfidf(docs, mode, kind):
    n = len(docs)
    counts = {d: Counter(py_tokens(t, mode)) for d, t in docs}
    df = Counter(w for c in counts.values() for w in c)
    out = {}
    for d, c in counts.items():
        total = sum(c.values())
        for w, f in c.items():
            idf = math.log((n + 1) / (df[w] + 1)) if kind == "smooth" else math.log(n / df[w])
            out[(d, w)] = f / total * idf
    return out


@SETTINGS
@given(texts, st.sampled_from([WORD_LOWER, NONWORD_SPLIT, ALPHA]), st.sampled_from(["smooth", "raw"]))
def test_tfidf_matches_brute_force(spark, ts, mode, kind):
    docs = [(f"d{i}", t) for i, t in enumerate(ts)]
    m = TfIdf(corpus_df(spark, docs), tokenizer=mode, idf_kind=kind)
    got = {(r["doc_id"], r["word"]): r["tf_idf"] for r in m.weights.collect()}
    want = brute_tfidf(docs, mode, kind)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-15) for k in want)


@SETTINGS
@given(texts, st.lists(st.sampled_from(["a", "b", "ab", "AB", "c", "zz", "09"]), min_size=1, max_size=4))
def test_search_sum_matches_brute_force(spark, ts, qwords):
    docs = [(f"d{i}", t) for i, t in enumerate(ts)]
    m = TfIdf(corpus_df(spark, docs))
    query = " ".join(qwords)
    want_w = brute_tfidf(docs, WORD_LOWER, "smooth")
    qset = {w.lower() for w in qwords}
    want = Counter()
    for (d, w), v in want_w.items():
        if w in qset:
            want[d] += v
    got = {r["doc_id"]: r["score"] for r in S.search_sum(m, spark, query).collect()}
    assert got.keys() == set(want)
    assert all(abs(got[d] - want[d]) <= 1e-8 for d in want)
