"""Counting and weighting operators on a hand-made corpus."""
import math

from pyspark.sql import functions as F

from conftest import corpus_df
from docrank import TfIdf
from docrank.functions.tokenize import NONWORD_SPLIT

ROWS = [("d1", "the cat sat on the mat"), ("d2", "The dog"), ("d3", ""), ("d4", None)]


def as_map(df, key_cols, val):
    return {tuple(r[c] for c in key_cols) if len(key_cols) > 1 else r[key_cols[0]]: r[val]
            for r in df.collect()}


def test_word_count_and_lengths(spark):
    m = TfIdf(corpus_df(spark, ROWS))
    wc = as_map(m.word_count(), ["doc_id", "word"], "frequency")
    assert wc[("d1", "the")] == 2 and wc[("d2", "the")] == 1 and wc[("d2", "dog")] == 1
    assert len(wc) == 7
    lens = as_map(m.doc_length(), ["doc_id"], "total_words")
    assert lens == {"d1": 6, "d2": 2}          # zero-token documents vanish
    assert m.corpus_size().first()["n_docs"] == 4   # ... but count in N


def test_term_frequency_sums_to_one(spark):
    m = TfIdf(corpus_df(spark, ROWS))
    sums = m.tf.groupBy("doc_id").agg(F.sum("term_frequency").alias("s")).collect()
    assert all(abs(r["s"] - 1.0) < 1e-12 for r in sums)


def test_idf_kinds(spark):
    c = corpus_df(spark, ROWS)
    smooth = as_map(TfIdf(c, idf_kind="smooth").idf, ["word"], "idf")
    raw = as_map(TfIdf(c, idf_kind="raw").idf, ["word"], "idf")
    assert math.isclose(smooth["the"], math.log(5 / 3))
    assert math.isclose(smooth["dog"], math.log(5 / 2))
    assert math.isclose(raw["the"], math.log(4 / 2))
    assert all(v >= 0 for v in smooth.values())


def test_fixed_n(spark):
    m = TfIdf(corpus_df(spark, ROWS), idf_kind="raw", n=53291)
    raw = as_map(m.idf, ["word"], "idf")
    assert math.isclose(raw["cat"], math.log(53291))


def test_tf_idf_values(spark):
    m = TfIdf(corpus_df(spark, ROWS))
    w = as_map(m.weights, ["doc_id", "word"], "tf_idf")
    assert math.isclose(w[("d1", "the")], 2 / 6 * math.log(5 / 3))
    assert math.isclose(w[("d2", "dog")], 1 / 2 * math.log(5 / 2))


def test_tf_rounding_half_up(spark):
    text = " ".join(["x"] + ["y"] * 127)           # 1/128 = 0.0078125
    m = TfIdf(corpus_df(spark, [("a", text)]), tf_decimals=6)
    tf = as_map(m.tf, ["word"], "term_frequency")
    assert tf["x"] == 0.007813


def test_split_tokenizer_counts_empty_words(spark):
    m = TfIdf(corpus_df(spark, [("a", "a--b"), ("b", "")]), tokenizer=NONWORD_SPLIT)
    wc = as_map(m.word_count(), ["doc_id", "word"], "frequency")
    assert wc == {("a", "a"): 1, ("a", ""): 1, ("a", "b"): 1, ("b", ""): 1}


def test_document_frequency_bounded_by_n(spark):
    m = TfIdf(corpus_df(spark, ROWS))
    n = m.corpus_size().first()["n_docs"]
    assert max(r["doc_frequency"] for r in m.doc_frequency.collect()) <= n


def test_multi_row_documents(spark):
    turns = spark.createDataFrame([(1, 0, "the cat"), (1, 1, "the dog"), (2, 0, "a")],
                                  "conv_id long, turn long, text string")
    from docrank.sources.corpus import conversation_corpus
    m = TfIdf(conversation_corpus(turns), multi_row=True)
    wc = as_map(m.word_count(), ["doc_id", "word"], "frequency")
    assert wc == {(1, "the"): 2, (1, "cat"): 1, (1, "dog"): 1, (2, "a"): 1}
    assert as_map(m.doc_length(), ["doc_id"], "total_words") == {1: 4, 2: 1}
    idf = as_map(m.idf, ["word"], "idf")
    assert math.isclose(idf["the"], math.log(3 / 2))   # N = 2 conversations


def test_doc_frequency_override(spark):
    m = TfIdf(corpus_df(spark, ROWS), idf_kind="raw", n=556, doc_frequency_override=1)
    w = as_map(m.weights, ["doc_id", "word"], "tf_idf")
    assert math.isclose(w[("d1", "the")], 2 / 6 * math.log(556))


def test_smooth_idf_equals_spark_ml(spark):
    from pyspark.ml.feature import IDF, CountVectorizer

    from docrank.functions.tokenize import tokens
    from docrank.plans import catalog as C
    docs = C.documents(spark, "/root/testdata/sf0.001")
    toks = docs.select(tokens("text").alias("words"))
    cv = CountVectorizer(inputCol="words", outputCol="tf", minDF=1.0, vocabSize=1 << 20).fit(toks)
    idf_model = IDF(inputCol="tf", outputCol="v").fit(cv.transform(toks))
    ml = dict(zip(cv.vocabulary, idf_model.idf.toArray()))
    ours = as_map(TfIdf(docs).idf, ["word"], "idf")
    assert ours.keys() == ml.keys()
    assert all(math.isclose(ours[w], ml[w], rel_tol=1e-12, abs_tol=1e-15) for w in ours)


def test_captured_spot_values(spark):
    """Fixed values of a captured run (N = 556, df = 1, six places)."""
    docs = [("2469_10", " ".join(["Hamlet"] + [f"w{chr(97 + i)}" for i in range(16)])),
            ("2248_7", " ".join(["A"] + ["x" * (i + 1) for i in range(127)]))]
    m = TfIdf.flavor(corpus_df(spark, docs), "captured", n=556, doc_frequency_override=1)
    got = {(r["doc_id"], r["word"]): (r["term_frequency"], r["tf_idf"]) for r in m.weights.collect()}
    assert got["2469_10", "Hamlet"] == (0.058824, 0.3718128741409963)
    assert got["2248_7", "A"] == (0.007813, 0.0493841626829798)       # 1/128, half up


def test_model_of_counts(spark, tmp_out):
    from docrank.operators import search as S
    from docrank.sinks.index import write_index
    from docrank.sources.index import read_index
    c = corpus_df(spark, [("d1", "a a b"), ("d2", "b c"), ("d3", "c")])
    plain = TfIdf(c)
    m = TfIdf.from_counts(plain.word_count())
    assert m.corpus_size().first()["n_docs"] == 3
    assert sorted(m.doc_length().collect()) == sorted(plain.doc_length().collect())
    path = tmp_out("counts-idx")
    write_index(m, path, buckets=2)
    for src in (m, read_index(spark, path)):
        assert S.search_sum(src, spark, "a c").collect() and \
            sorted(S.search_sum(src, spark, "a c").collect()) == sorted(S.search_sum(plain, spark, "a c").collect())


def test_building_a_model_runs_no_job(spark):
    rows = spark.range(1000).selectExpr("id % 100 as doc_id", "concat('w', id % 7) as text").groupBy("doc_id").agg(
        F.concat_ws(" ", F.collect_list("text")).alias("text"))
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None) or [])
    m = TfIdf(rows)
    m.idf, m.tf
    assert set(tracker.getJobIdsForGroup(None) or []) == before


def test_a_hot_document_spreads(spark, tmp_out):
    path = tmp_out("hot-doc")
    spark.range(5000).selectExpr("if(id < 4500, 'hot', concat('d', id)) as doc_id", "concat('w', id) as text").coalesce(1).write.parquet(path)
    from docrank.plans.model import balance_input
    rows = balance_input(spark.read.parquet(path), 8)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000
