"""Hot keys: one word in every document must not land in one task, and
salting must not change results."""
import math

from pyspark.sql import functions as F

from docrank import TfIdf
from docrank.operators import weights as W
from docrank.operators.joins import salt_counts, skew_safe_join
from docrank.plans import catalog as C

SF = "/root/testdata/sf0.001"


def test_salted_join_equals_plain_join_and_spreads_hot_key(spark):
    facts = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("word"),
        F.col("id").alias("doc_id"))
    dim = facts.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.lit(1.5).alias("v"))
    hot = salt_counts(dim, "word", "n", max_rows=200).collect()
    assert [(r["word"], r["_n_salt"]) for r in hot] == [("hot", 20)]
    salted = skew_safe_join(facts, dim, "word", spread="doc_id", rows_per_key="n", max_rows=200)
    plain = facts.join(dim, "word")
    assert sorted(salted.select("word", "doc_id", "n").collect()) == sorted(plain.select("word", "doc_id", "n").collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = (salted.where(F.col("word") == "hot").select(F.spark_partition_id().alias("p"))
                 .distinct().count())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts >= 4          # 20 salts over 8 shuffle partitions


def test_dim_with_several_rows_per_key(spark):
    facts = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 99)], "word string, doc_id long")
    terms = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "word string, query_id long")
    hot = spark.createDataFrame([("a", 4)], "word string, _n_salt int")
    out = skew_safe_join(facts, terms, "word", spread="doc_id", hot=hot)
    assert out.count() == 50 * 2 + 1


def test_tfidf_with_hot_word_salted_equals_unsalted(spark):
    docs = C.documents(spark, SF)
    hot = docs.select("doc_id", F.concat(F.lit("hot "), F.col("text")).alias("text"))
    m = TfIdf(hot)
    a = {(r["doc_id"], r["word"]): r["tf_idf"] for r in W.tf_idf(m.tf, m.idf, max_rows=10).collect()}
    b = {(r["doc_id"], r["word"]): r["tf_idf"] for r in W.tf_idf(m.tf, m.idf, max_rows=10**12).collect()}
    assert a.keys() == b.keys()
    assert all(math.isclose(a[k], b[k]) for k in a)
    assert ("0", "hot") not in a and any(w == "hot" for _, w in a)


def _rows(df, cols, value):
    return {tuple(r[c] for c in cols): r[value] for r in df.collect()}


def test_every_salted_path_with_tiny_threshold(spark):
    """max_rows_per_key=3 salts nearly every word; results must not change."""
    from docrank.operators import search as S
    from docrank.session import scratch_path
    from docrank.sinks.index import write_index
    from docrank.sources.corpus import conversation_corpus
    from docrank.sources.index import read_index
    docs = C.documents(spark, SF)
    plain, salted = TfIdf(docs), TfIdf(docs, max_rows_per_key=3)
    a = _rows(plain.weights, ["doc_id", "word"], "tf_idf")
    b = _rows(salted.weights, ["doc_id", "word"], "tf_idf")
    assert a.keys() == b.keys() and all(math.isclose(a[k], b[k]) for k in a)

    queries = C.benchmark_queries(spark, SF)
    want = sorted(S.search_batch(plain, queries, k=5).collect())
    assert sorted(S.search_batch(salted, queries, k=5).collect()) == want
    path = scratch_path(spark, "skew-index")
    write_index(plain, path, buckets=8)
    idx = read_index(spark, path, max_rows_per_key=3)
    assert sorted(S.search_batch(idx, queries, k=5).collect()) == want
    i = _rows(idx.weights(), ["doc_id", "word"], "tf_idf")
    assert i.keys() == a.keys() and all(math.isclose(a[k], i[k]) for k in a)

    conv = conversation_corpus(spark.read.parquet(f"{SF}/conversations.parquet"))
    c1 = _rows(TfIdf(conv, multi_row=True).weights, ["doc_id", "word"], "tf_idf")
    c2 = _rows(TfIdf(conv, multi_row=True, max_rows_per_key=3).weights, ["doc_id", "word"], "tf_idf")
    assert c1.keys() == c2.keys() and all(math.isclose(c1[k], c2[k]) for k in c1)

    counts = plain.word_count()
    f1 = _rows(TfIdf.from_counts(counts).tf, ["doc_id", "word"], "term_frequency")
    f2 = _rows(TfIdf.from_counts(counts, max_rows_per_key=3).tf, ["doc_id", "word"], "term_frequency")
    assert f1 == f2
