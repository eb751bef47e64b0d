"""Command line: index -> search -> batch over the small tables."""
from pyspark.sql import functions as F

from docrank.cli import main
from docrank.operators import search as S
from docrank.plans import catalog as C

SF = "/root/testdata/sf0.001"


def test_index_search_batch(spark, tmp_out):
    idx, out, qs = tmp_out("cli-index"), tmp_out("cli-batch"), tmp_out("cli-q")
    main(["index", "--corpus", f"{SF}/documents.parquet", "--out", idx, "--buckets", "8"], spark)
    res = main(["search", "--index", idx, "--query", "the with", "--k", "5"], spark)
    want = S.search_sum(C.model(spark, SF), spark, "the with", k=5).collect()
    assert res.collect() == want
    rows = main(["search", "--index", idx, "--query", "the", "--rows", "--k", "2",
                 "--corpus", f"{SF}/documents.parquet"], spark).collect()
    assert len(rows) == 2 and all(r["text"] for r in rows)
    (spark.read.parquet(f"{SF}/benchmark.parquet")
     .select(F.col("item_id").alias("query_id"), "text").write.parquet(qs))
    main(["batch", "--index", idx, "--queries", qs, "--out", out, "--k", "3"], spark)
    assert spark.read.parquet(out).groupBy("query_id").count().where("count > 3").count() == 0


def test_tfidf_tsv(spark, tmp_out):
    out = tmp_out("cli-tsv")
    main(["tfidf", "--corpus", f"{SF}/documents.parquet", "--flavor", "mapreduce", "--out", out, "--tsv"], spark)
    lines = spark.read.text(out)
    assert lines.count() == C.model(spark, SF, "mapreduce").word_count().count()


def test_multi_row_index(spark, tmp_out):
    idx = tmp_out("cli-conv")
    main(["index", "--corpus", f"{SF}/conversations.parquet", "--id-col", "conv_id", "--multi-row",
          "--out", idx, "--buckets", "4"], spark)
    got = main(["search", "--index", idx, "--query", "the", "--k", "3"], spark).collect()
    from docrank import TfIdf
    from docrank.sources.corpus import conversation_corpus
    m = TfIdf(conversation_corpus(spark.read.parquet(f"{SF}/conversations.parquet")), multi_row=True)
    assert got == S.search_sum(m, spark, "the", k=3).collect()
