"""Streaming ingest: two arrivals of corpus files give the same index as a
batch build over their union."""
from pyspark.sql import functions as F

from docrank import TfIdf
from docrank.operators import search as S
from docrank.plans import catalog as C
from docrank.session import scratch_path
from docrank.sources.index import read_index
from docrank.streaming.ingest import ingest

SF = "/root/testdata/sf0.001"


def test_stream_ingest_matches_batch(spark):
    docs = C.documents(spark, SF)
    src, idx, ckpt = (scratch_path(spark, n) for n in ("stream-src", "stream-idx", "stream-ckpt"))
    docs.where(F.col("doc_id") < 120).write.parquet(src)
    ingest(spark, src, idx, checkpoint=ckpt, buckets=8).awaitTermination(180)
    assert read_index(spark, idx).n_docs == 120
    docs.where(F.col("doc_id") >= 120).write.mode("append").parquet(src)
    ingest(spark, src, idx, checkpoint=ckpt, buckets=8).awaitTermination(180)
    streamed = read_index(spark, idx)
    assert streamed.n_docs == 200
    model = TfIdf(docs)
    for q in ("the with", "und der"):
        a = {r["doc_id"]: r["score"] for r in S.search_sum(model, spark, q).collect()}
        b = {r["doc_id"]: r["score"] for r in S.search_sum(streamed, spark, q).collect()}
        assert a == b
    df_model = {r["word"]: r["doc_frequency"] for r in model.doc_frequency.collect()}
    df_stream = {r["word"]: r["doc_frequency"] for r in streamed.vocabulary.collect()}
    assert df_model == df_stream


def test_backlog_in_several_micro_batches(spark):
    docs = C.documents(spark, SF)
    src, idx = scratch_path(spark, "stream-src2"), scratch_path(spark, "stream-idx2")
    docs.repartition(4).write.parquet(src)                       # four files
    q = ingest(spark, src, idx, buckets=8, max_files_per_trigger=1)
    q.awaitTermination(180)
    streamed = read_index(spark, idx)
    assert streamed.n_docs == 200
    assert spark.read.parquet(f"{idx}/meta").select("batch_id").distinct().count() == 4
    model = TfIdf(docs)
    a = {r["doc_id"]: r["score"] for r in S.search_sum(model, spark, "the with").collect()}
    b = {r["doc_id"]: r["score"] for r in S.search_sum(streamed, spark, "the with").collect()}
    assert a == b


def test_replayed_batch_is_idempotent(spark):
    from docrank.streaming.ingest import _append_batch
    docs = C.documents(spark, SF)
    idx = scratch_path(spark, "stream-replay")
    write = _append_batch(idx, "word_lower", "smooth", 8)
    write(docs.where(F.col("doc_id") < 100), 0)
    write(docs.where(F.col("doc_id") >= 100), 1)
    write(docs.where(F.col("doc_id") >= 100), 1)          # replay after a failure
    streamed = read_index(spark, idx)
    assert streamed.n_docs == 200
    model = TfIdf(docs)
    assert streamed.postings.count() == model.terms.count()
    df_model = {r["word"]: r["doc_frequency"] for r in model.doc_frequency.collect()}
    assert df_model == {r["word"]: r["doc_frequency"] for r in streamed.vocabulary.collect()}
