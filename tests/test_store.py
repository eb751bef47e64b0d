"""Document store: few documents are read from few buckets."""
import os

from conftest import corpus_df
from docrank import TfIdf
from docrank.operators import search as S
from docrank.session import scratch_path
from docrank.sinks.store import read_doc_store, store_bucket, write_doc_store
from pyspark.sql import functions as F

ROWS = [(f"d{i}", f"fig {'date ' * (i % 9)}text number {i}") for i in range(400)] + [("n", None), ("e", "")]


def spoil(spark, path, keep):
    """Damage the files of all buckets but ``keep``: reading one of them fails."""
    spoilt = 0
    for folder, _, files in os.walk(path.removeprefix("file:")):
        if "/texts/bucket=" in folder and int(folder.rsplit("=", 1)[1]) not in keep:
            for f in files:
                if f.endswith(".parquet"):
                    open(f"{folder}/{f}", "wb").write(b"no parquet at all")
                    spoilt += 1
    return spoilt


def test_top_k_reads_its_buckets_only(spark):
    corpus = corpus_df(spark, ROWS)
    path = write_doc_store(corpus, scratch_path(spark, "store"), buckets=32)
    m = TfIdf(corpus)
    want = S.with_text(S.search_rows(m, spark, "date", k=5), corpus).collect()
    store = read_doc_store(spark, path)
    touched = {r.b for r in corpus.where(F.col("doc_id").isin([r.doc_id for r in want])).select(store_bucket(F.col("doc_id"), 32).alias("b")).collect()}
    assert len(touched) <= 5 and spoil(spark, path, touched) > 20
    got = S.with_text(S.search_rows(m, spark, "date", k=5), store)
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in got.select(want[0].__fields__).collect()] == [tuple(r) for r in want]
    # a document of a spoilt bucket cannot be read: the test would notice
    other = next(i for i, _ in ROWS if corpus.where(F.col("doc_id") == i).select(store_bucket(F.col("doc_id"), 32)).first()[0] not in touched)
    try:
        store.lookup([other]).collect()
        raise AssertionError("read a damaged file")
    except AssertionError:
        raise
    except Exception:
        pass


def test_lookup_replace_and_empty(spark):
    path = scratch_path(spark, "store")
    write_doc_store(corpus_df(spark, ROWS), path, buckets=8)
    before = read_doc_store(spark, path)
    assert {(r.doc_id, r.text) for r in before.lookup(["d1", "n", "e", "missing"]).collect()} == {("d1", "fig date text number 1"), ("n", ""), ("e", "")}
    assert before.lookup([]).collect() == [] and before.corpus().count() == len(ROWS)
    write_doc_store(spark.createDataFrame([(7, "seven", "x")], "doc_id long, text string, lang string"), path, buckets=2)
    after = read_doc_store(spark, path)
    assert after.lookup([7]).collect()[0].lang == "x" and before.corpus().count() == len(ROWS)
    write_doc_store(corpus_df(spark, ROWS[:0]), path, buckets=2)
    assert read_doc_store(spark, path).texts.count() == 0
