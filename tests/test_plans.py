"""Plan-shape checks: the properties the design relies on at scale."""
import os

import pytest

from docrank import TfIdf
from docrank.operators import search as S
from docrank.plans import catalog as C
from docrank.plans.inspect import count_nodes, exchanges, plan_string, uses_python

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return C.documents(spark, SF)


def test_counting_needs_no_shuffle(spark, docs):
    m = TfIdf(docs, balance=False)
    for df in (m.terms, m.word_count(), m.doc_length(), m.tf):
        assert exchanges(df) == []


def test_balance_only_when_scan_is_narrow(spark, docs):
    narrow = TfIdf(docs)                        # one parquet row group -> spread
    assert any("REPARTITION_BY_NUM" in e for e in exchanges(narrow.terms))
    wide = TfIdf(docs.repartition(64), balance=True)
    assert not any("hashpartitioning(doc_id" in e for e in exchanges(wide.terms))


def test_corpus_scan_reads_two_columns(spark, docs):
    text = plan_string(TfIdf(docs).terms)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_document_frequency_partial_aggregate(spark, docs):
    text = plan_string(TfIdf(docs, balance=False).doc_frequency, "simple")
    assert "partial_count" in text
    assert text.index("partial_count") > text.index("Exchange hashpartitioning(word")


def test_tfidf_reads_the_counted_rows_and_no_text(spark, docs):
    text = plan_string(TfIdf(docs).weights, "simple")
    # both branches read the rows counted once; the text is not tokenized again
    assert "text#" not in text and "regexp_extract_all" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top_k_is_take_ordered(spark, docs):
    df = S.search_sum(TfIdf(docs), spark, "the with", k=5)
    assert count_nodes(df, "TakeOrderedAndProject") == 1


def test_batch_top_k_limits_before_shuffle(spark, docs):
    df = S.search_batch(TfIdf(docs), C.benchmark_queries(spark, SF), k=5)
    assert count_nodes(df, "WindowGroupLimit") >= 3     # seeds, threshold, result


def test_index_search_prunes(spark, docs):
    from docrank.session import scratch_path
    from docrank.sinks.index import write_index
    from docrank.sources.index import read_index
    path = scratch_path(spark, "plan-index")
    write_index(TfIdf(docs), path, buckets=8)
    idx = read_index(spark, path)
    text = plan_string(S.search_sum(idx, spark, "the with", k=5))
    assert "PartitionFilters: [isnotnull(bucket" in text or "PartitionFilters: [bucket" in text
    assert "In(word, [the,with])" in text
    few = spark.createDataFrame([("the",), ("with",)], "word string")
    batch = plan_string(idx.terms_for(few))
    assert "PartitionFilters: [isnotnull(bucket" in batch or "PartitionFilters: [bucket" in batch


def test_text_fetch_shuffles_no_text(spark, docs):
    m = TfIdf(docs)
    rows = S.search_rows(m, spark, "the", k=2)
    text = plan_string(S.with_text(rows, m.raw_corpus), "simple")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("name", sorted(C.QUERIES))
def test_no_python_in_any_registered_query(spark, name):
    if name in ("csv_corpus_split_multiline", "files_corpus_size", "files_corpus_lengths",
                "container_corpus", "per_doc_container"):
        pytest.skip("reads byte ranges, single files or containers in Arrow batches")
    assert not uses_python(C.QUERIES[name](spark, SF))


def test_many_file_corpus_needs_no_balancing_and_matches(spark, tmp_out):
    """A corpus stored as many files (how a large corpus arrives) is read
    without the balancing exchange; results equal the single-file corpus."""
    from docrank.sources.corpus import read_parquet_corpus
    path = tmp_out("many-files")
    spark.read.parquet(f"{SF}/documents.parquet").repartition(32).write.parquet(path)
    wide = read_parquet_corpus(spark, path)
    m = TfIdf(wide)
    assert m.corpus is m.raw_corpus                       # not rebalanced
    assert exchanges(m.terms) == []
    a = {(r["doc_id"], r["word"]): r["tf_idf"] for r in m.weights.collect()}
    b = {(r["doc_id"], r["word"]): r["tf_idf"] for r in TfIdf(C.documents(spark, SF)).weights.collect()}
    assert a == b


def test_large_few_file_corpus_needs_no_balancing(spark, tmp_out):
    """Two files of more bytes than a split per core are cut by Spark itself."""
    from docrank.sources.corpus import read_parquet_corpus
    path = tmp_out("few-files")
    spark.read.parquet(f"{SF}/documents.parquet").repartition(2).write.parquet(path)
    assert exchanges(TfIdf(read_parquet_corpus(spark, path)).corpus) != []
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert exchanges(TfIdf(read_parquet_corpus(spark, path)).corpus) == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_scratch_is_removed(tmp_path):
    """A process leaves no scratch folder, and a session can clear its own."""
    import subprocess
    import sys
    code = f"""
import os, sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from docrank.session import local_session, clear_scratch
from docrank.plans import catalog as C
spark = local_session(2, 2, "1g", {{"spark.checkpoint.dir": {str(tmp_path / "ckpt")!r}}})
left = lambda: [f for d, _, fs in os.walk({str(tmp_path / "ckpt")!r}) for f in fs if "docrank-" in d]
assert C.QUERIES["tfidf_sql"](spark, {SF!r}).count() and left()
assert clear_scratch(spark) >= 1 and not left()
assert C.QUERIES["tfidf_sql"](spark, {SF!r}).count() and left()
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [d for d, _, _ in os.walk(tmp_path) if "docrank-" in d] == []


def test_adhoc_search_reads_the_corpus_text_once(spark, docs):
    """The query-word rows are checkpointed (one pass over the corpus); the
    search plan itself scans no text."""
    df = S.search_sum(TfIdf(docs), spark, "the with", k=5)
    text = plan_string(df, "simple")
    assert "ExistingRDD" in text
    assert "text#" not in text
