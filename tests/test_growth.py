"""Steps whose cost must grow no faster than their input."""
import time

from pyspark.sql import functions as F

from docrank.operators import search as S
from docrank.operators import weights as W
from docrank.plans.catalog import QUERIES
from docrank.plans.model import TfIdf, in_few_parts
from docrank.sinks.packed import pack_postings, unpack_postings


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unpacking_is_linear_in_the_block(spark):
    """One word in 65,536 documents: a copy of the block for each posting took minutes."""
    rows = spark.range(65_536).select(F.lit(0).alias("bucket"), F.lit("w").alias("word"), F.col("id").alias("doc_id"),
                                      (F.col("id") % 7 + 1).alias("frequency"), (F.col("id") * 1000 + 9).alias("total_words"))
    path_free = pack_postings(rows.coalesce(1)).cache()
    assert path_free.count() == 1
    began = time.time()
    got = unpack_postings(path_free, 65_536, None).agg(F.count("*"), F.sum("doc_id"), F.sum("frequency"), F.sum("total_words")).first()
    assert time.time() - began < 15
    assert got == rows.agg(F.count("*"), F.sum("doc_id"), F.sum("frequency"), F.sum("total_words")).first()
    path_free.unpersist()


def test_posting_list_shuffles_no_lists_and_no_unused_columns(spark):
    tf = TfIdf(spark.createDataFrame([(i, f"common w{i % 5}") for i in range(50)], "doc_id long, text string"), balance=False).tf
    p = S.posting_list(tf.select("word", "doc_id", "frequency"), block_size=8)
    assert p.columns == ["word", "block", "doc_ids", "frequencies"]
    exchanges = _plan(p).count("Exchange hashpartitioning(word")
    lists = _plan(p)
    assert exchanges == 1 and lists.index("ObjectHashAggregate") < lists.index("Exchange hashpartitioning(word")
    assert "partial_collect_list" not in lists[lists.index("Exchange hashpartitioning(word"):]
    full = S.posting_list(tf, block_size=8)
    assert full.columns[-1] == "term_frequencies" and p.collect() and full.count() == p.count()


def test_hash_blocks_of_rare_words(spark):
    rows = [(f"d{i}", "common " + ("rare" if i < 3 else f"w{i}")) for i in range(40)]
    tf = TfIdf(spark.createDataFrame(rows, "doc_id string, text string"), balance=False).tf
    got = S.posting_list(tf, block_size=8)
    assert {r.block for r in got.where("word = 'rare'").collect()} == {0}
    common = got.where("word = 'common'").collect()
    assert len(common) == 5 and sorted(x for r in common for x in r.doc_ids) == sorted(f"d{i}" for i in range(40))


def test_rows_of_a_document_are_counted_in_one_row(spark):
    long_id = "x" * 500
    rows = [(long_id, "a b a"), (long_id, "b c"), ("s", "a"), ("s", None), (None, "n n"), ("e", "--")] + [("hot", "h i h")] * 40
    c = spark.createDataFrame(rows, "doc_id string, text string").withColumn("text", F.coalesce("text", F.lit("")))
    want = {(long_id, "a", 2), (long_id, "b", 2), (long_id, "c", 1), ("s", "a", 1), ("hot", "h", 80), ("hot", "i", 40)}
    for limit in (10, 2_000_000):
        m = TfIdf(c, multi_row=True, balance=False, max_rows_per_key=limit)
        assert set(map(tuple, m.word_count().collect())) == want
        assert set(map(tuple, W.multi_row_counts(c, max_rows=limit).collect())) == want | {(None, "n", 2)}
        assert {(r.doc_id, r.word, r.frequency) for r in m.terms.collect()} == want
    lists = _plan(m.word_count())      # by id alone, and no join with totals
    assert "SortMergeJoin" not in lists and "ShuffledHashJoin" not in lists
    assert "Exchange hashpartitioning(doc_id#" in lists and "partial_collect_list" not in lists[lists.rindex("REPARTITION_BY_COL"):]


def test_csv_corpus_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f'line "{i}"\nnext, {i}', "en", "s", 9) for i in range(400)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    raw = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert in_few_parts(raw, 256 << 20).rdd.getNumPartitions() == 1
    monkeypatch.setattr("docrank.plans.catalog.CSV_FILE_BYTES", 4 << 10)
    got = QUERIES["csv_corpus_split_multiline"](spark, str(tmp_path))
    assert len({f for f in got.inputFiles()}) > 1
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.select("doc_id", "text").collect()))


def test_blocks_of_a_stored_index_take_one_shuffle_in_bounded_parts(spark, tmp_out, monkeypatch):
    from docrank.operators.blocks import blocks_of
    from docrank.sinks import index as sink
    from docrank.sources.index import read_index
    monkeypatch.setattr(sink, "PART_ROWS", 20)
    c = spark.createDataFrame([(i, f"common w{i % 5} v{i}") for i in range(60)], "doc_id long, text string")
    for packed in (False, True):
        idx = read_index(spark, sink.write_index(TfIdf(c), tmp_out("parts"), buckets=2, packed=packed))
        assert sink.n_stored(spark, idx.folder, packed) == 180
        dealt = sink.dealt_blocks(idx.postings, 2, 180)
        assert _plan(dealt).count("Exchange hashpartitioning") == 1 and dealt.rdd.getNumPartitions() == 10
        want = sorted(map(tuple, blocks_of(idx.postings, "bucket").select("word", "range", "max_tf", "n_postings").collect()))
        assert sorted(map(tuple, idx.blocks.select("word", "range", "max_tf", "n_postings").collect())) == want


def test_blocks_are_dealt_from_small_splits(spark, tmp_out, monkeypatch):
    """A task that deals postings held all rows of a split of 128 MB of several files."""
    from docrank.sinks import index as sink
    c = spark.createDataFrame([(i, f"common w{i % 5} v{i}") for i in range(200)], "doc_id long, text string")
    read, asked = [], []
    plain, blocks = sink.stored_postings, sink.write_blocks

    def seen(stored, *rest):
        read.append(stored.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
        asked.append((stored.rdd.getNumPartitions(), len(stored.inputFiles())))
        assert stored.sparkSession.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
        return blocks(stored, *rest)

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(sink, "write_blocks", seen)
    monkeypatch.setattr(sink, "SPLIT_BYTES", 1 << 10)
    path = sink.write_index(TfIdf(c), tmp_out("splits"), buckets=16)
    assert read == ["1024"] and asked[0][0] >= asked[0][1] == 16
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert plain(spark, sink.versions.resolve(spark, path)).count() == 600


def test_sql_text_tfidf_shuffles_documents_not_words(spark, tmp_path):
    import math
    rows = [(1, "a b a"), (1, "a"), (2, "b"), (3, None), (None, "a c"), (None, "c")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    df = QUERIES["sql_text_tfidf"](spark, str(tmp_path))
    assert "hashpartitioning(doc_id" in _plan(df) and ", word#" not in "".join(
        line.split("hashpartitioning(")[1].split("ENSURE")[0] for line in _plan(df).splitlines() if "hashpartitioning(doc_id" in line)
    idf = {w: math.log(7 / (n + 1)) for w, n in (("a", 2), ("b", 2))}
    want = [(1, "a", 3 / 3 * idf["a"]), (1, "a", 3 / 1 * idf["a"]), (1, "b", 1 / 3 * idf["b"]), (1, "b", 1 / 1 * idf["b"]), (2, "b", idf["b"])]
    assert sorted((r.doc_id, r.word, round(r.tf_idf, 9)) for r in df.collect()) == sorted((d, w, round(x, 9)) for d, w, x in want)
