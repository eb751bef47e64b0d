"""What the build of a stored index keeps on disk besides the index."""
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docrank import session
from docrank.plans.catalog import QUERIES
from docrank.plans.model import TfIdf
from docrank.sinks import index as sink
from docrank.sources.index import read_index

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_dir(spark, tmp_path):
    """Some ids repeat, one is null, some texts are empty or null."""
    rows = [(i % 90, f"The common w{i % 7} v{i} with With the {'x ' * (i % 5)}", "en", "s", 9) for i in range(100)]
    rows += [(None, "the null id", "en", "s", 9), (200, "", "en", "s", 0), (201, None, "en", "s", 0)]
    spark.createDataFrame(rows, SCHEMA).repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def corpus(spark, docs_dir):
    return spark.read.parquet(f"{docs_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_")}


def left_over(spark, before, few, seconds=10):
    """Bytes of the shuffle files that came since ``before`` and stay (they are removed in the
    background; those of sums of one row may stay)."""
    end = time.time() + seconds
    while (found := sum(size for f, size in shuffle_files(spark).items() if f not in before)) > few and time.time() < end:
        time.sleep(0.2)
    return found


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def in_rounds(monkeypatch):
    monkeypatch.setattr(sink, "ROUND_BYTES", 1)
    monkeypatch.setattr(sink, "BLOCK_ROUND_ROWS", 50)


def test_stage_text_of_counts_is_stored_compressed(spark, docs_dir, tmp_path):
    # the text of an id is read back as a number, which a null id has none of
    (spark.read.parquet(f"{docs_dir}/documents.parquet").where("doc_id IS NOT NULL")
     .write.parquet(f"{tmp_path}/with-ids/documents.parquet"))
    before = set(session._scratch)
    got = QUERIES["counts_index_search"](spark, f"{tmp_path}/with-ids").collect()
    assert got
    stage = next(p for p in set(session._scratch) - before if "stage1" in p)
    text = spark.read.text(stage).agg(F.sum(F.length("value") + 1)).first()[0]
    held = sum(f.stat().st_size for f in Path(stage.removeprefix("file:")).rglob("part-*"))
    assert held < text / 2


def test_terms_of_counts_are_made_once_and_removed(spark, docs_dir, tmp_out, monkeypatch):
    counts = TfIdf(corpus(spark, docs_dir)).word_count()
    want = read_index(spark, sink.write_index(TfIdf.from_counts(counts), tmp_out("one"), buckets=4))
    in_rounds(monkeypatch)
    before = set(session._scratch)
    got = read_index(spark, sink.write_index(TfIdf.from_counts(counts), tmp_out("many"), buckets=4))
    assert not [p for p in set(session._scratch) - before if "terms" in p]
    for part in ("postings", "blocks", "vocabulary"):
        assert rows_of(getattr(got, part)) == rows_of(getattr(want, part))


def test_shuffle_files_of_a_build_go_before_the_next(spark, docs_dir, monkeypatch):
    before, left, meta = shuffle_files(spark), [], sink.write_meta

    def seen(*args):
        left.append(left_over(spark, before, 1000))
        return meta(*args)

    monkeypatch.setattr(sink, "write_meta", seen)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_before = spark.conf.get(key, None)
    found = QUERIES["index_versions_search"](spark, docs_dir)
    assert len(left) == 2 and max(left) <= 1000
    assert spark.conf.get(key, None) == set_before
    assert {r.version for r in found.collect()} == {"before", "after"}


@pytest.mark.parametrize("flavor", ["sql", "mapreduce"])
def test_an_index_built_in_rounds_is_the_same(spark, docs_dir, tmp_out, monkeypatch, flavor):
    model = TfIdf.flavor(corpus(spark, docs_dir), flavor)
    want = read_index(spark, sink.write_index(model, tmp_out("one"), buckets=4))
    in_rounds(monkeypatch)
    got = read_index(spark, sink.write_index(model, tmp_out("many"), buckets=4))
    for part in ("postings", "blocks", "vocabulary"):
        assert rows_of(getattr(got, part)) == rows_of(getattr(want, part))
    columns = ["word", "doc_id", "frequency", "total_words", "term_frequency"]
    assert rows_of(got.postings.select(columns)) == rows_of(model.tf.select(columns))
    assert len(got.postings.inputFiles()) > len(want.postings.inputFiles())       # a file for each round
    assert got.words_with_prefix("v").count() == 100


def test_what_follows_from_a_posting_is_not_stored(spark, docs_dir, monkeypatch):
    before = set(session._scratch)
    assert QUERIES["overwrite_index_search"](spark, docs_dir).count()
    path = next(p for p in set(session._scratch) - before if "index" in p)
    for folder in Path(path.removeprefix("file:"), "versions").iterdir():
        stored = spark.read.parquet(f"{folder}/postings")
        assert sorted(stored.columns) == ["bucket", "doc_id", "frequency", "range", "total_words", "word"]
        read = sink.stored_postings(spark, str(folder))
        assert "term_frequency" in read.columns and read.count() == stored.count()


def test_rows_that_may_change_take_one_round(spark, docs_dir, monkeypatch):
    in_rounds(monkeypatch)
    c = corpus(spark, docs_dir)
    assert sink.n_rounds(TfIdf(c).terms) == sink.ROUNDS
    assert sink.n_rounds(TfIdf(c.withColumn("doc_id", F.expr("uuid()"))).terms) == 1
    made = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert sink.n_rounds(TfIdf(made).terms) == 1          # no size is known
