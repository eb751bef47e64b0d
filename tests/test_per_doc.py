"""Outputs of one directory per document: written, listed and read by the tasks."""
import os

import pytest
from pyspark.sql import functions as F

from docrank.plans.catalog import QUERIES, _counts_by_document
from docrank.sinks.index import write_per_doc
from docrank.sources.index import read_captured, read_per_doc
from docrank.sources.listing import list_files, write_doc_lines

ROWS = [("a", "x", 1), ("a", "y", 2), ("b/c=d %", "", 3), ("é+ b", "w", 4), (None, "n", 5)]


def _rows(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id string, word string, frequency long")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_round_trip_of_odd_ids_in_folders(spark, tmp_out):
    for folders in (None, 4):
        path = tmp_out("per-doc")
        write_per_doc(_rows(spark), path, fmt="tsv", value_col="frequency", folders=folders)
        write_per_doc(_rows(spark), path, fmt="tsv", value_col="frequency", folders=folders)
        back = read_per_doc(spark, path)
        assert sorted(map(tuple, back.collect()), key=str) == sorted(ROWS, key=str)
        assert "FileScan text" not in _plan(back)
        assert {len(r.path.removeprefix("file:").removeprefix(path.removeprefix("file:")).strip("/").split("/"))
                for r in list_files(spark, path).collect()} == {3 if folders else 2}


def test_directories_are_those_of_the_partitioned_writer(spark, tmp_out):
    mine, theirs = tmp_out("mine"), tmp_out("theirs")
    lines = _rows(spark).select("doc_id", F.col("word").alias("line")).coalesce(1)
    write_doc_lines(lines, mine)
    lines.write.partitionBy("doc_id").text(theirs)
    names = [sorted(x for x in os.listdir(p.removeprefix("file:")) if "=" in x) for p in (mine, theirs)]
    assert names[0] == names[1]
    assert sorted(map(tuple, spark.read.text(mine).collect()), key=str) == sorted(map(tuple, spark.read.text(theirs).collect()), key=str)


def test_captured_equals_the_csv_reader(spark, tmp_path):
    (tmp_path / "d 1.txt").write_text('a\t1\r\n\n \t \n"q\t2\tmore\nalone\n\t7\rlast\t9')
    (tmp_path / "empty.txt").write_text("")
    raw = (spark.read.schema("word string, value string").option("sep", "\t").option("quote", "")
           .option("nullValue", "\u0000").option("emptyValue", "").csv(str(tmp_path)))
    want = raw.select(F.regexp_extract(F.col("_metadata.file_path"), "/([^/.]*)[.]txt", 1), "word", "value").collect()
    got = read_captured(spark, str(tmp_path), id_pattern="/([^/.]*)[.]txt", id_from="file_path").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str) and len(got) == 5
    assert got[0][0] == "d%201"


def test_large_files_come_in_chunks_of_lines(spark, tmp_path, monkeypatch):
    lines = [f"word{i}\t{i}" for i in range(2_000_000)]
    (tmp_path / "doc_id=1").mkdir()
    (tmp_path / "doc_id=1" / "x").write_text("\n".join(lines))
    back = read_per_doc(spark, str(tmp_path), id_type="bigint")
    assert back.agg(F.count("*"), F.countDistinct("word"), F.sum("frequency"), F.max("doc_id")).first() == (len(lines), len(lines), sum(range(len(lines))), 1)


def test_queries_do_not_list_documents_on_the_driver(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"the word{i} the") for i in range(30)], "doc_id long, text string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("files_corpus_tfidf", "per_doc_output", "per_doc_output_split", "read_captured"):
        df = QUERIES[name](spark, str(tmp_path))
        assert df.count() == 60
        assert not [f for f in df.inputFiles() if "doc_id=" in f], name


def test_documents_are_sorted_and_not_their_words(spark, tmp_path):
    docs = [(i, f"the word{i} the") for i in range(30)] + [(3, "again the"), (None, "no id"), (None, "none")]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    plan = _plan(_counts_by_document(spark, str(tmp_path)))
    assert plan.count("Sort [") == 1 and plan.index("Generate") < plan.index("Sort [")
    want = [(i, w, 2 if w == "the" and i is not None and t.startswith("the") else 1) for i, t in docs for w in set(t.split())]
    for name in ("per_doc_output", "per_doc_output_split"):
        got = [tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect() if r.doc_id is not None]
        assert sorted(got) == sorted(x for x in want if x[0] is not None), name


def test_grouped_rows_are_checked(spark, tmp_out):
    rows = _rows(spark, [("a", "x", 1), ("b", "y", 2), ("a", "z", 3)]).coalesce(1)
    path = tmp_out("apart")
    with pytest.raises(Exception, match="one after the other"):
        write_per_doc(rows, path, fmt="tsv", value_col="frequency", grouped=True)
    assert not os.path.exists(path.removeprefix("file:"))
    write_per_doc(rows, path, fmt="tsv", value_col="frequency")
    assert read_per_doc(spark, path).count() == 3
