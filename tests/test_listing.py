"""Corpora of one file per document on the executors: deep folders, empty files, odd texts."""
import os

from conftest import corpus_df
from docrank.session import scratch_path
from docrank.sources.corpus import read_files_corpus
from docrank.sources.listing import list_files, read_file_texts, write_file_texts

ROWS = [(f"d{i}", f"text {i}\nof two lines, é東\n") for i in range(40)] + [("none", None), ("empty", ""), ("blank", " \n")]


def test_round_trip_with_empty_files(spark):
    path = scratch_path(spark, "one-each")
    docs = corpus_df(spark, ROWS)
    write_file_texts(docs, path, folders=8)
    write_file_texts(docs, path, folders=8)          # a repeated attempt changes nothing
    files = list_files(spark, path)
    assert files.count() == len(ROWS) and files.where("length = 0").count() == 2
    assert {(r.doc_id, r.text) for r in read_file_texts(files).collect()} == {(i, t or "") for i, t in ROWS}


def test_listing_equals_the_reader_s_and_goes_deep(spark):
    path = scratch_path(spark, "deep")
    root = path.removeprefix("file:")
    for i, folder in enumerate(("", "a", "a/b", "a/b/c d", "e=1/f")):
        os.makedirs(f"{root}/{folder}", exist_ok=True)
        for j in range(3):
            with open(f"{root}/{folder}/x{i}_{j}.txt", "w") as f:
                f.write("" if j == 2 else f"text {i} {j}")
    os.makedirs(f"{root}/nothing")
    os.makedirs(f"{root}/_hidden")
    open(f"{root}/_hidden/x9.txt", "w").close()
    open(f"{root}/.x8.txt", "w").close()
    files = list_files(spark, path)
    assert sorted(r.path.rsplit("/", 1)[1] for r in files.collect()) == sorted(f"x{i}_{j}.txt" for i in range(5) for j in range(3))
    got = sorted(map(tuple, read_file_texts(files).collect()))
    assert [t for _, t in got] == [f"text {i} {j}" if j < 2 else "" for i in range(5) for j in range(3)]
    one = scratch_path(spark, "flat")
    write_file_texts(corpus_df(spark, ROWS), one, folders=1)
    flat = read_files_corpus(spark, f"{one}/0")
    assert sorted(map(tuple, flat.collect())) == sorted(map(tuple, read_file_texts(list_files(spark, one)).collect()))


def test_empty_folder(spark):
    path = scratch_path(spark, "no-files")
    os.makedirs(path.removeprefix("file:"))
    files = list_files(spark, path)
    assert files.count() == 0 and read_file_texts(files).count() == 0
