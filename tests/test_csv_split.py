"""Multi-line CSV files cut at any byte give the records of the plain reader."""
import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from docrank.session import scratch_path
from docrank.sources.corpus import read_csv_corpus
from docrank.sources.csv_split import csv_records, read_split_csv

SIZE = "spark.sql.files.maxPartitionBytes"
OPEN = "spark.sql.files.openCostInBytes"


@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in (SIZE, OPEN)}

    def to(n):
        spark.conf.set(SIZE, str(n))
        spark.conf.set(OPEN, "1")
    yield to
    for k, v in old.items():
        spark.conf.set(k, v)


def write(folder, name, rows, **kw):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="", encoding="utf-8") as f:
        csv.writer(f, **kw).writerows(rows)


def local(path):
    return path.removeprefix("file:")


def random_rows(n, seed):
    r = random.Random(seed)
    odd = ['"', '""', "\n", "\n\n", ",", "\r\n", "é", "東", " ", "x" * 50, "end\n", '\n"\n', "\\"]
    return [[str(i), "".join(r.choices([*odd, "word ", "ab"], k=r.randint(0, 30)))] for i in range(n)]


@pytest.mark.parametrize("size", [64, 301, 4_000, 10**9])
def test_records_of_any_cut(spark, small_blocks, size):
    path = scratch_path(spark, "split")
    rows = {name: random_rows(60, seed) for seed, name in enumerate(("a.csv", "b.csv"))}
    for name, some in rows.items():
        write(local(path), name, [["id", "text\nof two"], *some], lineterminator="\n")
    small_blocks(size)
    got = read_split_csv(spark, path, ["id", "text"])
    if size == 64:
        assert csv_records(spark, path).rdd.getNumPartitions() > 20
    want = sorted((i, t) for some in rows.values() for i, t in some)
    assert sorted((r.id, r.text or "") for r in got.collect()) == want


def test_equal_to_the_plain_reader(spark, small_blocks):
    path = scratch_path(spark, "split-plain")
    rows = random_rows(80, 9) + [["", ""], ["x", "trailing \n"], ["long", "line\n" * 2_000]]
    write(local(path), "a.csv", [["id", "content"], *rows], lineterminator="\n")
    small_blocks(500)
    plain = read_csv_corpus(spark, path, ["id", "content"])
    split = read_csv_corpus(spark, path, ["id", "content"], split=True)
    a, b = sorted(map(tuple, split.collect()), key=str), sorted(map(tuple, plain.collect()), key=str)
    assert len(a) == len(b) and not [(x, y) for x, y in zip(a, b) if x != y]


def test_other_line_ends(spark, small_blocks):
    """Records may end with CR LF; line ends within quotes stay as they are."""
    path, rows = scratch_path(spark, "split-crlf"), random_rows(40, 3)
    write(local(path), "a.csv", [["id", "text"], *rows], lineterminator="\r\n")
    small_blocks(200)
    assert sorted((r.id, r.text or "") for r in read_split_csv(spark, path, ["id", "text"]).collect()) == sorted(map(tuple, rows))


def test_arity_header_empty_and_unclosed(spark, small_blocks):
    path = scratch_path(spark, "split-odd")
    os.makedirs(local(path))
    with open(f"{local(path)}/a.csv", "w") as f:
        f.write('1,"two\nlines"\n2,b,c\n3\n\n4,"open\n5,e\n')
    with open(f"{local(path)}/empty.csv", "w"):
        pass
    small_blocks(8)
    rows = read_split_csv(spark, path, ["a", "b"], header=False).collect()
    assert sorted(r.a for r in rows) == ["1", "2", "3", "4"]
    strict = {r.a: r.b for r in read_split_csv(spark, path, ["a", "b"], strict_arity=True, header=False).collect()}
    assert strict["1"] == "two\nlines" and "2" not in strict and "3" not in strict
    assert read_split_csv(spark, path, ["a", "b"]).where(F.col("a") == "1").count() == 0
