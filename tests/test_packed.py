"""Packed postings: the same index in fewer bytes."""
import os

import pytest
from conftest import corpus_df
from docrank import TfIdf
from docrank.operators import search as S
from docrank.session import scratch_path
from docrank.sinks.index import write_index
from docrank.sinks.packed import pack_postings, unpack_postings
from docrank.sources.corpus import from_table
from docrank.sources.index import read_index

LIMITS = [0, 1, 255, 256, 65_535, 65_536, 65_537, 1 << 24, -1, -65_536, (1 << 63) - 1, -(1 << 63)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_values_of_any_width(spark):
    posts = [(0, w, i, 1 + (n if w == "b" else 0) * 300_000, 10 + n * 70_000) for w in "abc" for n, i in enumerate(LIMITS) if w != "c" or n == 3]
    posts.append((0, "ünï\t", 5, 1 << 40, 1 << 41))
    df = spark.createDataFrame(posts, "bucket int, word string, doc_id long, frequency long, total_words long")
    back = unpack_postings(pack_postings(df), len(LIMITS), None)
    assert rows(back.select("bucket", "word", "doc_id", "frequency", "total_words")) == sorted(posts)
    assert all(r.term_frequency == r.frequency / r.total_words for r in back.collect())
    assert back.schema["doc_id"].dataType == df.schema["doc_id"].dataType
    assert unpack_postings(pack_postings(df.limit(0)), 0, None).collect() == []


def test_a_hot_word_is_many_blocks(spark):
    df = spark.range(200_000).selectExpr("0 as bucket", "'hot' as word", "cast(id as int) as doc_id", "1 + id % 3 as frequency", "100L as total_words")
    blocks = pack_postings(df)
    sizes = [(r.n, len(r.doc_id), len(r.frequency), len(r.total_words)) for r in blocks.collect()]
    assert sorted(sizes) == sorted([(65_536, 131_072, 65_536, 0)] * 3 + [(3_392, 6_784, 3_392, 0)])
    back = unpack_postings(blocks, 200_000, None)
    assert back.select("doc_id", "frequency", "total_words").exceptAll(df.select("doc_id", "frequency", "total_words")).count() == 0
    assert back.count() == 200_000


def folder_bytes(path):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(path.removeprefix("file:")) for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("flavor", ["sql", "mapreduce"])
def test_packed_index_equals_the_plain_one(spark, flavor):
    docs = spark.range(600).selectExpr("id * 3 as doc_id", "concat('fig ', repeat('date ', cast(id % 7 as int)), 'w', id % 90, ' v', id % 41) as text")
    model = TfIdf.flavor(from_table(docs), flavor)
    paths = [scratch_path(spark, n) for n in ("plain", "packed")]
    plain, packed = (read_index(spark, write_index(model, p, buckets=4, packed=i == 1)) for i, p in enumerate(paths))
    names = plain.postings.columns
    assert rows(plain.postings.select(sorted(names))) == rows(packed.postings.select(sorted(names)))
    for table in ("blocks", "vocabulary"):
        cols = sorted(getattr(plain, table).columns)
        assert rows(getattr(plain, table).select(cols)) == rows(getattr(packed, table).select(cols))
    queries = spark.createDataFrame([("q1", "fig date w3"), ("q2", "v7 none")], "query_id string, text string")
    for search in (lambda i: S.search_sum(i, spark, "date w3", i.tokenizer, "set"), lambda i: S.search_batch(i, queries, i.tokenizer, "set", k=5)):
        assert [tuple(r) for r in search(packed).collect()] == [tuple(r) for r in search(plain).collect()]


def test_packed_postings_are_smaller(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 10 + id % 13), i -> concat('w', pmod(xxhash64(id, i), 300)))) as text")
    model, sizes = TfIdf(from_table(docs)), []
    for name, packed in (("postings", False), ("packed", True)):
        index = read_index(spark, write_index(model, scratch_path(spark, name), buckets=2, packed=packed))
        sizes.append(folder_bytes(f"{index.folder}/{name}"))
    assert sizes[1] < 0.9 * sizes[0]


def test_only_blocks_of_the_words_are_read(spark):
    docs = spark.range(100).selectExpr("id as doc_id", "concat('fig w', id) as text")
    index = read_index(spark, write_index(TfIdf(from_table(docs)), scratch_path(spark, "packed"), buckets=8, packed=True))
    plan = index.terms_for(["w3"])._jdf.queryExecution().executedPlan().toString()
    assert "In(word" in plan or "EqualTo(word,w3)" in plan
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan or "PartitionFilters: [(bucket" in plan
    assert "Python" not in plan and "Exchange" not in plan


def test_ids_must_be_integers(spark):
    with pytest.raises(ValueError, match="integer"):
        write_index(TfIdf(corpus_df(spark, [("a", "fig")])), scratch_path(spark, "packed"), packed=True)
