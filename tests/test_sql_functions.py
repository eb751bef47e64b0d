"""Functions of SQL text, and the sorted dictionary of an index."""
import math
import os

from conftest import corpus_df
from docrank import TfIdf
from docrank.functions.sql import register
from docrank.functions.tokenize import MODES, query_tokens, tokens
from docrank.operators import search as S
from docrank.plans.inspect import uses_python
from docrank.session import scratch_path
from docrank.sinks.index import write_index
from docrank.sources.index import read_index
from pyspark.sql import functions as F

TEXTS = ["a b", "a--b", "-a b-", "", "--", "Café naïve 'x'", None, "A_1 the\nThe", "\\w r'x'"]
ROWS = [(f"d{i}", " ".join(f"{c}{j}" for c in "abcxyz" for j in range(i % 9 + 1))) for i in range(30)]


def test_functions_equal_the_column_functions(spark):
    names = register(spark, n=53291)
    assert "idf_of" in names and register(spark)          # again: replaces
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for mode in MODES:
        got = spark.sql(f"SELECT tokens_{mode}(text) AS t FROM {{df}}", df=df)
        assert not uses_python(got) and [r.t for r in got.collect()] == [r.t for r in df.select(tokens("text", mode).alias("t")).collect()]
    assert ([r.t for r in spark.sql("SELECT query_terms(text) AS t FROM {df}", df=df).collect()]
            == [r.t for r in df.select(query_tokens("text").alias("t")).collect()])
    row = spark.sql("SELECT idf(10, 3) AS a, idf_raw(10, 3) AS b, idf_of(100) AS c, idf(10, NULL) AS d").first()
    assert (row.a, row.b, row.d) == (math.log(11 / 4), math.log(10 / 3), None) and math.isclose(row.c, math.log(53292 / 101))


def test_dictionary_files_by_word_order(spark):
    m = TfIdf(corpus_df(spark, ROWS))
    path = write_index(m, scratch_path(spark, "dictionary"), buckets=4, dictionary_files=6)
    index = read_index(spark, path)
    assert len(index.fences) > 3
    ends = [(f.first_word, f.last_word) for f in index.fences]
    assert all(a <= b for a, b in ends) and all(b < c for (_, b), (c, _) in zip(ends, ends[1:]))
    words = sorted(r.word for r in m.doc_frequency.collect())
    want = [tuple(r) for r in S.vocabulary_desc(m, k=7).collect()]
    # only the last files are read: the others are damaged
    for f in index.fences[:-2]:
        os.remove(f.file.removeprefix("file:").replace("//", "/"))
    assert [tuple(r) for r in S.vocabulary_desc(index, k=7).collect()] == want
    last = index.fences[-1].last_word
    assert [r.word for r in index.words_with_prefix(last).collect()] == [last] and last == words[-1]


def test_words_with_prefix(spark):
    m = TfIdf(corpus_df(spark, [("a", "in inn into on é éa 東京 i"), ("b", "in indeed"), ("c", "")]))
    index = read_index(spark, write_index(m, scratch_path(spark, "prefix"), buckets=2, dictionary_files=3))
    for prefix in ("in", "i", "", "zz", "inn"):
        got = {(r.word, r.doc_frequency) for r in index.words_with_prefix(prefix).collect()}
        assert got == {(r.word, r.doc_frequency) for r in m.doc_frequency.where(F.col("word").startswith(prefix)).collect()}
    empty = read_index(spark, write_index(TfIdf(corpus_df(spark, [("a", "x")])), scratch_path(spark, "prefix"), buckets=2))
    assert empty.words_with_prefix("y").collect() == [] and [r.word for r in empty.largest_words(5).collect()] == ["x"]
