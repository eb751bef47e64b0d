"""Command line (use with ``spark-submit`` or plain ``python -m docrank``).

    python -m docrank index  --corpus DIR --format parquet --out INDEX [--flavor sql] [--buckets 64]
    python -m docrank search --index INDEX --query "the with" [--k 5] [--rows] [--corpus DIR]
    python -m docrank batch  --index INDEX --queries QUERIES.parquet --out DIR [--k 5]
    python -m docrank tfidf  --corpus DIR --format csv --columns id,title,content --out DIR [--tsv]

This replaces the interactive menus of the original tools: the corpus and the
query are arguments, results are printed (bounded top-k) or written.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrank.operators import search as S
from docrank.plans.model import FLAVORS, TfIdf
from docrank.sinks import index as sink
from docrank.sources import corpus as src
from docrank.sources.index import read_index


def load_corpus(spark: SparkSession, a) -> DataFrame:
    if a.format == "parquet":
        return src.read_parquet_corpus(spark, a.corpus, a.id_col, a.text_col)
    if a.format == "csv":
        cols = a.columns.split(",")
        return src.read_csv_corpus(spark, a.corpus, cols, a.id_col, a.text_col, strict_arity=a.strict_arity)
    if a.format == "lines":
        return src.read_lines_corpus(spark, a.corpus, a.n_fields, a.id_index, a.text_index,
                                     strict_arity=a.strict_arity)
    if a.format == "files":
        return src.read_files_corpus(spark, a.corpus)
    raise SystemExit(f"unknown corpus format {a.format}")


def model_of(spark: SparkSession, a) -> TfIdf:
    corpus = load_corpus(spark, a)
    kw = {"n": a.n} if a.n else {}
    if a.multi_row:
        kw["multi_row"] = True
    elif a.check_ids:
        src.check_unique_ids(corpus)
    return TfIdf.flavor(corpus, a.flavor, **kw)


def _corpus_args(p):
    p.add_argument("--corpus", required=True)
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "lines", "files"])
    p.add_argument("--id-col", default="doc_id")
    p.add_argument("--text-col", default="text")
    p.add_argument("--columns", default="", help="csv: every column name in order")
    p.add_argument("--strict-arity", action="store_true")
    p.add_argument("--n-fields", type=int, default=10)
    p.add_argument("--id-index", type=int, default=0)
    p.add_argument("--text-index", type=int, default=9)
    p.add_argument("--flavor", default="sql", choices=sorted(FLAVORS))
    p.add_argument("--n", type=float, default=None, help="fixed corpus size N")
    p.add_argument("--check-ids", action="store_true", help="fail on null or repeated ids")
    p.add_argument("--multi-row", action="store_true",
                   help="a document spans several rows with the same id (e.g. conversation turns)")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="docrank")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("index", help="build a stored index")
    _corpus_args(p)
    p.add_argument("--out", required=True)
    p.add_argument("--buckets", type=int, default=sink.DEFAULT_BUCKETS)
    p = sub.add_parser("search", help="search a stored index")
    p.add_argument("--index", required=True)
    p.add_argument("--query", required=True)
    p.add_argument("--k", type=int, default=5)
    p.add_argument("--weighting", default="set", choices=["set", "bag"])
    p.add_argument("--rows", action="store_true", help="rank (document, word) rows instead of sums")
    p.add_argument("--corpus", default=None, help="parquet corpus to attach texts from")
    p = sub.add_parser("batch", help="top-k search for a table of queries (query_id, text)")
    p.add_argument("--index", required=True)
    p.add_argument("--queries", required=True)
    p.add_argument("--k", type=int, default=5)
    p.add_argument("--weighting", default="set", choices=["set", "bag"])
    p.add_argument("--out", required=True)
    p = sub.add_parser("tfidf", help="write the full tf-idf table")
    _corpus_args(p)
    p.add_argument("--out", required=True)
    p.add_argument("--tsv", action="store_true", help="legacy word-doc<TAB>value text")
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame | None:
    a = parser().parse_args(argv)
    spark = spark or (SparkSession.builder.appName("docrank")
                      .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate())
    if a.cmd == "index":
        sink.write_index(model_of(spark, a), a.out, buckets=a.buckets)
        return None
    if a.cmd == "tfidf":
        w = model_of(spark, a).weights.select("doc_id", "word", "tf_idf")
        if a.tsv:
            sink.write_tsv(w, a.out)
        else:
            w.write.mode("overwrite").parquet(a.out)
        return None
    idx = read_index(spark, a.index)
    if a.cmd == "search":
        if a.rows:
            res = S.search_rows(idx, spark, a.query, idx.tokenizer, k=a.k)
        else:
            res = S.search_sum(idx, spark, a.query, idx.tokenizer, a.weighting, k=a.k)
        if a.corpus:
            res = S.with_text(res, src.read_parquet_corpus(spark, a.corpus))
        res.show(a.k, truncate=80)
        return res
    if a.cmd == "batch":
        q = spark.read.parquet(a.queries).select(F.col("query_id"), F.col("text"))
        res = S.search_batch(idx, q, idx.tokenizer, a.weighting, k=a.k)
        res.write.mode("overwrite").parquet(a.out)
        return res
    return None
