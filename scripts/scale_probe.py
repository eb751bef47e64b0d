"""Scaling check: time core operators on the sf0.1 documents and on copies of
them replicated ``R`` times with fresh ids (written once to a scratch folder).

    python scripts/scale_probe.py [R=10]

Prints one JSON line per scale.  Not part of the registered queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

from pyspark.sql import functions as F  # noqa: E402

from docrank import TfIdf  # noqa: E402
from docrank.operators import search as S  # noqa: E402
from docrank.session import local_session, scratch_path  # noqa: E402
from docrank.sinks.index import write_index  # noqa: E402
from docrank.sources.corpus import read_parquet_corpus  # noqa: E402
from docrank.sources.index import read_index  # noqa: E402

SF = "/root/testdata/sf0.1"


def timed(fn):
    t = time.time()
    fn()
    return round(time.time() - t, 2)


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def measure(spark, path, queries):
    docs = read_parquet_corpus(spark, path)
    m = TfIdf(docs)
    out = {"docs": docs.count()}
    out["word_count"] = timed(lambda: noop(m.word_count()))
    out["tfidf"] = timed(lambda: noop(m.weights))
    out["search_top5"] = timed(lambda: noop(S.search_sum(m, spark, "the with", k=5)))
    out["batch_top5"] = timed(lambda: noop(S.search_batch(m, queries, k=5)))
    idx = scratch_path(spark, "scale-index")
    out["index_build"] = timed(lambda: write_index(m, idx, buckets=32))
    index = read_index(spark, idx)
    out["index_search_top5"] = timed(lambda: noop(S.search_sum(index, spark, "the with", k=5)))
    out["index_batch_top5"] = timed(lambda: noop(S.search_batch(index, queries, k=5)))
    return out


def main():
    r = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    spark = local_session(8, shuffle_partitions=32, driver_memory="16g")
    src = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    big = scratch_path(spark, f"docs-x{r}")
    n = src.agg(F.max("doc_id")).first()[0] + 1
    (src.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(r - 1))))
     .select((F.col("copy") * n + F.col("doc_id")).alias("doc_id"), "text")
     .repartition(8 * r).write.parquet(big))
    queries = spark.read.parquet(f"{SF}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    measure(spark, f"{SF}/documents.parquet", queries)          # warm-up
    for label, path in (("x1", f"{SF}/documents.parquet"), (f"x{r}", big)):
        print(json.dumps({"scale": label, **measure(spark, path, queries)}), flush=True)


if __name__ == "__main__":
    main()
