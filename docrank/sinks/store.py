"""Document store: corpus texts laid out by a hash of the id, so that the texts of a few
documents are read without scanning the corpus.

Layout, in a versioned folder (``docrank.sinks.versions``)::

    <version>/texts/bucket=<b>/*.parquet   doc_id, text and any further columns, sorted by id
    <version>/meta/*.parquet               one row: buckets, schema

``bucket = pmod(xxhash64(id as text), buckets)``.  A lookup by literal ids reads their
buckets (a partition filter) and in them the row groups whose id range covers the ids.  A
result table carries its buckets into the join, and Spark prunes the partitions by them at
run time: k results read at most k buckets.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrank.sinks import versions

DEFAULT_BUCKETS = 256


def store_bucket(doc_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("string")), F.lit(buckets)).cast("int")


def write_doc_store(corpus: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS) -> str:
    """Store ``corpus`` (``doc_id``, ``text``, any further columns) at ``path``; a store that is
    there is replaced in one step.  Choose ``buckets`` so that a bucket holds about a file
    (corpus size / ~256 MB).  Returns ``path``."""
    spark = corpus.sparkSession
    version = versions.new_version()
    folder = f"{path}/versions/{version}"
    # adaptive execution cuts a large bucket into several files and merges none with another
    rows = corpus.withColumn("bucket", store_bucket(F.col("doc_id"), buckets)).hint("rebalance", "bucket")
    rows.sortWithinPartitions("bucket", "doc_id").write.partitionBy("bucket").parquet(f"{folder}/texts")
    # the schema is kept: an empty store has no file to tell it
    spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(rows.schema.json()).alias("schema")).write.parquet(f"{folder}/meta")
    versions.mark(spark, path, version)
    versions.publish(spark, path, version)
    return path


class DocStore:
    """Reader of one version of a store, resolved here once."""

    def __init__(self, spark: SparkSession, path: str):
        folder = versions.resolve(spark, path)
        self.spark = spark
        meta = spark.read.parquet(f"{folder}/meta").first()
        self.buckets = int(meta["buckets"])
        self.texts = spark.read.schema(T.StructType.fromJson(json.loads(meta["schema"]))).parquet(f"{folder}/texts")

    def corpus(self) -> DataFrame:
        """All documents."""
        return self.texts.drop("bucket")

    def lookup(self, ids: list) -> DataFrame:
        """Documents of a literal list of ids."""
        if not ids:
            return self.corpus().limit(0)
        buckets = [store_bucket(F.lit(i), self.buckets) for i in ids]
        return self.texts.where(F.col("bucket").isin(buckets) & F.col("doc_id").isin(ids)).drop("bucket")

    def attach(self, result: DataFrame) -> DataFrame:
        """``result`` with the columns of its documents, lazily.  Of a ranked result (a top
        k, small enough to be broadcast) only its buckets are read."""
        placed = result.withColumn("bucket", store_bucket(F.col("doc_id"), self.buckets))
        if "rank" in result.columns:
            # Spark prunes partitions at run time by a side that is filtered; every rank
            # passes.  (A filter of a join column would be passed on to the store, and
            # Spark would then filter the result by the whole store.)
            placed = placed.where(F.col("rank") >= 1)
        return placed.join(self.texts, ["bucket", "doc_id"]).drop("bucket")


def read_doc_store(spark: SparkSession, path: str) -> DocStore:
    return DocStore(spark, path)
