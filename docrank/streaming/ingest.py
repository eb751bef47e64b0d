"""Incremental index maintenance with Structured Streaming.

New corpus files (``doc_id, text``) arriving in a directory are tokenized and
counted per row (the same no-shuffle operator as the batch path) and appended
to a stored index.  Every micro-batch appends

* its postings under ``postings/bucket=<b>/``,
* its blocks (largest term frequency per word and document range) under
  ``blocks/bucket=<b>/``,
* its per-word document counts under ``vocabulary/bucket=<b>/``,
* its document count as one ``meta`` row,

so the index stays a set of append-only deltas: ``Index`` sums document
frequencies per word and document counts over all batches.  Documents must be
new (ids are not updated or deleted).  Exactly-once delivery comes from the
stream checkpoint plus idempotent batch directories (``batch_id`` column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docrank.functions.tokenize import WORD_LOWER
from docrank.operators import weights as W
from docrank.operators.blocks import doc_range, sub_ranges
from docrank.session import scratch_path
from docrank.sinks.index import DEFAULT_BUCKETS, bucket_of, dealt_blocks

CORPUS_SCHEMA = "doc_id bigint, text string"


def corpus_stream(spark: SparkSession, path: str, schema: str = CORPUS_SCHEMA,
                  fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(doc_id, text)`` over files landing in ``path``."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def _append_batch(index_path: str, tokenizer: str, idf_kind: str, buckets: int):
    def write(batch: DataFrame, batch_id: int) -> None:
        subs = sub_ranges(batch.select(F.count(F.lit(1)).cast("double")).scalar())
        terms = (W.term_frequency(W.terms(batch, tokenizer))
                 .withColumn("bucket", bucket_of(F.col("word"), buckets))
                 .withColumn("range", doc_range(F.col("doc_id"), F.col("total_words"), subs))
                 .withColumn("batch_id", F.lit(batch_id).cast("long")))
        postings = terms.select("word", "range", "doc_id", "frequency", "total_words", "term_frequency",
                                "bucket", "batch_id")
        # dynamic overwrite of this batch's partitions: a replayed batch
        # replaces its own earlier partial output instead of duplicating it
        (postings.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "batch_id").parquet(f"{index_path}/postings"))
        stored = (batch.sparkSession.read.parquet(f"{index_path}/postings")
                  .where(F.col("batch_id") == batch_id))
        (dealt_blocks(stored, buckets, stored.count()).withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "batch_id").parquet(f"{index_path}/blocks"))
        stored = (batch.sparkSession.read.parquet(f"{index_path}/blocks")
                  .where(F.col("batch_id") == batch_id))
        vocab = (stored.groupBy("bucket", "word").agg(F.sum("n_postings").alias("doc_frequency"))
                 .withColumn("batch_id", F.lit(batch_id).cast("long")))
        (vocab.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "batch_id").parquet(f"{index_path}/vocabulary"))
        meta = batch.agg(F.count(F.lit(1)).cast("long").alias("n_docs")).select(
            "n_docs", F.lit(tokenizer).alias("tokenizer"), F.lit(idf_kind).alias("idf_kind"),
            F.lit(None).cast("int").alias("tf_decimals"), F.lit(buckets).alias("buckets"),
            F.lit(None).cast("double").alias("n_override"), F.lit(None).cast("long").alias("df_override"),
            F.lit(batch_id).cast("long").alias("batch_id"))
        (meta.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{index_path}/meta"))
    return write


def ingest(spark: SparkSession, source_dir: str, index_path: str, checkpoint: str | None = None,
           tokenizer: str = WORD_LOWER, idf_kind: str = W.IDF_SMOOTH,
           buckets: int = DEFAULT_BUCKETS, available_now: bool = True,
           schema: str = CORPUS_SCHEMA, fmt: str = "parquet",
           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest stream.  ``available_now`` processes what is there and
    stops; otherwise it keeps running with the default trigger.
    ``max_files_per_trigger`` bounds a micro-batch when a large backlog lands
    at once (the available-now trigger honours it too)."""
    checkpoint = checkpoint or scratch_path(spark, "ingest-ckpt")
    w = (corpus_stream(spark, source_dir, schema, fmt, max_files_per_trigger).writeStream
         .foreachBatch(_append_batch(index_path, tokenizer, idf_kind, buckets))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
