"""Top-k search of many queries over postings in blocks with their largest term
frequency.

Documents are dealt to *ranges*: first by length (eight classes per doubling), since
no document of a range of long ones has a large term frequency, then by a hash of the
id, so that a range holds about ``RANGE_DOCS`` documents at any corpus size.  A *block*
is the postings of one word in one range; its largest term frequency bounds what the
word can add to any document of the range.

``top_documents`` uses the bounds to score few documents:

1. every (query, range) gets a bound, the sum of its blocks' bounds;
2. the ``SEED_RANGES`` ranges with the largest bounds of each query are scored; the k-th
   best score is a threshold that the k-th best of all cannot be below;
3. ranges whose bound is below the threshold are skipped, the others are scored.

The result is exact: skipping compares with a little slack for the rounding of sums, and
ties with the threshold are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docrank.session import scratch_path

RANGE_DOCS = 12
CLASSES = 8                # length classes per doubling
USUAL_CLASSES = 64         # classes that hold most documents of a corpus
SEED_RANGES = 16


def sub_ranges(n_docs: Column) -> Column:
    """Ranges per length class for a corpus of ``n_docs`` documents."""
    return F.greatest(F.lit(1.0), F.ceil(n_docs / F.lit(float(USUAL_CLASSES * RANGE_DOCS)))).cast("long")


def doc_range(doc_id: Column, total_words: Column, subs: Column) -> Column:
    """Range of a document: its length class, then a hash of its id."""
    length = F.floor(F.log2(total_words.cast("double")) * F.lit(float(CLASSES)))
    return F.shiftleft(length.cast("long"), 40) + F.pmod(F.xxhash64(doc_id), subs)


def blocks_of(postings: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, word, range, max_tf, n_postings)`` of every block."""
    return postings.groupBy(*keys, "word", "range").agg(
        F.max("term_frequency").alias("max_tf"), F.count(F.lit(1)).alias("n_postings"))


def ordered_sum(contribution: Column) -> Column:
    """Sum of a group's contributions in ascending order, so that it does not depend on
    the partitioning (a group holds the query words of one document)."""
    return F.aggregate(F.array_sort(F.collect_list(contribution)), F.lit(0.0), lambda a, x: a + x)


def range_bounds(words: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(query_id, range, bound)`` for ``words(query_id, word, gain)``: the most that a
    document of the range can score.  Where ``blocks`` are partitioned by range and the words
    are few enough to be broadcast, the sums need no shuffle."""
    most = F.greatest(F.col("gain") * F.col("max_tf"), F.lit(0.0))
    return (words.join(blocks.select("word", "range", "max_tf"), "word")
            .groupBy("query_id", "range").agg(F.sum(most).alias("bound")))


def postings_in(ranges: DataFrame, words: DataFrame, postings: DataFrame) -> DataFrame:
    """``(query_id, doc_id, given)``: what each query word gives to each document of the
    query's ``ranges``."""
    wanted = ranges.select("query_id", "range").join(words, "query_id")
    return wanted.join(postings.select("doc_id", "word", "range", "term_frequency"), ["word", "range"]).select(
        "query_id", "doc_id", (F.col("term_frequency") * F.col("gain")).alias("given"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a scratch table and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_k(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` of each query up to the k-th by score (desc), then ``doc_id``, and their
    number ``rn``."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    # the filter must compare row_number itself for Spark to infer the group limit
    return rows.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def candidate_ranges(bounds: DataFrame, words: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """``(query_id, range)`` of the ranges that cannot be skipped; all of a query whose
    seeds hold fewer than ``k`` documents."""
    w = Window.partitionBy("query_id").orderBy(F.desc("bound"), F.asc("range"))
    seeds = bounds.withColumn("place", F.row_number().over(w)).where(F.col("place") <= SEED_RANGES)
    partial = postings_in(seeds, words, postings).groupBy("query_id", "doc_id").agg(F.sum("given").alias("score"))
    kth = first_k(partial, k).where(F.col("rn") == k)
    # slack for the rounding of the sums
    least = kth.select("query_id", (F.col("score") - F.abs("score") * 1e-9 - 1e-15).alias("least"))
    return (bounds.join(least, "query_id", "left").where(F.col("least").isNull() | (F.col("bound") >= F.col("least")))
            .select("query_id", "range"))


def top_documents(words: DataFrame, blocks: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, doc_id, score)``: the ``k`` best documents of each query of
    ``words(query_id, word, gain)``; a document scores the sum of gain x term frequency
    over the query's words.  ``postings(doc_id, word, range, term_frequency)`` are read for
    the seeds and for the candidates; the bounds are written once, below the checkpoint
    folder."""
    bounds = stored(range_bounds(words, blocks), "bounds")
    rows = postings_in(candidate_ranges(bounds, words, postings, k), words, postings)
    scored = rows.groupBy("query_id", "doc_id").agg(ordered_sum(F.col("given")).alias("score"))
    return first_k(scored, k).select("query_id", F.col("rn").cast("long").alias("rank"), "doc_id", "score")
