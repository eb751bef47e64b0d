"""Search operators over a weights source (a ``TfIdf`` model or a stored
``Index``); both offer ``terms_for(words)`` -> ``(doc_id, word,
term_frequency)``, ``idf_for(words)`` -> ``(word, idf, n_postings)`` and
``weights_for(words)`` -> ``(doc_id, word, tf_idf)``, where ``words`` is a
literal list or a DataFrame with a ``word`` column.  For many queries they offer
``blocks_for(words)`` -> postings with their document ranges, blocks, IDF.

* ``search_sum``    score = sum of tf-idf of the matching words per document
                    (``set``: a repeated query term counts once, ``bag``: each
                    repetition counts again)
* ``search_rows``   rank single (document, word) rows by tf-idf
* ``with_text``     attach the document text to a ranked result
* ``search_batch``  many queries at once, top k per query
* ``posting_list``  (word, documents) lists in bounded blocks
* ``vocabulary_desc`` weights ordered by word, descending

Ranking uses full double precision.  A document's score adds its words'
contributions in ascending order, so it does not depend on the partitioning and
equal documents tie exactly; ties go to the smaller ``doc_id`` then ``word``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrank.functions.tokenize import WORD_LOWER, query_tokens
from docrank.operators.blocks import ordered_sum, stored, top_documents

SET = "set"
BAG = "bag"


# --------------------------------------------------------------------------
# query terms
# --------------------------------------------------------------------------
def query_term_list(spark: SparkSession, query: str, mode: str = WORD_LOWER) -> list[str]:
    """Terms of one typed query, in order, repeats kept.  Evaluated by Spark's
    own tokenizer expression on a one-row local relation (a job over that one
    row), so query and index are tokenized identically."""
    row = spark.createDataFrame([(query,)], "q string").select(
        query_tokens(F.col("q"), mode).alias("t")).first()
    return list(row["t"]) if row and row["t"] is not None else []


def term_weights(words: list[str], weighting: str = SET) -> dict[str, int]:
    """word -> query weight (1 under ``set``, number of repeats under ``bag``)."""
    out: dict[str, int] = {}
    for w in words:
        out[w] = out.get(w, 0) + 1 if weighting == BAG else 1
    return out


def batch_terms(queries: DataFrame, mode: str = WORD_LOWER, weighting: str = SET) -> DataFrame:
    """``(query_id, word, qtf)`` for a ``(query_id, text)`` DataFrame."""
    t = queries.select("query_id", F.explode(query_tokens(F.col("text"), mode)).alias("word"))
    if weighting == BAG:
        return t.groupBy("query_id", "word").agg(F.count(F.lit(1)).alias("qtf"))
    if weighting == SET:
        return t.distinct().withColumn("qtf", F.lit(1).cast("long"))
    raise ValueError(f"weighting must be {SET!r} or {BAG!r}")


# --------------------------------------------------------------------------
# single query
# --------------------------------------------------------------------------
def ranked(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows with their ``rank`` from 1."""
    top = rows.orderBy(*order).limit(k)
    # at most k rows reach the window
    return top.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias("rank"), *rows.columns)


def search_sum(source, spark: SparkSession, query: str, mode: str = WORD_LOWER,
               weighting: str = SET, k: int | None = None) -> DataFrame:
    """``(doc_id, score)`` for every document containing a query term; with
    ``k``, ``(rank, doc_id, score)`` of the k best by score (desc) then ``doc_id``."""
    weights = term_weights(query_term_list(spark, query, mode), weighting)
    rows = source.weights_for(sorted(weights))
    if weighting == BAG and any(v > 1 for v in weights.values()):
        qtf = F.create_map(*[x for w, c in sorted(weights.items()) for x in (F.lit(w), F.lit(c))])
        contrib = F.col("tf_idf") * qtf[F.col("word")]
    else:
        contrib = F.col("tf_idf")
    scored = rows.groupBy("doc_id").agg(ordered_sum(contrib).alias("score"))
    return scored if k is None else ranked(scored, k, F.desc("score"), F.asc("doc_id"))


def search_rows(source, spark: SparkSession, query: str, mode: str = WORD_LOWER,
                k: int | None = 2, within: DataFrame | None = None) -> DataFrame:
    """``(doc_id, word, tf_idf)`` rows whose word is a query term, best
    tf-idf first (ties: doc_id, word); with ``k``, the first k rows and their
    ``rank``.  ``within`` restricts the search to the documents of an earlier
    result (a follow-up search)."""
    words = sorted(set(query_term_list(spark, query, mode)))
    rows = source.weights_for(words).select("doc_id", "word", "tf_idf")
    if within is not None:
        # a left-semi join: the planner broadcasts ``within`` when its
        # estimated size is small (a top-k is), else shuffles both sides
        rows = rows.join(within.select("doc_id").distinct(), "doc_id", "left_semi")
    order = (F.desc("tf_idf"), F.asc("doc_id"), F.asc("word"))
    return rows.orderBy(*order) if k is None else ranked(rows, k, *order)


def with_text(result: DataFrame, corpus) -> DataFrame:
    """Attach ``text`` to a result, lazily; a result with a ``rank`` keeps its
    order.  ``corpus`` is a document store, of which the buckets of the result's
    documents are read, or a corpus DataFrame, which is scanned.  The planner broadcasts
    a result that it knows to be small (a top k is) and else shuffles both sides."""
    if isinstance(corpus, DataFrame):
        out = result.join(corpus.select("doc_id", "text"), "doc_id")
    else:
        out = corpus.attach(result)
    return out.orderBy("rank") if "rank" in result.columns else out


# --------------------------------------------------------------------------
# many queries
# --------------------------------------------------------------------------
def search_batch(source, queries: DataFrame, mode: str = WORD_LOWER,
                 weighting: str = SET, k: int = 5) -> DataFrame:
    """``(query_id, rank, doc_id, score)``: the top ``k`` documents of every
    query of ``queries(query_id, text)``; score = sum over the query's words
    of qtf x tf x idf.

    Exact, and few documents are scored: see ``docrank.operators.blocks``.  No size is
    guessed while the query is built: joins are left to adaptive execution, which
    broadcasts, and splits hot words, by the sizes it sees."""
    terms = stored(batch_terms(queries, mode, weighting), "query-terms")
    postings, blocks, idf = source.blocks_for(terms)
    words = terms.join(idf, "word").select("query_id", "word", (F.col("qtf") * F.col("idf")).alias("gain"))
    words = stored(words, "query-words")
    return top_documents(words, blocks, postings, k)


# --------------------------------------------------------------------------
# listings
# --------------------------------------------------------------------------
def posting_list(tf_rows: DataFrame, block_size: int = 1024, by: str | None = None) -> DataFrame:
    """``(word, block, doc_ids, frequencies, term_frequencies)``: postings of
    each word gathered in blocks, sorted by ``doc_id``, so that no group is
    unbounded and a stop word spreads over many tasks.  Rows without a
    ``term_frequency`` give no ``term_frequencies``.  The rows are dealt by block before they
    are gathered: gathering first makes many small lists that are sorted and spilled.

    ``by='range'`` (the default for integer ids) blocks consecutive ids,
    ``block = doc_id div block_size``: at most ``block_size`` postings each.
    ``by='hash'`` (the default for other ids, right for sparse integers too) gives a
    word of n postings ``ceil(n / block_size)`` blocks and deals its postings to
    them by a hash of the id: about ``block_size`` postings each."""
    if by is None:
        by = "range" if isinstance(tf_rows.schema["doc_id"].dataType, T.IntegralType) else "hash"
    if by == "range":
        blocked = tf_rows.withColumn("block", F.floor(F.col("doc_id") / F.lit(block_size)).cast("long"))
    elif by == "hash":
        # only words of more than one block are looked up
        sizes = (tf_rows.groupBy("word").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_size)).alias("_blocks"))
                 .where(F.col("_blocks") > 1))
        digits = F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 8)
        blocked = tf_rows.join(sizes, "word", "left").withColumn(
            "block", F.when(F.col("_blocks").isNull(), F.lit(0)).otherwise(F.pmod(F.conv(digits, 16, 10).cast("long"), F.col("_blocks"))).cast("long"))
    else:
        raise ValueError("by must be 'range' or 'hash'")
    lists = {"doc_id": "doc_ids", "frequency": "frequencies", "term_frequency": "term_frequencies"}
    kept = [c for c in lists if c in tf_rows.columns]
    g = (blocked.select("word", "block", *kept).repartition("word", "block").groupBy("word", "block")
         .agg(F.sort_array(F.collect_list(F.struct(*kept))).alias("p")))
    return g.select("word", "block", *[F.col(f"p.{c}").alias(lists[c]) for c in kept])


def vocabulary_desc(source, k: int = 20, score_decimals: int | None = None) -> DataFrame:
    """``(doc_id, word, tf_idf)`` ordered by word descending (ties: doc_id),
    first ``k`` rows - the index preview of the SQL flavor.

    The first k rows by word come from at most the k largest words, so only
    those words' postings are weighed instead of the whole tf-idf table: the
    k largest words and their IDF are fetched (a top-k over the vocabulary,
    at most k rows) and become a literal word filter (bucket pruning and
    pushed-down ``word IN`` on an index)."""
    top = source.largest_words(k).collect()
    spark = source.spark
    top_words = spark.createDataFrame([(r["word"], r["idf"]) for r in top], "word string, idf double")
    rows = source.terms_for([r["word"] for r in top]).join(F.broadcast(top_words), "word")
    tfidf = F.col("term_frequency") * F.col("idf")
    if score_decimals is not None:
        tfidf = F.round(tfidf, score_decimals)
    return (rows.select("doc_id", "word", tfidf.alias("tf_idf"))
            .orderBy(F.desc("word"), F.asc("doc_id")).limit(k))


class Searchable:
    """Search methods for a weights source that has ``spark`` and
    ``tokenizer`` attributes (``TfIdf``, ``Index``)."""

    def search(self, query: str, k: int | None = None, weighting: str = SET) -> DataFrame:
        """``(doc_id, score)``: see ``search_sum``."""
        return search_sum(self, self.spark, query, self.tokenizer, weighting, k=k)

    def search_rows(self, query: str, k: int | None = 2, within: DataFrame | None = None) -> DataFrame:
        """``(doc_id, word, tf_idf)``: see ``search_rows``."""
        return search_rows(self, self.spark, query, self.tokenizer, k=k, within=within)

    def search_batch(self, queries: DataFrame, k: int = 5, weighting: str = SET) -> DataFrame:
        """``(query_id, rank, doc_id, score)``: see ``search_batch``."""
        return search_batch(self, queries, self.tokenizer, weighting, k=k)

