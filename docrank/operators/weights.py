"""Counting and weighting operators: word counts, document lengths, term
frequency, document frequency, inverse document frequency and TF-IDF.

Every function takes and returns plain DataFrames and is lazy.  Layout of the
work at scale:

* ``terms`` (doc_id, word, frequency, total_words) is computed inside each
  corpus row (sort + run length over the token array), so word counts, document
  lengths and term frequencies need **no shuffle**.
* document frequency is a ``groupBy(word)`` whose partial aggregate runs before
  the shuffle: each task ships one row per distinct word it saw, so a stop word
  that occurs in every document costs one row per task, not one per document.
* TF-IDF joins the term rows to the one-row-per-word IDF table, salted by
  document for words with very many postings (``operators.joins``).
* the corpus size N is a scalar subquery (or a literal); no cross join, no
  driver round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrank.functions.counting import word_run_rows
from docrank.functions.numeric import round_half_up
from docrank.functions.tokenize import WORD_LOWER, tokens
from docrank.operators.joins import DEFAULT_MAX_ROWS_PER_KEY, skew_safe_join

# The two IDF formulas.
IDF_SMOOTH = "smooth"   # ln((N + 1) / (df + 1))
IDF_RAW = "raw"         # ln(N / df)
IDF_KINDS = (IDF_SMOOTH, IDF_RAW)


# --------------------------------------------------------------------------
# corpus size
# --------------------------------------------------------------------------
def corpus_size(corpus: DataFrame) -> DataFrame:
    """One row ``n_docs``: number of corpus rows, including rows whose text is
    null or empty (they are documents without words)."""
    return corpus.agg(F.count(F.lit(1)).alias("n_docs"))


def n_docs(corpus: DataFrame, n: int | float | Column | None = None) -> Column:
    """N as a column: ``n`` when given (number or column), else a scalar subquery over
    the corpus (evaluated once by Spark, shipped to tasks as a constant)."""
    if isinstance(n, Column):
        return n
    if n is not None:
        return F.lit(float(n))
    return corpus.select(F.count(F.lit(1)).cast("double")).scalar()


# --------------------------------------------------------------------------
# per-document counting
# --------------------------------------------------------------------------
def terms(corpus: DataFrame, mode: str = WORD_LOWER, multi_row: bool = False,
          max_rows: int = DEFAULT_MAX_ROWS_PER_KEY) -> DataFrame:
    """``(doc_id, word, frequency, total_words)`` for every distinct word of
    every document.  Documents without tokens produce no rows.

    ``multi_row=False`` (default) requires one row per ``doc_id`` (no loader checks it:
    ``sources.corpus.check_unique_ids`` does, in a job of its own) and runs without a
    shuffle.  ``multi_row=True`` accepts
    documents spread over several rows (e.g. conversation turns): the per-row
    counts are then summed by ``(doc_id, word)`` (partial aggregate first) and
    joined to the per-document totals.
    """
    if not multi_row:
        rows = word_run_rows(corpus, tokens("text", mode), ["doc_id"])
        return rows.select("doc_id", "word", "frequency", "total_words")
    # per-document totals come from per-row token counts, not from the
    # counts: total_words also bounds a document's number of postings, which
    # is what the salted join needs to know
    totals = doc_length(corpus, mode, multi_row=True)
    j = skew_safe_join(multi_row_counts(corpus, mode, max_rows), totals, "doc_id", spread="word",
                       rows_per_key="total_words", max_rows=max_rows)
    return j.select("doc_id", "word", "frequency", "total_words")


def multi_row_counts(corpus: DataFrame, mode: str = WORD_LOWER, max_rows: int = DEFAULT_MAX_ROWS_PER_KEY) -> DataFrame:
    """``(doc_id, word, frequency)`` for documents spread over several rows.

    The token arrays of a document are shuffled with one copy of its id each and counted
    in one row: an id may be long (a whole line), and rows of single words would repeat it
    for each word.  Documents of more than ``max_rows`` characters (a bound on their
    tokens), and rows without an id, are counted per row and summed by (doc_id, word), partial
    aggregate first, so that no group is unbounded; there are at most characters /
    ``max_rows`` such documents, and their ids are broadcast."""
    sizes = corpus.groupBy("doc_id").agg(F.sum(F.length("text") + F.lit(1)).alias("_size"))
    large = sizes.where((F.col("_size") > max_rows) & F.col("doc_id").isNotNull()).select("doc_id", F.lit(True).alias("_large"))
    marked = corpus.join(F.broadcast(large), "doc_id", "left")
    apart = F.col("_large").isNotNull() | F.col("doc_id").isNull()
    small = marked.where(~apart).select("doc_id", tokens("text", mode).alias("_t")).where(F.size("_t") > 0)
    whole = small.repartition("doc_id").groupBy("doc_id").agg(F.flatten(F.collect_list("_t")).alias("_t"))
    counted = word_run_rows(whole, F.col("_t"), ["doc_id"]).select("doc_id", "word", "frequency")
    rows = word_run_rows(marked.where(apart), tokens("text", mode), ["doc_id"])
    return counted.unionByName(rows.groupBy("doc_id", "word").agg(F.sum("frequency").alias("frequency")))


def terms_from_counts(counts: DataFrame, max_rows: int = DEFAULT_MAX_ROWS_PER_KEY) -> DataFrame:
    """``(doc_id, word, frequency)`` rows counted elsewhere (an imported word
    count stage) -> adds ``total_words``.  The per-document sums are a partial
    aggregate; the join back is salted for documents with very many words."""
    totals = counts.groupBy("doc_id").agg(F.sum("frequency").cast("long").alias("total_words"),
                                          F.count(F.lit(1)).alias("_rows"))
    j = skew_safe_join(counts, totals, "doc_id", spread="word", rows_per_key="_rows", max_rows=max_rows)
    return j.select("doc_id", "word", F.col("frequency").cast("long").alias("frequency"), "total_words")


def word_count(corpus: DataFrame, mode: str = WORD_LOWER, multi_row: bool = False) -> DataFrame:
    """``(doc_id, word, frequency)``."""
    return terms(corpus, mode, multi_row).select("doc_id", "word", "frequency")


def doc_length(corpus: DataFrame, mode: str = WORD_LOWER, multi_row: bool = False) -> DataFrame:
    """``(doc_id, total_words)`` for documents with at least one token."""
    per_row = corpus.select("doc_id", F.size(tokens("text", mode)).cast("long").alias("total_words"))
    if multi_row:
        per_row = per_row.groupBy("doc_id").agg(F.sum("total_words").alias("total_words"))
    return per_row.where(F.col("total_words") > 0)


def term_frequency(term_rows: DataFrame, decimals: int | None = None) -> DataFrame:
    """Adds ``term_frequency = frequency / total_words`` (double), optionally
    rounded HALF_UP to ``decimals`` places (the ``%.6f`` stage of the
    MapReduce flavor)."""
    tf = F.col("frequency").cast("double") / F.col("total_words")
    if decimals is not None:
        tf = round_half_up(tf, decimals)
    return term_rows.withColumn("term_frequency", tf)


def document_frequency(term_rows: DataFrame) -> DataFrame:
    """``(word, doc_frequency)``: documents containing each word.  (doc, word)
    rows are unique, so a plain count is exact."""
    return term_rows.groupBy("word").agg(F.count(F.lit(1)).alias("doc_frequency"))


def document_frequency_from_corpus(corpus: DataFrame, mode: str = WORD_LOWER,
                                   words: list[str] | DataFrame | None = None) -> DataFrame:
    """``(word, doc_frequency)`` straight from a one-row-per-document corpus:
    each row contributes its distinct tokens (a hash set, cheaper than the
    sort the counting needs), then a partial + final count per word.
    ``words`` (a literal list or a ``word`` DataFrame) restricts the result."""
    w = corpus.select(F.explode(F.array_distinct(tokens("text", mode))).alias("word"))
    if isinstance(words, list):
        w = w.where(F.col("word").isin(words))
    elif words is not None:
        w = w.join(words.select("word").distinct(), "word", "left_semi")
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("doc_frequency"))


def listed_word_counts(corpus: DataFrame, words: list[str], mode: str = WORD_LOWER) -> DataFrame:
    """``(doc_id, word, frequency, total_words)`` for a literal word list of any
    length: a row's tokens are first cut down to the listed words, and only
    those are sorted and counted."""
    toks = corpus.select("doc_id", tokens("text", mode).alias("_t"))
    hits = F.filter(F.col("_t"), lambda w: w.isin(words)) if words else F.array().cast("array<string>")
    found = toks.select("doc_id", F.size("_t").cast("long").alias("_n"), hits.alias("_h")).where(F.size("_h") > 0)
    rows = word_run_rows(found, F.col("_h"), ["doc_id", "_n"])
    return rows.select("doc_id", "word", "frequency", F.col("_n").alias("total_words"))


def idf_expr(n: Column, df_col: Column, kind: str = IDF_SMOOTH) -> Column:
    if kind == IDF_SMOOTH:
        return F.ln((n + F.lit(1.0)) / (df_col.cast("double") + F.lit(1.0)))
    if kind == IDF_RAW:
        return F.ln(n / df_col.cast("double"))
    raise ValueError(f"unknown idf kind {kind!r}; use one of {IDF_KINDS}")


def idf(doc_freq: DataFrame, n: Column, kind: str = IDF_SMOOTH,
        doc_frequency_override: int | None = None) -> DataFrame:
    """``(word, doc_frequency, idf, n_postings)``.  ``n_postings`` is the true
    number of (document, word) rows of the word; ``doc_frequency`` is the
    value the IDF uses: the same, or ``doc_frequency_override`` when given
    (replaying a run that used a fixed document frequency)."""
    eff = (F.lit(doc_frequency_override) if doc_frequency_override is not None
           else F.col("doc_frequency")).cast("long")
    return doc_freq.select("word", eff.alias("doc_frequency"), idf_expr(n, eff, kind).alias("idf"),
                           F.col("doc_frequency").alias("n_postings"))


def tf_idf(tf_rows: DataFrame, idf_rows: DataFrame,
           max_rows: int = DEFAULT_MAX_ROWS_PER_KEY) -> DataFrame:
    """Joins term frequencies to IDF on ``word`` and adds ``tf_idf``.

    Words with more than ``max_rows`` postings are salted by document
    (``skew_safe_join``), so a word present in every document is spread over many
    tasks.  Whether the vocabulary (one row per word) is broadcast is left to
    adaptive execution, which sees its size at run time."""
    j = skew_safe_join(tf_rows, idf_rows.select("word", "doc_frequency", "idf", "n_postings"),
                       "word", spread="doc_id", rows_per_key="n_postings", max_rows=max_rows, dim_hint=None)
    return j.drop("n_postings").withColumn("tf_idf", F.col("term_frequency") * F.col("idf"))
