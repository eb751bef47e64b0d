"""The TF-IDF model: one lazily built plan over a corpus, and the three
flavors of the analysis (which tokenizer, which IDF, rounding, query
weighting and ranking).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrank.functions.tokenize import ALPHA, NONWORD_SPLIT, WORD_LOWER
from docrank.operators import weights as W
from docrank.operators.blocks import blocks_of, doc_range, stored, sub_ranges
from docrank.operators.search import Searchable
from docrank.session import ensure_checkpoint_dir, scratch_path
from docrank.operators.joins import DEFAULT_MAX_ROWS_PER_KEY

@dataclass(frozen=True)
class Flavor:
    """Choices on which the three classic implementations of the analysis
    differ."""
    tokenizer: str = WORD_LOWER
    idf_kind: str = W.IDF_SMOOTH
    tf_decimals: int | None = None
    weighting: str = "set"      # query terms: "set" (once) or "bag" (repeats add)
    ranking: str = "rows"       # "rows": rank (doc, word) rows; "sum": rank docs by score sum


# The three flavors.
FLAVORS = {
    "mapreduce": Flavor(tokenizer=NONWORD_SPLIT, idf_kind=W.IDF_RAW, tf_decimals=6,
                        weighting="bag", ranking="sum"),
    "rdd": Flavor(tokenizer=NONWORD_SPLIT, idf_kind=W.IDF_SMOOTH, tf_decimals=None,
                  weighting="set", ranking="sum"),
    "sql": Flavor(tokenizer=WORD_LOWER, idf_kind=W.IDF_SMOOTH, tf_decimals=None,
                  weighting="set", ranking="rows"),
    # what the captured MapReduce outputs were produced with
    "captured": Flavor(tokenizer=ALPHA, idf_kind=W.IDF_RAW, tf_decimals=6,
                       weighting="bag", ranking="sum"),
}


def balance_input(corpus: DataFrame, min_files: int | None = None) -> DataFrame:
    """Spread a corpus that is stored in fewer files than the cluster has cores
    (one big file, one row group, a multi-line CSV file) over as many partitions,
    by a hash of the whole row, so that a document of many rows spreads too.

    Only the file listing and the size of the plan are looked at: no job runs, and a
    corpus that comes out of a shuffle is not computed for it.  A corpus of many files, or
    of enough bytes that Spark cuts its files into a split per core - every large one - is
    left alone, so its text is never shuffled."""
    spark = corpus.sparkSession
    target = min_files or int(spark.sparkContext.defaultParallelism)
    if 0 < len(corpus.inputFiles()) < target:
        size = int(str(corpus._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if size < target * int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()):
            return corpus.repartition(target, F.xxhash64(*corpus.columns))
    return corpus


def in_few_parts(df: DataFrame, part_bytes: int) -> DataFrame:
    """``df`` in one part for each ``part_bytes`` of its input, by the size that its plan
    knows (no job runs)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.coalesce(max(1, -(-size // part_bytes)))


class TfIdf(Searchable):
    """Lazy TF-IDF over ``corpus`` (``doc_id, text``).

    ``n`` fixes the corpus size N (else counted).  ``multi_row`` accepts
    documents spread over several rows.  ``balance`` spreads an input of too few
    files (see ``balance_input``); turn it off for a corpus that is spread already.  ``max_rows_per_key`` is the number of rows of
    one word (or document) above which its joins are salted.
    """

    def __init__(self, corpus: DataFrame, tokenizer: str = WORD_LOWER,
                 idf_kind: str = W.IDF_SMOOTH, tf_decimals: int | None = None,
                 n: int | float | Column | None = None, multi_row: bool = False,
                 balance: bool = True, doc_frequency_override: int | None = None,
                 max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY):
        self.raw_corpus = corpus
        self.corpus = balance_input(corpus) if balance else corpus
        self.tokenizer = tokenizer
        self.idf_kind = idf_kind
        self.tf_decimals = tf_decimals
        self.n = n
        self.multi_row = multi_row
        self.doc_frequency_override = doc_frequency_override
        self.max_rows_per_key = max_rows_per_key
        self.counts: DataFrame | None = None

    @classmethod
    def from_counts(cls, counts: DataFrame, **kw) -> "TfIdf":
        """Model over already counted ``(doc_id, word, frequency)`` rows (for
        example a word-count stage imported from text).  N defaults to the
        number of distinct documents among the rows."""
        m = cls(counts.select("doc_id", F.lit("").alias("text")), balance=False, **kw)
        m.__dict__["terms"] = W.terms_from_counts(counts, m.max_rows_per_key)
        m.counts = counts
        return m

    @property
    def from_counts_rows(self) -> bool:
        return self.counts is not None

    @classmethod
    def flavor(cls, corpus: DataFrame, name: str, **kw) -> "TfIdf":
        f = FLAVORS[name]
        return cls(corpus, tokenizer=f.tokenizer, idf_kind=f.idf_kind,
                   tf_decimals=f.tf_decimals, **kw)

    @property
    def spark(self):
        return self.raw_corpus.sparkSession

    # ---- scalar N ----------------------------------------------------------
    @cached_property
    def n_docs(self) -> Column:
        """N: the literal ``n``, else a scalar subquery counting the corpus
        (distinct ids for multi-row documents).  Counted on the unbalanced
        corpus: a count reads no text."""
        if self.n is None and (self.multi_row or self.from_counts_rows):
            return self.corpus_size().select(F.col("n_docs").cast("double")).scalar()
        return W.n_docs(self.raw_corpus, self.n)

    def corpus_size(self) -> DataFrame:
        """One row ``n_docs``: documents of the corpus, or of the counted rows."""
        if self.multi_row or self.from_counts_rows:
            rows = self.counts if self.from_counts_rows else self.raw_corpus
            return rows.agg(F.countDistinct("doc_id").alias("n_docs"))
        return W.corpus_size(self.raw_corpus)

    # ---- frames ------------------------------------------------------------
    @cached_property
    def terms(self) -> DataFrame:
        """(doc_id, word, frequency, total_words)"""
        return W.terms(self.corpus, self.tokenizer, self.multi_row, self.max_rows_per_key)

    def word_count(self) -> DataFrame:
        if self.multi_row and not self.from_counts_rows:
            # no totals are joined; rows without an id have none to join either
            return self._pair_rows.where(F.col("doc_id").isNotNull())
        return self.terms.select("doc_id", "word", "frequency")

    def doc_length(self) -> DataFrame:
        if self.from_counts_rows:
            return self.counts.groupBy("doc_id").agg(F.sum("frequency").cast("long").alias("total_words"))
        return W.doc_length(self.corpus, self.tokenizer, self.multi_row)

    @cached_property
    def tf(self) -> DataFrame:
        """(doc_id, word, frequency, total_words, term_frequency)"""
        return W.term_frequency(self.terms, self.tf_decimals)

    @cached_property
    def doc_frequency(self) -> DataFrame:
        """(word, doc_frequency): documents containing each word."""
        if self.multi_row or self.from_counts_rows:
            return W.document_frequency(self._pair_rows)
        return W.document_frequency_from_corpus(self.corpus, self.tokenizer)

    @property
    def _pair_rows(self) -> DataFrame:
        """One row per (doc_id, word) without the per-document totals."""
        if self.multi_row and not self.from_counts_rows:
            return W.multi_row_counts(self.corpus, self.tokenizer, self.max_rows_per_key)
        return self.terms

    def _doc_frequency_of(self, words) -> DataFrame:
        if self.multi_row or self.from_counts_rows:
            t = self._pair_rows
            t = t.where(F.col("word").isin(words)) if isinstance(words, list) else \
                t.join(words.select("word").distinct(), "word", "left_semi")
            return W.document_frequency(t)
        return W.document_frequency_from_corpus(self.corpus, self.tokenizer, words)

    @cached_property
    def idf(self) -> DataFrame:
        """(word, doc_frequency, idf, n_postings)"""
        return W.idf(self.doc_frequency, self.n_docs, self.idf_kind, self.doc_frequency_override)

    @cached_property
    def weights(self) -> DataFrame:
        """(word, doc_id, frequency, total_words, term_frequency,
        doc_frequency, idf, tf_idf).  The counted rows are written once below the
        checkpoint folder and both the document frequencies and the join read
        them, so the corpus is tokenized once."""
        counted = self.counted
        tf = W.term_frequency(counted, self.tf_decimals)
        idf = W.idf(W.document_frequency(counted), self.n_docs, self.idf_kind, self.doc_frequency_override)
        return W.tf_idf(tf, idf, self.max_rows_per_key)

    @cached_property
    def counted(self) -> DataFrame:
        """``terms``, written and read back."""
        path = scratch_path(self.spark, "counted")
        self.terms.write.parquet(path)
        return self.spark.read.schema(self.terms.schema).parquet(path)

    # ---- search inputs -------------------------------------------------------
    def idf_table(self) -> DataFrame:
        """``(word, idf, n_postings)`` for every word of the corpus."""
        return self.idf.select("word", "idf", "n_postings")

    def largest_words(self, k: int) -> DataFrame:
        """``(word, idf)`` of the ``k`` words that are last in word order."""
        return self.idf_table().orderBy(F.desc("word")).limit(k).select("word", "idf")

    @property
    def doc_local(self) -> bool:
        """True when all term rows of a document come from one corpus row (and
        so stay in one task)."""
        return not self.multi_row and not self.from_counts_rows

    def terms_for(self, words) -> DataFrame:
        """``(doc_id, word, term_frequency)`` for ``words`` (a literal list or a
        DataFrame with a ``word`` column).  Rows of one document stay in the
        task that read it (narrow filter / broadcast semi join)."""
        return self._tf_of(words).select("doc_id", "word", "term_frequency")

    def _tf_of(self, words) -> DataFrame:
        if not isinstance(words, list):
            return self.tf.join(words.select("word").distinct(), "word", "left_semi")
        if self.doc_local:
            # only the listed words of a row are sorted and counted
            rows = W.listed_word_counts(self.corpus, words, self.tokenizer)
            return W.term_frequency(rows, self.tf_decimals)
        return self.tf.where(F.col("word").isin(words))

    def idf_for(self, words) -> DataFrame:
        """``(word, idf, n_postings)`` for ``words`` only: the document-frequency
        aggregate is restricted before its shuffle."""
        d = W.idf(self._doc_frequency_of(words), self.n_docs, self.idf_kind, self.doc_frequency_override)
        return d.select("word", "idf", "n_postings")

    def blocks_for(self, words: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Postings ``(doc_id, word, range, term_frequency)`` of ``words``, their blocks, and
        ``(word, idf)``.  The corpus is tokenized once: the postings of the query words are
        written below the checkpoint folder, and blocks and document frequencies come from
        them."""
        n = self.corpus_size().select(F.col("n_docs").cast("double")).scalar()
        ranged = self._tf_of(words).select("doc_id", "word", doc_range(F.col("doc_id"), F.col("total_words"), sub_ranges(n)).alias("range"),
                                           "term_frequency")
        postings = stored(ranged, "postings")
        # one shuffle by range serves the blocks and the bounds made of them
        blocks = blocks_of(postings.select("word", "range", "term_frequency").repartition("range"))
        idf = W.idf(W.document_frequency(postings), self.n_docs, self.idf_kind, self.doc_frequency_override).select("word", "idf")
        return postings, blocks, idf

    def weights_for(self, words: list[str]) -> DataFrame:
        """(doc_id, word, tf_idf) for literal ``words``.  The corpus is read once:
        the (document, query word) rows are few, and a reliable checkpoint lets
        both the document frequencies and the scoring read them.  The IDF side has
        at most ``len(words)`` rows and is broadcast, so even a word present in
        every document is joined without a shuffle."""
        ensure_checkpoint_dir(self.spark)
        tf = self._tf_of(words).select("doc_id", "word", "term_frequency").checkpoint(eager=True)
        d = W.idf(W.document_frequency(tf), self.n_docs, self.idf_kind, self.doc_frequency_override)
        return (tf.join(F.broadcast(d.select("word", "idf")), "word")
                .select("doc_id", "word", (F.col("term_frequency") * F.col("idf")).alias("tf_idf")))
