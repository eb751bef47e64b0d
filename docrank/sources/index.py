"""Readers for stored indexes and legacy text exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrank.operators import weights as W
from docrank.operators.search import Searchable
from docrank.operators.joins import DEFAULT_MAX_ROWS_PER_KEY
from docrank.sinks.index import DOC_WORD, DOC_WORD_N, WORD_DOC, bucket_of, stored_postings
from docrank.sinks.versions import resolve
from docrank.sources.listing import file_name, list_files, partition_value, read_lines, url_of


class Index(Searchable):
    """A stored index (see ``docrank.sinks.index``) as a weights source for
    the search operators.  The version is resolved once, here: an index that is replaced
    meanwhile does not change what this reader sees."""

    def __init__(self, spark: SparkSession, path: str,
                 max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY):
        self.spark = spark
        self.path = path
        self.max_rows_per_key = max_rows_per_key
        folder = self.folder = resolve(spark, path)
        metas = spark.read.parquet(f"{folder}/meta")          # one row per build / stream batch
        meta = (metas.orderBy("batch_id") if "batch_id" in metas.columns else metas).first()
        self.n_docs = int(metas.agg(F.sum("n_docs")).first()[0])
        self.n = meta["n_override"] if meta["n_override"] is not None else float(self.n_docs)
        self.tokenizer = meta["tokenizer"]
        self.idf_kind = meta["idf_kind"]
        self.tf_decimals = meta["tf_decimals"]
        self.buckets = int(meta["buckets"])
        self.df_override = meta["df_override"]
        self.postings = stored_postings(spark, folder, meta)
        self.blocks = spark.read.parquet(f"{folder}/blocks")
        vocab = spark.read.parquet(f"{folder}/vocabulary")
        if "batch_id" in vocab.columns:       # streamed index: per-batch deltas
            vocab = vocab.groupBy("bucket", "word").agg(
                F.sum("doc_frequency").cast("long").alias("doc_frequency"))
        self.vocabulary = vocab
        self._fences: list | None = None

    # postings are laid out by word, not by document
    doc_local = False

    def idf(self) -> DataFrame:
        """(bucket, word, doc_frequency, idf, n_postings)"""
        v = self.vocabulary
        eff = (F.lit(int(self.df_override)) if self.df_override is not None
               else F.col("doc_frequency")).cast("long")
        return v.select("bucket", "word", eff.alias("doc_frequency"),
                        W.idf_expr(F.lit(float(self.n)), eff, self.idf_kind).alias("idf"),
                        F.col("doc_frequency").alias("n_postings"))

    def weights(self) -> DataFrame:
        """Full (word, doc_id, ..., tf_idf) table, salted for hot words."""
        return W.tf_idf(self.postings.drop("bucket", "range"), self.idf().drop("bucket"), self.max_rows_per_key)

    def _bucket_filter(self, words: list[str]):
        return F.col("bucket").isin([bucket_of(F.lit(w), self.buckets) for w in words])

    def _words(self, words: DataFrame) -> tuple[DataFrame, list[int]]:
        """``(bucket, word)`` of a word table, and the buckets it touches (at most
        ``buckets`` small integers, fetched)."""
        w = words.select("word").distinct().withColumn("bucket", bucket_of(F.col("word"), self.buckets))
        return w, [r["bucket"] for r in w.select("bucket").distinct().collect()]

    def _restrict(self, df: DataFrame, words) -> DataFrame:
        """Rows of ``df`` (postings, blocks or vocabulary) whose word is in ``words``:
        a literal list prunes buckets statically and pushes ``word IN (..)``
        into the scan; for a word table (or what ``_words`` made of it) the buckets it
        touches become a static partition filter, then a semi join on (bucket, word)
        keeps its words."""
        if isinstance(words, list) and not words:
            return df.limit(0)
        if isinstance(words, list):
            return df.where(self._bucket_filter(words) & F.col("word").isin(words))
        w, touched = words if isinstance(words, tuple) else self._words(words)
        if len(touched) < self.buckets:
            df = df.where(F.col("bucket").isin(touched))
        return df.join(w, ["bucket", "word"], "left_semi")

    def blocks_for(self, words: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Postings ``(doc_id, word, range, term_frequency)`` of ``words``, their blocks (of
        all batches of a streamed index together), and ``(word, idf)``."""
        found = self._words(words)
        blocks = self._restrict(self.blocks, found)
        if "batch_id" in blocks.columns:
            blocks = blocks.groupBy("word", "range").agg(F.max("max_tf").alias("max_tf"))
        postings = self._restrict(self.postings, found).select("doc_id", "word", "range", "term_frequency")
        return postings, blocks.select("word", "range", "max_tf").repartition("range"), self._restrict(self.idf(), found).select("word", "idf")

    @property
    def fences(self) -> list:
        """``(file, first_word, last_word, n_words)`` of the dictionary files in word order
        (one row per file, read once); empty for a streamed index, which has none."""
        if self._fences is None:
            rows = [] if "batch_id" in self.postings.columns else self.spark.read.parquet(f"{self.folder}/fences").collect()
            self._fences = sorted(rows, key=lambda r: r.first_word.encode())
        return self._fences

    def _dictionary(self, fences: list) -> DataFrame:
        files = [f.file for f in fences]
        schema = "word string, doc_frequency long"
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def largest_words(self, k: int) -> DataFrame:
        """``(word, idf)`` of the ``k`` words that are last in word order; only the last
        dictionary files are read."""
        if not self.fences:
            return self.idf_table().orderBy(F.desc("word")).limit(k).select("word", "idf")
        held, tail = 0, []
        for f in reversed(self.fences):
            if held >= k:
                break
            tail.append(f)
            held += f.n_words
        return self._with_idf(self._dictionary(tail)).orderBy(F.desc("word")).limit(k).select("word", "idf")

    def words_with_prefix(self, prefix: str) -> DataFrame:
        """``(word, doc_frequency, idf)`` of the words that begin with ``prefix``; only the
        dictionary files whose words can are read."""
        if "batch_id" in self.postings.columns:
            found = self.vocabulary.select("word", "doc_frequency")
        else:
            # word order is that of UTF-8 bytes
            low = prefix.encode()
            found = self._dictionary([f for f in self.fences if f.last_word.encode() >= low and f.first_word.encode()[:len(low)] <= low])
        return self._with_idf(found.where(F.col("word").startswith(prefix))).select("word", "doc_frequency", "idf")

    def _with_idf(self, words: DataFrame) -> DataFrame:
        eff = F.lit(int(self.df_override)) if self.df_override is not None else F.col("doc_frequency")
        return words.withColumn("idf", W.idf_expr(F.lit(float(self.n)), eff.cast("long"), self.idf_kind))

    def idf_table(self) -> DataFrame:
        return self.idf().select("word", "idf", "n_postings")

    def terms_for(self, words) -> DataFrame:
        """``(doc_id, word, term_frequency)`` postings of ``words``."""
        return self._restrict(self.postings, words).select("doc_id", "word", "term_frequency")

    def idf_for(self, words) -> DataFrame:
        """``(word, idf, n_postings)`` for ``words``."""
        return self._restrict(self.idf(), words).select("word", "idf", "n_postings")

    def weights_for(self, words: list[str]) -> DataFrame:
        """(doc_id, word, tf_idf) for literal ``words``; the vocabulary side
        has at most ``len(words)`` rows and is broadcast."""
        return (self.terms_for(words).join(F.broadcast(self.idf_for(words).select("word", "idf")), "word")
                .select("doc_id", "word", (F.col("term_frequency") * F.col("idf")).alias("tf_idf")))


def read_index(spark: SparkSession, path: str,
               max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY) -> Index:
    return Index(spark, path, max_rows_per_key)


def read_tsv(spark: SparkSession, path: str, value_name: str = "tf_idf", layout: str = WORD_DOC) -> DataFrame:
    """Import ``<key>\\t<value>`` lines as typed ``(doc_id, word, value)``.  Words hold
    no ``-`` or ``:`` (no tokenizer yields them), so ids may contain both.
    ``DOC_WORD_N`` adds ``n_docs``."""
    line = F.col("value")
    value = F.substring_index(line, "\t", -1)
    rows = spark.read.text(path).select(
        F.substring(line, F.lit(1), F.length(line) - F.length(value) - 1).alias("key"),
        value.cast("double").alias(value_name))
    if layout == WORD_DOC:
        return rows.select(F.expr("substr(key, instr(key, '-') + 1)").alias("doc_id"),
                           F.substring_index("key", "-", 1).alias("word"), value_name)
    extra = []
    if layout == DOC_WORD_N:
        tail = F.substring_index("key", ":", -1)
        rows = rows.select(F.substring(F.col("key"), F.lit(1), F.length("key") - F.length(tail) - 1).alias("key"),
                           value_name, tail.cast("double").alias("n_docs"))
        extra = ["n_docs"]
    elif layout != DOC_WORD:
        raise ValueError(f"unknown layout {layout!r}")
    word = F.substring_index("key", "-", -1)
    return rows.select(F.substring(F.col("key"), F.lit(1), F.length("key") - F.length(word) - 1).alias("doc_id"),
                       word.alias("word"), value_name, *extra)


def read_per_doc(spark: SparkSession, path: str, value_name: str = "frequency", value_type: str = "bigint",
                 id_type: str = "string") -> DataFrame:
    """Per-document ``word\\tvalue`` text (``write_per_doc(fmt='tsv')``) as ``(doc_id, word,
    value)``; an empty word stays an empty word.  Files are listed and read on the
    executors."""
    rows = read_lines(list_files(spark, path), partition_value(F.col("path"), "doc_id").cast(id_type).alias("doc_id"))
    rows = rows.withColumnRenamed("line", "value")
    value = F.substring_index("value", "\t", -1)
    return rows.select("doc_id", F.substring(F.col("value"), F.lit(1), F.length("value") - F.length(value) - 1).alias("word"),
                       value.cast(value_type).alias(value_name))


def read_captured(spark: SparkSession, path: str, value_name: str = "value",
                  id_pattern: str = r"^([^.]*)", id_from: str = "file_name") -> DataFrame:
    """Per-document ``word\\tvalue`` files (no header), doc id = group 1 of
    ``id_pattern`` in the file name (default: up to the first dot) or path:
    ``(doc_id, word, <value_name>)`` with value as string.  Files are listed and read on
    the executors."""
    if id_from not in ("file_name", "file_path"):
        raise ValueError("id_from must be 'file_name' or 'file_path'")
    name = url_of(F.col("path"))
    doc_id = F.regexp_extract(name if id_from == "file_path" else file_name(name), id_pattern, 1)
    lines = read_lines(list_files(spark, path), doc_id.alias("doc_id"))
    # lines as Spark's CSV reader takes them: those of white space alone are none
    fields = F.from_csv("line", "word string, value string", {"sep": "\t", "quote": "", "nullValue": "\u0000", "emptyValue": ""})
    rows = lines.where(F.col("line").rlike("[^\\x00-\\x20]")).select("doc_id", fields.alias("f"))
    return rows.select("doc_id", F.col("f.word").alias("word"), F.col("f.value").alias(value_name))
