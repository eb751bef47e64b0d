"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each over the whole tables of ``sf_dir``.

Column names and rounding match ``docrank.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrank.functions.numeric import format_fixed
from docrank.functions.sql import register
from docrank.functions.tokenize import ALPHA, NONWORD_SPLIT, WORD_LOWER, tokens
from docrank.operators import search as S
from docrank.operators.blocks import stored
from docrank.plans.model import TfIdf, balance_input, in_few_parts
from docrank.plans.oracle import BAG_QUERY, FOLLOWUP_QUERY, QUERY, ROWS_QUERY
from docrank.session import scratch_path
from docrank.sinks import index as sink
from docrank.sinks.store import read_doc_store, write_doc_store
from docrank.sources import corpus as src
from docrank.sources.container import read_container, read_per_doc_container, write_container, write_per_doc_container
from docrank.sources.listing import FOLDERS, id_name, list_files, read_file_texts, write_doc_lines, write_file_texts
from docrank.sources.index import read_captured, read_index, read_per_doc, read_tsv

CSV_FILE_BYTES = 256 << 20
DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.read_parquet_corpus(spark, f"{sf_dir}/documents.parquet")


def model(spark: SparkSession, sf_dir: str, flavor: str = "sql", **kw) -> TfIdf:
    return TfIdf.flavor(documents(spark, sf_dir), flavor, **kw)


def r10(c: str):
    return F.round(F.col(c), 10).alias(c)


def r8(c: str):
    return F.round(F.col(c), 8).alias(c)


def q_corpus_size(spark, sf_dir):
    return model(spark, sf_dir).corpus_size()


def q_csv_corpus_roundtrip(spark, sf_dir):
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*DOC_COLUMNS)
    path = scratch_path(spark, "csv")
    sink.write_csv_corpus(raw, path)
    back = src.read_csv_corpus(spark, path, columns=DOC_COLUMNS, id_col="doc_id", text_col="text")
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def q_csv_arity_filter(spark, sf_dir):
    """Ten-field CSV records built from the documents; records of French
    documents lose a field and records of Spanish documents gain one, so the
    strict reader must drop exactly those."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    f = [F.col("doc_id").cast("string"), F.col("lang"), F.col("source"), F.col("n_chars").cast("string")]
    filler = [F.lit(f"x{i}") for i in range(5)]
    opts = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

    def rec(cols):
        return F.to_csv(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)]), opts)

    text = F.coalesce(F.col("text"), F.lit(""))
    line = (F.when(F.col("lang") == "fr", rec(f + filler[:4] + [text]))
            .when(F.col("lang") == "es", rec(f + filler + [text, F.lit("extra")]))
            .otherwise(rec(f + filler + [text])))
    path = scratch_path(spark, "arity")
    d.select(line.alias("value")).write.text(path)
    cols = [f"c{i}" for i in range(10)]
    back = src.read_csv_corpus(spark, path, columns=cols, id_col="c0", text_col="c9",
                               strict_arity=True, header=False)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def q_csv_corpus_split_multiline(spark, sf_dir):
    """The documents in CSV files with line breaks in quotes, read by byte ranges: one file
    for each 256 MB of input, which is more than a range, so that no task writes them all."""
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*DOC_COLUMNS)
    path = scratch_path(spark, "csv-one")
    sink.write_csv_corpus(in_few_parts(raw, CSV_FILE_BYTES), path)
    back = src.read_csv_corpus(spark, path, columns=DOC_COLUMNS, id_col="doc_id", text_col="text", split=True)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def q_csv_corpus_splittable(spark, sf_dir):
    """One record per line (line breaks in texts become spaces): files are cut anywhere."""
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*DOC_COLUMNS)
    path = scratch_path(spark, "csv-lines")
    sink.write_csv_corpus(raw.withColumn("text", F.regexp_replace("text", "[\\r\\n]", " ")), path)
    back = src.read_csv_corpus(spark, path, columns=DOC_COLUMNS, id_col="doc_id", text_col="text", multi_line=False)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def _word_count(mode):
    def q(spark, sf_dir):
        return TfIdf(documents(spark, sf_dir), tokenizer=mode).word_count()
    return q


def q_doc_length(spark, sf_dir):
    return model(spark, sf_dir).doc_length()


def q_term_frequency(spark, sf_dir):
    return model(spark, sf_dir).tf.select("doc_id", "word", "frequency", "total_words", "term_frequency")


def q_term_frequency_6dp(spark, sf_dir):
    m = TfIdf(documents(spark, sf_dir), tokenizer=WORD_LOWER, tf_decimals=6)
    return m.tf.select("doc_id", "word", "frequency", "total_words", "term_frequency")


def q_document_frequency(spark, sf_dir):
    return model(spark, sf_dir).doc_frequency


def _idf(kind):
    def q(spark, sf_dir):
        m = TfIdf(documents(spark, sf_dir), tokenizer=WORD_LOWER, idf_kind=kind)
        return m.idf.select("word", "doc_frequency", r10("idf"))
    return q


def _tfidf(flavor):
    def q(spark, sf_dir):
        return model(spark, sf_dir, flavor).weights.select("doc_id", "word", r10("tf_idf"))
    return q


def q_tfidf_alpha_raw(spark, sf_dir):
    m = TfIdf(documents(spark, sf_dir), tokenizer=ALPHA, idf_kind="raw", tf_decimals=6)
    return m.weights.select("doc_id", "word", r10("tf_idf"))


POSTING = ("word", "doc_id", "frequency")     # what the listings show


def _posting_columns(p):
    return p.select("word", "block",
                    F.array_join(F.transform("doc_ids", lambda x: x.cast("string")), ",").alias("doc_ids"),
                    F.array_join(F.transform("frequencies", lambda x: x.cast("string")), ",").alias("frequencies"),
                    F.size("doc_ids").cast("long").alias("n_postings"))


def q_posting_list(spark, sf_dir):
    return _posting_columns(S.posting_list(model(spark, sf_dir).tf.select(*POSTING), block_size=1024))


def q_posting_list_string_ids(spark, sf_dir):
    """Ids are text; blocks go by a hash of the id."""
    corpus = documents(spark, sf_dir).select(F.concat(F.lit("d"), F.col("doc_id")).alias("doc_id"), "text")
    # written once, read for the sizes and for the lists
    rows = stored(TfIdf.flavor(corpus, "sql").tf.select(*POSTING), "postings")
    return _posting_columns(S.posting_list(rows, block_size=64))


def q_search_sum_top5(spark, sf_dir):
    return S.search_sum(model(spark, sf_dir), spark, QUERY, WORD_LOWER, "set", k=5).select("rank", "doc_id", r8("score"))


def q_search_sum_set(spark, sf_dir):
    return S.search_sum(model(spark, sf_dir, "rdd"), spark, QUERY, NONWORD_SPLIT, "set").select("doc_id", r8("score"))


def q_search_sum_bag(spark, sf_dir):
    return S.search_sum(model(spark, sf_dir, "mapreduce"), spark, BAG_QUERY, NONWORD_SPLIT, "bag").select("doc_id", r8("score"))


def _search_rows(k):
    def q(spark, sf_dir):
        m = model(spark, sf_dir)
        rows = S.search_rows(m, spark, ROWS_QUERY, WORD_LOWER, k=k)
        return S.with_text(rows, m.raw_corpus).select("rank", "doc_id", "word", r10("tf_idf"), "text")
    return q


def q_store_search_rows_top5(spark, sf_dir):
    """The five best rows with their texts from a document store."""
    m = model(spark, sf_dir)
    store = read_doc_store(spark, write_doc_store(m.raw_corpus, scratch_path(spark, "store"), buckets=64))
    rows = S.search_rows(m, spark, ROWS_QUERY, WORD_LOWER, k=5)
    return S.with_text(rows, store).select("rank", "doc_id", "word", r10("tf_idf"), "text")


def q_followup_search(spark, sf_dir):
    m = model(spark, sf_dir)
    first = S.search_rows(m, spark, ROWS_QUERY, WORD_LOWER, k=5)
    return S.search_rows(m, spark, FOLLOWUP_QUERY, WORD_LOWER, k=2, within=first).select("rank", "doc_id", "word", r10("tf_idf"))


def q_vocabulary_desc_top20(spark, sf_dir):
    return S.vocabulary_desc(model(spark, sf_dir), 20, score_decimals=10)


def q_index_vocabulary_desc_top20(spark, sf_dir):
    """The preview from a stored index: its words come from the last dictionary file."""
    return S.vocabulary_desc(_built_index(spark, sf_dir), 20, score_decimals=10)


def q_index_prefix_words(spark, sf_dir):
    """Words of the index that begin with ``in``, with their document frequencies."""
    return _built_index(spark, sf_dir).words_with_prefix("in").select("word", "doc_frequency", r10("idf"))


def q_sql_text_tfidf(spark, sf_dir):
    """tf-idf written in SQL text with the registered functions.  Token lists are dealt by
    document, one row each: the counts of a document are made where its list is."""
    register(spark)
    return spark.sql("""
        WITH split AS (SELECT doc_id, tokens_word_lower(text) AS words FROM {docs}),
        dealt AS (SELECT /*+ REPARTITION(doc_id) */ doc_id, words FROM split WHERE doc_id IS NOT NULL),
        whole AS (SELECT doc_id, sort_array(flatten(collect_list(words))) AS words, collect_list(size(words)) AS lengths FROM dealt GROUP BY doc_id),
        runs AS (SELECT doc_id, lengths, words, filter(sequence(0, size(words)), i -> i < size(words) AND (i = 0 OR get(words, i) != get(words, i - 1))) AS starts FROM whole),
        terms AS (SELECT doc_id, lengths, inline(transform(starts, (s, j) -> struct(get(words, s) AS word, coalesce(get(starts, j + 1), size(words)) - s AS frequency))) FROM runs),
        no_id AS (SELECT DISTINCT explode(words) AS word FROM split WHERE doc_id IS NULL),
        df AS (SELECT word, count(*) AS doc_frequency FROM (SELECT word FROM terms UNION ALL SELECT word FROM no_id) GROUP BY word),
        rows AS (SELECT doc_id, word, frequency, explode(lengths) AS total_words FROM terms)
        SELECT doc_id, word, round(frequency / total_words * idf((SELECT CAST(count(*) AS DOUBLE) FROM {docs}), doc_frequency), 10) AS tf_idf
        FROM rows JOIN df USING (word)""", docs=documents(spark, sf_dir))


def q_sql_text_tokenizers(spark, sf_dir):
    """Tokens of each document by the three registered tokenizers."""
    register(spark)
    return spark.sql("""
        SELECT doc_id, CAST(size(tokens_word_lower(text)) AS BIGINT) AS n_lower, CAST(size(tokens_alpha(text)) AS BIGINT) AS n_alpha,
               CAST(size(tokens_nonword_split(text)) AS BIGINT) AS n_split FROM {docs}""", docs=documents(spark, sf_dir))


def benchmark_queries(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(
        F.col("item_id").alias("query_id"), "text")


def q_search_batch_top5(spark, sf_dir):
    return S.search_batch(model(spark, sf_dir), benchmark_queries(spark, sf_dir), WORD_LOWER, "set", k=5).select("query_id", "rank", "doc_id", r8("score"))


def q_search_batch_bag_top5(spark, sf_dir):
    return S.search_batch(model(spark, sf_dir), benchmark_queries(spark, sf_dir), WORD_LOWER, "bag", k=5).select("query_id", "rank", "doc_id", r8("score"))


def _built_index(spark, sf_dir, **kw):
    path = scratch_path(spark, "index")
    sink.write_index(model(spark, sf_dir), path, buckets=16, **kw)
    return read_index(spark, path)


def q_index_search_sum(spark, sf_dir):
    idx = _built_index(spark, sf_dir)
    return S.search_sum(idx, spark, QUERY, idx.tokenizer, "set").select("doc_id", r8("score"))


def q_index_search_batch_top5(spark, sf_dir):
    idx = _built_index(spark, sf_dir)
    return S.search_batch(idx, benchmark_queries(spark, sf_dir), idx.tokenizer, "set", k=5).select("query_id", "rank", "doc_id", r8("score"))


def q_index_packed_search_sum(spark, sf_dir):
    """A search of packed postings: only the blocks of its words are taken apart."""
    idx = _built_index(spark, sf_dir, packed=True)
    return S.search_sum(idx, spark, QUERY, idx.tokenizer, "set").select("doc_id", r8("score"))


def q_index_packed_tfidf(spark, sf_dir):
    """All weights of an index of packed postings."""
    return _built_index(spark, sf_dir, packed=True).weights().select("doc_id", "word", r10("tf_idf"))


def q_index_packed_batch_top5(spark, sf_dir):
    idx = _built_index(spark, sf_dir, packed=True)
    return S.search_batch(idx, benchmark_queries(spark, sf_dir), idx.tokenizer, "set", k=5).select("query_id", "rank", "doc_id", r8("score"))


def q_tsv_export_import(spark, sf_dir):
    path = scratch_path(spark, "tsv")
    sink.write_tsv(model(spark, sf_dir).weights, path)
    back = read_tsv(spark, path)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "word", r10("tf_idf"))


def q_tsv_stage1_roundtrip(spark, sf_dir):
    """Word counts as ``<id>-<word>:<N>`` lines, with ids that hold ``-``, ``:`` and a
    trailing space."""
    corpus = documents(spark, sf_dir).select(F.concat(F.lit("a-b:"), F.col("doc_id"), F.lit(" ")).alias("doc_id"), "text")
    m = TfIdf(corpus, tokenizer=NONWORD_SPLIT)
    path = scratch_path(spark, "stage1")
    sink.write_tsv(m.word_count(), path, "frequency", layout=sink.DOC_WORD_N, n=m.n_docs)
    back = read_tsv(spark, path, "frequency", sink.DOC_WORD_N)
    return back.select("doc_id", "word", F.col("frequency").cast("long").alias("frequency"), "n_docs")


def q_tsv_stage2_roundtrip(spark, sf_dir):
    """Term frequencies as ``<id>-<word>`` lines with six places."""
    m = TfIdf(documents(spark, sf_dir), tokenizer=NONWORD_SPLIT, tf_decimals=6)
    path = scratch_path(spark, "stage2")
    sink.write_tsv(m.tf, path, "term_frequency", layout=sink.DOC_WORD, decimals=6)
    back = read_tsv(spark, path, "term_frequency", sink.DOC_WORD)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "word", "term_frequency")


def q_counts_index_search(spark, sf_dir):
    """Word counts written as text, read back as counts, indexed and searched."""
    path, idx = scratch_path(spark, "stage1"), scratch_path(spark, "counts-index")
    m = model(spark, sf_dir)
    sink.write_tsv(m.word_count(), path, "frequency", layout=sink.DOC_WORD_N, n=m.n_docs, compression="gzip")
    back = read_tsv(spark, path, "frequency", sink.DOC_WORD_N)
    counts = back.select(F.col("doc_id").cast("long").alias("doc_id"), "word", F.col("frequency").cast("long").alias("frequency"))
    sink.write_index(TfIdf.from_counts(counts, n=back.select(F.max("n_docs")).scalar()), idx, buckets=16)
    index = read_index(spark, idx)
    return S.search_sum(index, spark, QUERY, index.tokenizer, "set").select("doc_id", r8("score"))


def _counts_by_document(spark, sf_dir, mode=WORD_LOWER):
    """Word counts, those of a document one after the other in each partition: the documents
    are sorted, a few thousand rows a task, and not their words."""
    docs = balance_input(documents(spark, sf_dir)).sortWithinPartitions(id_name())
    return TfIdf(docs, tokenizer=mode, balance=False).word_count()


def _per_doc(mode):
    """Word counts written as one ``word<TAB>count`` text file per document
    (directory ``doc_id=<id>``) and read back."""
    def q(spark, sf_dir):
        path = scratch_path(spark, "perdoc")
        counts = _counts_by_document(spark, sf_dir, mode)
        sink.write_per_doc(counts, path, fmt="tsv", value_col="frequency", folders=FOLDERS, grouped=True)
        return read_per_doc(spark, path, id_type="bigint").select("doc_id", "word", "frequency")
    return q


def q_container_corpus(spark, sf_dir):
    """All documents in containers of many documents each, and back."""
    path = scratch_path(spark, "containers")
    write_container(documents(spark, sf_dir), path)
    return read_container(spark, path).select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def q_per_doc_container(spark, sf_dir):
    """Word counts as one text per document, in containers, and back."""
    path = scratch_path(spark, "per-doc-containers")
    write_per_doc_container(model(spark, sf_dir).word_count(), path, "frequency")
    return read_per_doc_container(spark, path, "frequency", id_type="bigint")


def q_save_results_roundtrip(spark, sf_dir):
    """A search result saved (an existing result is refused) and read back."""
    path = scratch_path(spark, "results")
    sink.save_results(S.search_sum(model(spark, sf_dir), spark, QUERY, WORD_LOWER, "set"), path)
    return spark.read.parquet(path).select("doc_id", r8("score"))


def q_overwrite_index_search(spark, sf_dir):
    """An index of another flavor overwritten by the default one, then searched."""
    path = scratch_path(spark, "index")
    sink.write_index(model(spark, sf_dir, "mapreduce"), path, buckets=4)
    sink.write_index(model(spark, sf_dir), path, buckets=16)
    idx = read_index(spark, path)
    return S.search_sum(idx, spark, QUERY, idx.tokenizer, "set").select("doc_id", r8("score"))


def q_index_versions_search(spark, sf_dir):
    """An index replaced while a reader is open: the reader goes on with its version,
    a new one sees the new index."""
    path = scratch_path(spark, "index")
    sink.write_index(model(spark, sf_dir, "mapreduce"), path, buckets=8)
    before = read_index(spark, path)
    sink.write_index(model(spark, sf_dir), path, buckets=16)
    after = read_index(spark, path)
    found = [S.search_sum(i, spark, QUERY, i.tokenizer, "set").select(F.lit(name).alias("version"), "doc_id", r8("score"))
             for name, i in (("before", before), ("after", after))]
    return found[0].unionByName(found[1])


def q_term_frequency_6dp_text(spark, sf_dir):
    """Term frequencies as text with six places."""
    m = TfIdf(documents(spark, sf_dir), tokenizer=WORD_LOWER)
    return m.tf.select("doc_id", "word", format_fixed(F.col("term_frequency"), 6).alias("tf"))


def q_read_captured(spark, sf_dir):
    """Per-document ``word<TAB>value`` files, the id taken from the file path."""
    path = scratch_path(spark, "captured")
    counts = _counts_by_document(spark, sf_dir)
    sink.write_per_doc(counts, path, fmt="tsv", value_col="frequency", folders=FOLDERS, grouped=True)
    back = read_captured(spark, path, "frequency", id_pattern=r"doc_id=(\d+)", id_from="file_path")
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "word", F.col("frequency").cast("long").alias("frequency"))


def _write_lines(spark, sf_dir) -> str:
    """Documents as ten-field CSV records with a quoted text; the real line
    breaks of the texts cut records into several physical lines."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit('"'), F.lit('""'))
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "lang", "source", "n_chars")]
    line = F.concat_ws(",", *fields, *[F.lit(f"x{i}") for i in range(5)], F.concat(F.lit('"'), text, F.lit('"')))
    path = scratch_path(spark, "lines")
    d.select(line.alias("value")).write.text(path)
    return path


def q_lines_corpus_word_count(spark, sf_dir):
    """Read line by line; only lines of exactly ten fields are documents."""
    c = src.read_lines_corpus(spark, _write_lines(spark, sf_dir), n_fields=10, id_index=0, text_index=9)
    return TfIdf(c, multi_row=True).word_count()


def q_lines_last_field_word_count(spark, sf_dir):
    """Read line by line; every line is a document row, its text the last field."""
    c = src.read_lines_corpus(spark, _write_lines(spark, sf_dir), text_index=-1, strict_arity=False, unquote=False)
    return TfIdf(c, multi_row=True).word_count()


def q_lines_fragment_arity(spark, sf_dir):
    """Number of physical lines by number of fields."""
    lines = spark.read.text(_write_lines(spark, sf_dir))
    return (lines.select(F.size(src.line_fields(F.col("value"))).cast("long").alias("n_fields"))
            .groupBy("n_fields").agg(F.count(F.lit(1)).alias("n_lines")))


def q_files_corpus_tfidf(spark, sf_dir):
    """One file per document (directory ``doc_id=<id>``); N is the number of
    input files."""
    path = scratch_path(spark, "files")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_doc_lines(docs.select("doc_id", F.col("text").alias("line")), path, folders=FOLDERS)
    c = src.read_files_corpus(spark, path, id_pattern=r"doc_id=(\d+)", id_from="file_path")
    c = c.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # the files are dealt to many tasks already
    m = TfIdf(c, n=src.n_input_files(list_files(spark, path)), balance=False)
    return m.weights.select("doc_id", "word", r10("tf_idf"))


def _emptied(spark, sf_dir):
    """The documents, the text of those in French emptied, as one file each in 64 folders."""
    path = scratch_path(spark, "file-texts")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.when(F.coalesce(F.col("lang"), F.lit("")) == "fr", F.lit("")).otherwise(F.coalesce(F.col("text"), F.lit("")))
    write_file_texts(docs.select("doc_id", text.alias("text")), path, folders=64)
    return list_files(spark, path)


def q_files_corpus_size(spark, sf_dir):
    """N as the number of files, empty ones included, listed on the executors."""
    return _emptied(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("length") == 0).alias("n_empty"))


def q_files_corpus_lengths(spark, sf_dir):
    """Words of each one-file-per-document text; an empty file is a document without any."""
    docs = read_file_texts(_emptied(spark, sf_dir))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.size(tokens("text", WORD_LOWER)).cast("long").alias("total_words"))


def q_stream_index_search_sum(spark, sf_dir):
    """The documents arrive as files in a landing directory; a Structured
    Streaming ingest (available-now trigger) builds the index; search it."""
    from docrank.streaming.ingest import ingest
    landing, idx = scratch_path(spark, "landing"), scratch_path(spark, "stream-index")
    spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").write.parquet(landing)
    ingest(spark, landing, idx, buckets=16).awaitTermination()
    index = read_index(spark, idx)
    return S.search_sum(index, spark, QUERY, index.tokenizer, "set").select("doc_id", r8("score"))


def conversations(spark, sf_dir):
    return src.conversation_corpus(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def q_conversation_word_count(spark, sf_dir):
    return TfIdf(conversations(spark, sf_dir), multi_row=True).word_count()


def q_conversation_tfidf(spark, sf_dir):
    m = TfIdf(conversations(spark, sf_dir), multi_row=True)
    return m.weights.select("doc_id", "word", r10("tf_idf"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "corpus_size": q_corpus_size,
    "csv_corpus_roundtrip": q_csv_corpus_roundtrip,
    "csv_arity_filter": q_csv_arity_filter,
    "csv_corpus_split_multiline": q_csv_corpus_split_multiline,
    "csv_corpus_splittable": q_csv_corpus_splittable,
    "word_count_lower": _word_count(WORD_LOWER),
    "word_count_split": _word_count(NONWORD_SPLIT),
    "word_count_alpha": _word_count(ALPHA),
    "doc_length": q_doc_length,
    "term_frequency": q_term_frequency,
    "term_frequency_6dp": q_term_frequency_6dp,
    "term_frequency_6dp_text": q_term_frequency_6dp_text,
    "document_frequency": q_document_frequency,
    "idf_smooth": _idf("smooth"),
    "idf_raw": _idf("raw"),
    "tfidf_sql": _tfidf("sql"),
    "tfidf_rdd": _tfidf("rdd"),
    "tfidf_mapreduce": _tfidf("mapreduce"),
    "tfidf_alpha_raw": q_tfidf_alpha_raw,
    "posting_list": q_posting_list,
    "posting_list_string_ids": q_posting_list_string_ids,
    "search_sum_top5": q_search_sum_top5,
    "search_sum_set": q_search_sum_set,
    "search_sum_bag": q_search_sum_bag,
    "search_rows_top2": _search_rows(2),
    "search_rows_top5": _search_rows(5),
    "store_search_rows_top5": q_store_search_rows_top5,
    "followup_search": q_followup_search,
    "vocabulary_desc_top20": q_vocabulary_desc_top20,
    "index_vocabulary_desc_top20": q_index_vocabulary_desc_top20,
    "index_prefix_words": q_index_prefix_words,
    "sql_text_tfidf": q_sql_text_tfidf,
    "sql_text_tokenizers": q_sql_text_tokenizers,
    "search_batch_top5": q_search_batch_top5,
    "search_batch_bag_top5": q_search_batch_bag_top5,
    "index_search_sum": q_index_search_sum,
    "index_search_batch_top5": q_index_search_batch_top5,
    "index_packed_search_sum": q_index_packed_search_sum,
    "index_packed_tfidf": q_index_packed_tfidf,
    "index_packed_batch_top5": q_index_packed_batch_top5,
    "tsv_export_import": q_tsv_export_import,
    "tsv_stage1_roundtrip": q_tsv_stage1_roundtrip,
    "tsv_stage2_roundtrip": q_tsv_stage2_roundtrip,
    "counts_index_search": q_counts_index_search,
    "per_doc_output": _per_doc(WORD_LOWER),
    "per_doc_output_split": _per_doc(NONWORD_SPLIT),
    "container_corpus": q_container_corpus,
    "per_doc_container": q_per_doc_container,
    "read_captured": q_read_captured,
    "save_results_roundtrip": q_save_results_roundtrip,
    "overwrite_index_search": q_overwrite_index_search,
    "index_versions_search": q_index_versions_search,
    "lines_corpus_word_count": q_lines_corpus_word_count,
    "lines_last_field_word_count": q_lines_last_field_word_count,
    "lines_fragment_arity": q_lines_fragment_arity,
    "files_corpus_tfidf": q_files_corpus_tfidf,
    "files_corpus_size": q_files_corpus_size,
    "files_corpus_lengths": q_files_corpus_lengths,
    "stream_index_search_sum": q_stream_index_search_sum,
    "conversation_word_count": q_conversation_word_count,
    "conversation_tfidf": q_conversation_tfidf,
}
