"""Index and result sinks.

Stored index layout (``write_index``), in a versioned folder (``docrank.sinks.versions``)::

    <version>/postings/bucket=<b>/*.parquet   word, range, doc_id, frequency, total_words
                                              (sorted by word, range, doc_id)
    <version>/blocks/bucket=<b>/*.parquet     word, range, max_tf, n_postings
    <version>/vocabulary/bucket=<b>/*.parquet word, doc_frequency
    <version>/dictionary/*.parquet            word, doc_frequency; files in word order
    <version>/fences/*.parquet                per dictionary file: first and last word, words
    <version>/meta/*.parquet                  one row: n_docs, tokenizer, idf_kind,
                                              tf_decimals, buckets, packed

The term frequency of a posting follows from what is stored and is computed while it is
read (``stored_postings``).  A packed index (``docrank.sinks.packed``) has ``packed/bucket=<b>/`` in place of ``postings``:
binary blocks of one word's ids, counts and lengths, taken apart while they are read.

``bucket = pmod(xxhash64(word), buckets)``.  A search for a few words reads only
their buckets (partition pruning) and, inside them, only the row groups whose
word range covers the terms (min/max statistics on the word-sorted files).
Choose ``buckets`` so that a bucket holds a few files (postings size / ~1 GB).  The
index never stores the product tf x idf: it is formed at search time for the
query words only, which avoids the corpus-wide postings x vocabulary join.

A large index is built in rounds, each a share of the documents (postings) or of the buckets
(blocks), and the shuffle files of a round go when it ends: what a build needs besides the
index is a share of its postings.

A block is the postings of a word in one range of documents (``docrank.operators.blocks``)
with the largest term frequency among them, which lets a search for many queries skip
most ranges.  The dictionary serves what goes by word order (the words from the end, words
with a prefix): the fences name the files to read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrank.functions.numeric import format_fixed
from docrank.operators import weights as W
from docrank.operators.blocks import blocks_of, doc_range, sub_ranges
from docrank.plans.model import TfIdf
from docrank.session import remove_scratch, scratch_path, shuffles_removed
from docrank.sinks import versions
from docrank.sinks.packed import pack_postings, unpack_postings
from docrank.sources.listing import write_doc_lines

DEFAULT_BUCKETS = 64
PART_ROWS = 250_000        # postings that a task makes blocks of
SPLIT_BYTES = 8 << 20      # of stored postings that a task deals to the parts
ROUNDS = 3                 # shares of the documents whose postings are shuffled at a time
ROUND_BYTES = 64 << 20     # of input that need no second round
BLOCK_ROUNDS = 8           # shares of the buckets whose blocks are made at a time
BLOCK_ROUND_ROWS = 8_000_000    # postings that need no second round
# smaller than with Spark's default, in no more CPU time
COMPRESSION = "zstd"


def n_rounds(rows: DataFrame) -> int:
    """Rounds for ``rows`` by the bytes of their input, as far as the plan knows them (no job
    runs); one where a round could see other rows than the one before."""
    plan = rows._jdf.queryExecution().optimizedPlan()
    if not plan.deterministic():
        return 1
    unknown = rows.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    leaves = plan.collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return max(1, min(ROUNDS, -(-sum(b for b in sizes if b < unknown) // ROUND_BYTES)))


def bucket_of(word_col, buckets: int):
    return F.pmod(F.xxhash64(word_col), F.lit(buckets)).cast("int")


def write_index(model: TfIdf, path: str, buckets: int = DEFAULT_BUCKETS,
                mode: str = "overwrite", dictionary_files: int | None = None, packed: bool = False) -> str:
    """Materialize ``model`` as a stored index at ``path`` (jobs: meta, postings, blocks,
    vocabulary, dictionary, fences; ``dictionary_files`` sets the number of dictionary
    files, else adaptive execution sizes them; ``packed`` keeps the postings, of integer
    document ids, in binary blocks).  The build goes to a folder of its own and is published by one
    rename at the end: readers see the old index or the new one, never a mixture, and a
    build that fails changes nothing.  ``mode='errorifexists'`` refuses to replace a
    published index.  Returns ``path``."""
    spark = model.spark
    if mode not in ("overwrite", "errorifexists"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "errorifexists" and versions.versions_of(spark, path):
        raise FileExistsError(f"an index is published at {path}")
    version = versions.new_version()
    folder = f"{path}/versions/{version}"
    with shuffles_removed(spark):
        write_meta(model, folder, buckets, packed)
        (write_packed if packed else write_postings)(model, folder, buckets)
        write_blocks(stored_postings(in_small_splits(spark), folder), folder, buckets, n_stored(spark, folder, packed))
        write_vocabulary(spark, folder)
        write_dictionary(spark, folder, dictionary_files)
    versions.mark(spark, path, version)
    versions.publish(spark, path, version)
    return path


def write_postings(model: TfIdf, folder: str, buckets: int) -> None:
    """Postings in rounds, each a share of the documents (the meta row is there already).
    The terms of a model that shuffles to make them are written once, below the checkpoint
    folder, and the rounds read that."""
    n_docs = model.spark.read.parquet(f"{folder}/meta").first()["n_docs"]
    placed = doc_range(F.col("doc_id"), F.col("total_words"), sub_ranges(F.lit(float(n_docs))))
    rows = model.terms.select("word", "doc_id", "frequency", "total_words")
    rounds = n_rounds(rows)
    kept = scratch_path(model.spark, "terms") if rounds > 1 and not model.doc_local else None
    if kept:
        rows.write.option("compression", COMPRESSION).parquet(kept)
        rows = model.spark.read.schema(rows.schema).parquet(kept)
    for i in range(rounds):
        terms = rows if rounds == 1 else rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == i)
        postings = (terms.withColumn("bucket", bucket_of(F.col("word"), buckets))
                    # rebalance on the bucket: AQE cuts a large (hot) bucket into
                    # advisory-size pieces and merges small ones, so files are even
                    # and each is written into one bucket directory.  A global sort
                    # would give narrower word ranges per file but needs a sampling
                    # pass that tokenizes the whole corpus once more.
                    .hint("rebalance", "bucket")
                    # sorted files: min/max statistics let a word filter skip the
                    # row groups of other words
                    .withColumn("range", placed)
                    .sortWithinPartitions("bucket", "word", "range", "doc_id")
                    .select("bucket", "word", "range", "doc_id", "frequency", "total_words"))
        postings.write.mode("append").option("compression", COMPRESSION).partitionBy("bucket").parquet(f"{folder}/postings")
    if kept:
        remove_scratch(model.spark, kept)


def write_packed(model: TfIdf, folder: str, buckets: int) -> None:
    blocks = pack_postings(model.tf.withColumn("bucket", bucket_of(F.col("word"), buckets)))
    (blocks.hint("rebalance", "bucket").sortWithinPartitions("bucket", "word", "doc_id_low")
     .write.option("compression", COMPRESSION).partitionBy("bucket").parquet(f"{folder}/packed"))


def stored_postings(spark: SparkSession, folder: str, meta=None) -> DataFrame:
    """The postings of a version, packed or not (``meta``: its row, if it was read)."""
    meta = meta or spark.read.parquet(f"{folder}/meta").first()
    if "packed" in meta and meta["packed"]:
        return unpack_postings(spark.read.parquet(f"{folder}/packed"), meta["n_docs"], meta["tf_decimals"])
    rows = spark.read.parquet(f"{folder}/postings")
    # streamed indexes, and those of earlier versions, have all columns
    return rows if "term_frequency" in rows.columns else W.term_frequency(rows, meta["tf_decimals"])


def write_meta(model: TfIdf, folder: str, buckets: int, packed: bool = False) -> None:
    meta = model.corpus_size().select(
        F.col("n_docs").cast("long").alias("n_docs"),
        F.lit(model.tokenizer).alias("tokenizer"),
        F.lit(model.idf_kind).alias("idf_kind"),
        F.lit(model.tf_decimals).cast("int").alias("tf_decimals"),
        F.lit(buckets).alias("buckets"),
        (model.n_docs if model.n is not None else F.lit(None)).cast("double").alias("n_override"),
        F.lit(model.doc_frequency_override).cast("long").alias("df_override"),
        F.lit(packed).alias("packed"))
    meta.coalesce(1).write.parquet(f"{folder}/meta")


def n_stored(spark: SparkSession, folder: str, packed: bool) -> int:
    """Number of stored postings."""
    if packed:
        return spark.read.parquet(f"{folder}/packed").agg(F.sum("n")).first()[0] or 0
    return spark.read.parquet(f"{folder}/postings").count()       # from the footers


def in_small_splits(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` that reads files in splits of ``SPLIT_BYTES``: a task that
    deals postings to many parts holds the rows of its split until they are dealt, several
    times the bytes of a file in which each word's ids lie together."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    split = "spark.sql.files.maxPartitionBytes"
    own.conf.set(split, str(min(SPLIT_BYTES, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())))
    return own


def write_blocks(stored: DataFrame, folder: str, buckets: int, rows: int) -> None:
    """Blocks of ``rows`` stored postings, in rounds, each a share of the buckets."""
    rounds = max(1, min(buckets, BLOCK_ROUNDS, -(-rows // BLOCK_ROUND_ROWS)))
    for i in range(rounds):
        share = list(range(buckets))[i::rounds]
        own = stored.where(F.col("bucket").isin(share)) if rounds > 1 else stored
        (dealt_blocks(own, len(share), -(-rows * len(share) // buckets)).sortWithinPartitions("bucket", "word", "range")
         .write.mode("append").option("compression", COMPRESSION).partitionBy("bucket").parquet(f"{folder}/blocks"))


def dealt_blocks(stored: DataFrame, buckets: int, rows: int) -> DataFrame:
    """Blocks of ``rows`` postings, whole parts of a bucket in a task, each part of about
    ``PART_ROWS`` postings.  One shuffle serves the sums and the files; nothing is added up
    before it: few postings share a block, and a task would hold one sum for nearly every
    posting that it reads."""
    parts = max(1, -(-rows // (buckets * PART_ROWS)))
    dealt = stored.select("bucket", "word", "range", "term_frequency").withColumn("part", F.pmod(F.xxhash64("word", "range"), F.lit(parts)))
    return blocks_of(dealt.repartition(buckets * parts, "bucket", "part"), "bucket", "part").drop("part")


def write_vocabulary(spark: SparkSession, folder: str) -> None:
    """Document frequencies: the postings of a word's blocks."""
    stored = spark.read.parquet(f"{folder}/blocks")
    vocab = stored.groupBy("bucket", "word").agg(F.sum("n_postings").alias("doc_frequency"))
    (vocab.hint("rebalance", "bucket").sortWithinPartitions("bucket", "word")
     .write.partitionBy("bucket").parquet(f"{folder}/vocabulary"))


def write_dictionary(spark: SparkSession, folder: str, files: int | None) -> None:
    """The vocabulary in word order, and the fences of its files (one row per file)."""
    words = spark.read.parquet(f"{folder}/vocabulary").select("word", "doc_frequency")
    ordered = words.repartitionByRange(files, "word") if files else words.repartitionByRange("word")
    ordered.sortWithinPartitions("word").write.parquet(f"{folder}/dictionary")
    stored = spark.read.schema(words.schema).parquet(f"{folder}/dictionary")
    fences = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("word").alias("first_word"), F.max("word").alias("last_word"), F.count(F.lit(1)).alias("n_words"))
    fences.coalesce(1).write.parquet(f"{folder}/fences")


# Keys of the three text stages.
WORD_DOC = "word_doc"        # <word>-<doc_id>          tf-idf
DOC_WORD = "doc_word"        # <doc_id>-<word>          term frequency
DOC_WORD_N = "doc_word_n"    # <doc_id>-<word>:<N>      word count


def write_tsv(rows: DataFrame, path: str, value_col: str = "tf_idf", mode: str = "overwrite",
              layout: str = WORD_DOC, n: float | Column | None = None, decimals: int | None = None,
              compression: str | None = None) -> None:
    """Text export, one ``<key>\\t<value>`` line per (word, document), key by ``layout``;
    ``DOC_WORD_N`` carries the corpus size ``n``.  Ids and words are written as they
    stand (white space too).  ``decimals`` writes the value with that many places;
    ``compression`` (``gzip``) makes files that ``read_tsv`` reads as they are, each by one task,
    as one task wrote it."""
    word, doc = F.col("word"), F.col("doc_id").cast("string")
    if layout == WORD_DOC:
        key = F.concat(word, F.lit("-"), doc)
    elif layout == DOC_WORD:
        key = F.concat(doc, F.lit("-"), word)
    elif layout == DOC_WORD_N:
        size = n if isinstance(n, Column) else F.lit(float(n))
        key = F.concat(doc, F.lit("-"), word, F.lit(":"), size.cast("double").cast("string"))
    else:
        raise ValueError(f"unknown layout {layout!r}")
    value = F.col(value_col).cast("string") if decimals is None else format_fixed(F.col(value_col), decimals)
    rows.select(F.concat(key, F.lit("\t"), value).alias("value")).write.mode(mode).text(path, compression=compression)


def write_per_doc(rows: DataFrame, path: str, mode: str = "overwrite",
                  fmt: str = "parquet", value_col: str | None = None, folders: int | None = None,
                  grouped: bool = False) -> None:
    """One directory per document (``doc_id=<id>/``), the layout of the
    per-document outputs.  Rows of one document come from one corpus row, so
    each document is written by one task into one file without a shuffle.
    ``fmt='tsv'`` writes ``word<TAB>value`` text lines (``value_col``), like
    the captured per-document stage outputs; its directories are made by the tasks,
    with ``folders`` in that many folders; ``grouped`` rows, those of an id one after the
    other in each partition, are not sorted (``sources.listing.write_doc_lines``).  Meant for
    corpora whose document count a file system can hold as directories; a large corpus
    belongs in ``write_index``."""
    if fmt == "tsv":
        line = F.concat_ws("\t", F.col("word"), F.col(value_col).cast("string")).alias("line")
        write_doc_lines(rows.select("doc_id", line), path, mode, folders, grouped)
    else:
        rows.write.mode(mode).partitionBy("doc_id").parquet(path)


def save_results(result: DataFrame, path: str, fmt: str = "parquet",
                 mode: str = "errorifexists") -> None:
    """Write a search result.  The default refuses to overwrite an existing
    result directory."""
    result.write.mode(mode).format(fmt).save(path)


def write_csv_corpus(corpus: DataFrame, path: str, mode: str = "overwrite") -> None:
    """RFC 4180 CSV with header (quotes doubled, whitespace kept), readable by
    ``read_csv_corpus``."""
    (corpus.write.mode(mode).option("header", "true").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
