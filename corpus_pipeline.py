"""A training-corpus pipeline over ``documents``: language identification, near
duplicates, personal data, source mix, encoding.

Each stage takes the documents that the one before it kept.  All but the last
return the columns of ``documents``; the last returns the encoded documents.

Defined results: columns beyond those of ``documents`` pass through to the stage
before the last; rows with null ids or repeated ids are documents like others; an
empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrank.llm import bpe, lang_id, mixing, pii, setsketch
from docrank.llm.common import store
from docrank.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognized, by a model of the labelled rows;
    ``lang`` becomes the recognized language.  Rejected are texts that are null or
    without a letter; a text of words that no language has stays, with the likeliest
    name."""
    return lang_id.recognized(docs, lang_id.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of five words,
    similarity 0.8 or more): the one with the smallest id."""
    return setsketch.deduplicate(docs, words=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each span of personal data replaced by its kind;
    ``n_chars`` follows the text."""
    found = pii.redact(pii.find_pii(docs, out_col="__pii"), pii_col="__pii").drop("__pii")
    return found.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    rows = mixing.mix(docs, out_col="__mix").where(F.col("__mix.copies") > 0)
    return rows.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__mix.copies")))).drop("__mix", "__copy")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text (unsigned 32-bit, little-endian) and their number, and
    whether the ids decode to the text that the library's rules give back."""
    path = tokenizer_path("word_bpe_49k.json")
    rows = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), path)
    return rows.select("doc_id", "lang", "source", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), "ids",
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mix),
    ("encode", encode),
]

# No stage but the last of personal_data's kind can be told in SQL; the stages are
# tested against plain versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store(docs, f"stage-{name}")
    return docs
