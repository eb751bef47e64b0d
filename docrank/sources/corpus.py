"""Corpus sources.  Every loader returns ``DataFrame[doc_id, text]`` with
``text`` never null (null -> ``''``).

* ``from_table``          any DataFrame with an id and a text column
* ``read_csv_corpus``     directory of CSV files with a header (RFC 4180 quoting,
                          records may span lines), explicit all-string schema
* ``read_lines_corpus``   one record per physical line, fields split at commas
                          that an even number of double quotes follows
* ``read_files_corpus``   one document per file, id taken from the file name
* ``conversation_corpus`` the turns of a conversation form one document
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrank.sources.csv_split import read_split_csv
from docrank.sources.listing import file_name, list_files, read_whole, url_of


def _fill(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def from_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Project ``(id_col, text_col)`` to ``(doc_id, text)``; null text -> ''."""
    return df.select(F.col(id_col).alias("doc_id"), _fill(F.col(text_col)).alias("text"))


def read_parquet_corpus(spark: SparkSession, path: str, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """Parquet corpus; only the two needed columns reach the scan."""
    return from_table(spark.read.parquet(path), id_col, text_col)


def csv_schema(columns: list[str]) -> T.StructType:
    """All-string schema (the corpus is never type-inferred)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv_corpus(spark: SparkSession, path: str, columns: list[str],
                    id_col: str = "id", text_col: str = "content",
                    strict_arity: bool = False, header: bool = True,
                    multi_line: bool = True, split: bool = False) -> DataFrame:
    """CSV corpus with RFC 4180 quoting: quoted commas and doubled quotes stay
    inside one field.

    ``columns`` names every column of the files in order (all read as string).
    ``strict_arity=True`` drops records whose field count differs from
    ``len(columns)``.

    ``multi_line=True`` also keeps quoted line breaks inside a field, at the price
    of one task per file: store such a corpus as many files, or set ``split=True``, which
    reads a file twice and by many tasks (see ``docrank.sources.csv_split``).
    ``multi_line=False`` reads one record per line and splits large files.
    """
    if multi_line and split:
        return from_table(read_split_csv(spark, path, columns, strict_arity, header), id_col, text_col)
    reader = (spark.read.schema(csv_schema(columns))
              .option("header", str(header).lower())
              .option("multiLine", str(multi_line).lower())
              .option("escape", '"')
              .option("mode", "DROPMALFORMED" if strict_arity else "PERMISSIVE"))
    if strict_arity:
        # the parser checks only the fields it parses; let it parse all
        reader = reader.option("columnPruning", "false")
    return from_table(reader.csv(path), id_col, text_col)


# escape character of ``line_fields``: never left alone in the marked line
_MARK = "\u0001"


def line_fields(line: Column) -> Column:
    """Fields of a CSV line as they stand (quotes included).  A comma separates
    where an even number of quotes follows it; trailing empty fields are
    dropped, as ``String.split`` does.

    One linear pass of array functions: the line is cut at its quotes, and the
    commas of every second piece, counted from the right, are marked."""
    def esc(c: Column, old: str, new: str) -> Column:
        return F.replace(c, F.lit(old), F.lit(new))

    pieces = F.reverse(F.split(esc(line, _MARK, _MARK + "e"), '"', -1))
    marked = F.transform(pieces, lambda p, i: F.when(i % 2 == 0, esc(p, ",", _MARK + "s")).otherwise(p))
    fields = F.transform(F.split(F.array_join(F.reverse(marked), '"'), _MARK + "s", -1),
                         lambda f: esc(f, _MARK + "e", _MARK))
    last = F.array_max(F.transform(fields, lambda f, i: F.when(f != "", i + 1)))
    # a line without any separator is one field, even if it is empty
    return F.slice(fields, 1, F.greatest(F.coalesce(last, F.lit(0)), F.when(F.size(fields) == 1, 1).otherwise(0)))


def unquoted(field: Column) -> Column:
    """A field without its enclosing quotes, doubled quotes undone."""
    inner = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
    return F.when((F.length(field) >= 2) & field.startswith('"') & field.endswith('"'), inner).otherwise(field)


def parse_csv_lines(df: DataFrame, line_col: str, columns: list[str]) -> DataFrame:
    """Quote-aware split of CSV lines held in a column into named, unquoted
    string columns, plus ``n_fields``; fields that a line lacks are null."""
    parsed = df.select(line_fields(F.col(line_col)).alias("fields"))
    return parsed.select(*[unquoted(F.get("fields", F.lit(i))).alias(c) for i, c in enumerate(columns)],
                         F.size("fields").alias("n_fields"))


def read_lines_corpus(spark: SparkSession, path: str, n_fields: int = 10,
                      id_index: int = 0, text_index: int = 9,
                      strict_arity: bool = True, unquote: bool = True) -> DataFrame:
    """Line-oriented CSV: every physical line is one record (a header line and
    the pieces of a record with line breaks too, as in a plain line reader).
    ``strict_arity`` keeps only lines with exactly ``n_fields`` fields.
    ``text_index=-1`` takes the last field of each line, whatever its arity.
    Ids of such pieces may repeat: count them with ``multi_row=True``.
    ``unquote=False`` leaves enclosing and doubled quotes in the fields."""
    parsed = spark.read.text(path).select(line_fields(F.col("value")).alias("fields"))
    parsed = parsed.select("fields", F.size("fields").alias("n_fields"))
    if strict_arity:
        parsed = parsed.where(F.col("n_fields") == n_fields)

    def field(index: int) -> Column:
        f = F.get("fields", F.col("n_fields") + index if index < 0 else F.lit(index))
        return unquoted(f) if unquote else f

    return parsed.select(_fill(field(id_index)).alias("doc_id"), _fill(field(text_index)).alias("text"))


def read_files_corpus(spark: SparkSession, path: str, id_pattern: str = r"^([^.]*)",
                      id_from: str = "file_name") -> DataFrame:
    """One document per file: ``doc_id`` = group 1 of ``id_pattern`` matched
    against the file name (default: up to the first dot, so
    ``2118_9.txt-m-00001`` -> ``2118_9``) or, with ``id_from='file_path'``,
    against the full path; ``text`` = whole file, empty ones too.  Files are listed and
    read on the executors.  Names are URL-encoded, as Spark gives them."""
    texts = read_whole(list_files(spark, path))
    name = url_of(F.col("path"))
    found = name if id_from == "file_path" else file_name(name)
    return texts.select(F.regexp_extract(found, id_pattern, 1).alias("doc_id"), _fill(F.col("text")).alias("text"))


def _listed(spark: SparkSession, file_df: DataFrame) -> DataFrame:
    """``path`` of every file behind a file-source DataFrame, empty ones too (the
    listing that the plan holds on the driver anyway)."""
    return spark.createDataFrame([(p,) for p in file_df.inputFiles()], "path string")


def n_input_files(file_df: DataFrame) -> Column:
    """N as the number of files of a listing (``listing.list_files``), or of the input files
    behind a file-source DataFrame, empty ones included."""
    if file_df.columns == ["path", "length"]:
        return file_df.select(F.count(F.lit(1)).cast("double")).scalar()
    return F.lit(float(len(file_df.inputFiles())))


def count_input_files(file_df: DataFrame) -> DataFrame:
    """One row ``n_files``: input files behind a file-source DataFrame, empty
    ones included (the directory-listing N of the MapReduce flavor)."""
    return _listed(file_df.sparkSession, file_df).agg(F.count(F.lit(1)).alias("n_files"))


def conversation_corpus(conversations: DataFrame) -> DataFrame:
    """Each turn is one row of the document ``conv_id``.  Word statistics over
    it use ``multi_row=True``: turn counts are summed per conversation, so no
    conversation is ever concatenated into one value."""
    return conversations.select(F.col("conv_id").alias("doc_id"), _fill(F.col("text")).alias("text"))


def duplicate_ids(corpus: DataFrame) -> DataFrame:
    """``(doc_id, n_rows)`` for ids that are null or occur more than once."""
    return (corpus.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("doc_id").isNull() | (F.col("n_rows") > 1)))


def check_unique_ids(corpus: DataFrame) -> None:
    """Raise ``ValueError`` when an id is null or repeated (runs one job)."""
    bad = duplicate_ids(corpus).limit(5).collect()
    if bad:
        raise ValueError(f"corpus ids must be unique and non-null; offending ids: {bad}")
