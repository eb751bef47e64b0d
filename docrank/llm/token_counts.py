"""Token counts by a map-side two-tier lookup.

The vocabulary drops white space, so a text's tokens are those of its
white-space separated pieces, one after the other.  Tier one is a compact hash
table of frequent pieces and their token counts, broadcast once; its size is
bounded by ``TABLE_ENTRIES``.  A piece that misses is encoded by the tokenizer
and kept in the worker's own cache (tier two, bounded by ``CACHE_ENTRIES``).
No piece is ever shuffled: only the bounded sample that warms the table is
aggregated.  The table speeds the count up and cannot change it.

Defined results: a null or empty text has 0 bytes and 0 tokens; rows are
independent, so repeated rows and null ids pass through; a text of any length is
counted whole, in time linear in its pieces; an empty table gives an empty result;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import os
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrank.llm.common import Recent, text_or_empty

SAMPLE_ROWS = 4_000       # expected size of the sample that warms the table
TABLE_ENTRIES = 65_536
TABLE_KEY_BYTES = 64      # longer pieces never enter the table
CACHE_ENTRIES = 300_000   # of each of two generations
LIMIT = 2_048

_tokenizers: dict = {}
_caches: dict = {}


def tokenizer(path: str):
    """The worker's own copy of the tokenizer, without truncation or padding."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece
            _tokenizers[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            _tokenizers[path] = t
    return _tokenizers[path]


def token_lengths(path: str, texts: list[str]) -> list[int]:
    t = tokenizer(path)
    if path.endswith(".model"):
        return [len(x) for x in t.encode(texts, num_threads=1)]
    return [len(x.ids) for x in t.encode_batch_fast(texts, add_special_tokens=False)]


def frequent_pieces(docs: DataFrame, path: str, text_col: str = "text",
                    sample_rows: int = SAMPLE_ROWS, entries: int = TABLE_ENTRIES) -> dict[bytes, int]:
    """``{piece: tokens}`` of the most frequent pieces of a random sample of
    about ``sample_rows`` documents; at most ``entries`` of at most
    ``TABLE_KEY_BYTES`` bytes each."""
    n = docs.count()
    if n == 0:
        return {}

    def count(batches):
        seen = Counter()
        for b in batches:
            for t in b.column(0).cast(pa.binary()).to_pylist():
                seen.update(t.split())
        kept = [(w, c) for w, c in seen.items() if len(w) <= TABLE_KEY_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.binary()),
                                          pa.array([c for _, c in kept], pa.int64())], names=["piece", "n"])

    sample = docs.select(text_or_empty(text_col).alias("text")).sample(min(1.0, sample_rows / n), seed=7)
    top = (sample.mapInArrow(count, "piece binary, n long").groupBy("piece").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "piece").limit(entries).select("piece").collect())
    pieces = [bytes(r.piece) for r in top]
    return dict(zip(pieces, token_lengths(path, [p.decode() for p in pieces]))) if pieces else {}


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "n_tokens",
                 sample_rows: int = SAMPLE_ROWS, entries: int = TABLE_ENTRIES) -> DataFrame:
    """``docs`` plus ``out_col``: tokens of each whole text.

    A ``.model`` file (sentencepiece) keeps white space, so there the piece is
    the whole text and only the tokenizer itself counts."""
    if path.endswith(".model"):
        @F.arrow_udf("long")
        def whole(text: pa.Array) -> pa.Array:
            return pa.array(token_lengths(path, text.to_pylist()), pa.int64())
        return docs.withColumn(out_col, whole(text_or_empty(text_col)))

    table = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, path, text_col, sample_rows, entries))

    @F.arrow_udf("long")
    def count(text: pa.Array) -> pa.Array:
        first, cache = table.value, _caches.setdefault(path, Recent(CACHE_ENTRIES))
        out = []
        for t in text.cast(pa.binary()).to_pylist():
            seen = Counter(t.split())
            # (keys() - keys() would walk the whole broadcast table for every text)
            new = list(cache.missing({w for w in seen if w not in first}))
            cache.now.update(zip(new, token_lengths(path, [w.decode() for w in new])))
            out.append(sum(c * (first[w] if w in first else cache.now[w]) for w, c in seen.items()))
        return pa.array(out, pa.int64())

    return docs.withColumn(out_col, count(text_or_empty(text_col)))


def token_report(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every document."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return count_tokens(rows, path).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"))
