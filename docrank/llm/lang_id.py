"""Language identification by word-first backoff.

Model: for each language the log relative frequency of its words, and of the
character n-grams (length ``MAX_N`` down to 1, word ends marked) of its words.
A known word adds its log frequency in each language.  An unseen word backs off
to the longest n-gram length of which the model knows any of the word's
n-grams: it adds their mean log frequency, less ``BACKOFF`` for each step
down.  The language with the largest total wins (ties: the smaller name).

The model is fitted on a bounded sample of labelled rows: about ``FIT_ROWS`` rows of
each language, chosen by a hash of the id and the text, so a rare language is learned
like a common one.  It holds the ``MAX_WORDS`` most frequent words and ``MAX_GRAMS``
most frequent n-grams of each length and language, so the broadcast is bounded.

Defined results: ``und`` with score 0 for a text that is null or without a
letter, and for every text if there is nothing to learn from; rows are
independent, so repeated rows and null ids pass through; a text of any length is
scored whole, some words at a time; an empty table gives an empty result.  The score is the winner's share of the languages' geometric
mean likelihoods per word, between 0 and 1.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrank.llm.common import crc_mod, keep_one, text_or_empty

FIT_ROWS = 10_000         # of each language
MAX_WORDS = 30_000
MAX_GRAMS = 10_000        # of each length
MAX_N = 5
BACKOFF = 0.5
UNSEEN = 0.5              # count of what a language has not seen
CACHE_ENTRIES = 200_000
SLICE_ROWS = 500          # rows that a task holds at a time
UND = "und"

LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    w = f" {word} " if n > 1 else word
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        fit_rows: int = FIT_ROWS) -> dict:
    """Model of the labelled rows (null texts and labels are left out): see ``build``."""
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    per = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}   # one row per language
    if not per:
        return build([], {})
    share = F.create_map(*[x for lang, n in sorted(per.items()) for x in (F.lit(lang), F.lit(min(1.0, fit_rows / n)))])
    rows = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)

    def count(batches):
        for b in slices(batches):
            seen: dict = {}
            for t, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                seen.setdefault(lang, Counter()).update(words_of(t))
            out = [(lang, w, c) for lang, ws in seen.items() for w, c in ws.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))],
                names=["lang", "word", "n"])

    def grams(batches):
        for b in slices(batches, 4 * SLICE_ROWS):
            seen: Counter = Counter()
            for lang, w, c in zip(*(b.column(k).to_pylist() for k in ("lang", "word", "n"))):
                seen[lang, 0, w] += c
                for size in range(1, MAX_N + 1):
                    for g in grams_of(w, size):
                        seen[lang, size, g] += c
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.int32()),
                 pa.array([k[2] for k in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
                names=["lang", "size", "gram", "n"])

    words = rows.select("text", "lang").mapInArrow(count, "lang string, word string, n long")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    freq = words.mapInArrow(grams, "lang string, size int, gram string, n long")
    freq = freq.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")).persist()
    try:
        # the smallest count to keep, from the number of entries by count
        by_count = freq.groupBy("lang", "size", "n").agg(F.count(F.lit(1)).alias("m")).collect()
        total: dict = {}
        for r in by_count:
            total[r["size"], r.lang] = total.get((r["size"], r.lang), 0) + r.n * r.m
        keep = F.lit(False)
        for size, lang in total:
            least = _least(sorted(((r.n, r.m) for r in by_count if (r["size"], r.lang) == (size, lang)), reverse=True),
                           MAX_GRAMS if size else MAX_WORDS)
            keep = keep | ((F.col("size") == size) & (F.col("lang") == lang) & (F.col("n") >= least))
        top = freq.where(keep).collect()
    finally:
        freq.unpersist()
    return build(top, total)


def _least(by_count: list[tuple[int, int]], most: int) -> int:
    """The smallest count such that at most ``most`` entries reach it."""
    held, least = 0, by_count[0][0] + 1
    for n, m in by_count:
        held += m
        if held > most:
            break
        least = n
    return least


def build(top, total: dict) -> dict:
    """``{"langs": names, "rows": [{entry: row} by size, words at 0], "table": log
    frequencies}``, one row of the table per kept word or n-gram, one column per
    language."""
    langs = sorted({lang for _, lang in total})
    at = {x: i for i, x in enumerate(langs)}
    rows: list[dict] = [{} for _ in range(MAX_N + 1)]
    entries = {}
    for r in top:
        entries.setdefault((r["size"], r["gram"]), len(entries))
    base = np.log(np.array([[total.get((size, x), 0) for x in langs] for size in range(MAX_N + 1)], float).reshape(MAX_N + 1, len(langs)) + 1.0)
    table = np.full((len(entries), len(langs)), UNSEEN)
    for r in top:
        table[entries[r["size"], r["gram"]], at[r["lang"]]] = r["n"]
    np.log(table, out=table)
    for (size, gram), i in entries.items():
        rows[size][gram] = i
        table[i] -= base[size]
    return {"langs": langs, "rows": rows, "table": table}


def word_score(m: dict, word: str) -> np.ndarray:
    """Log score of a word in each language."""
    table, (words, *grams) = m["table"], m["rows"]
    if word in words:
        return table[words[word]]
    for n in range(MAX_N, 0, -1):
        known = [grams[n - 1][g] for g in grams_of(word, n) if g in grams[n - 1]]
        if known:
            return table[known].mean(axis=0) - BACKOFF * (MAX_N + 1 - n)
    return np.zeros(len(m["langs"]))


def slices(batches, rows: int = SLICE_ROWS):
    return (b.slice(i, rows) for b in batches for i in range(0, b.num_rows, rows))


class Scorer:
    """Scores of words by row of a bounded table, filled as words come up."""

    def __init__(self, m: dict):
        self.m, self.at = m, {}
        self.table = np.zeros((CACHE_ENTRIES, max(1, len(m["langs"]))), np.float64)

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        if not words or not self.m["langs"]:
            return UND, 0.0
        total = np.zeros(len(self.m["langs"]))
        for i in range(0, len(words), CACHE_ENTRIES // 2):
            total += self._sum(words[i:i + CACHE_ENTRIES // 2])
        p = np.exp((total - total.max()) / len(words))
        best = int(np.argmax(total))
        return self.m["langs"][best], float(p[best] / p.sum())

    def _sum(self, words: list[str]) -> np.ndarray:
        new = set(words).difference(self.at)
        if len(self.at) + len(new) > CACHE_ENTRIES:
            self.at.clear()
            new = set(words)
        for w in sorted(new):
            self.table[len(self.at)] = word_score(self.m, w)
            self.at[w] = len(self.at)
        return self.table[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))].sum(axis=0)


def scorer_of(model, key: str) -> Scorer:
    """The worker's scorer of a broadcast model; it keeps one at a time."""
    return keep_one(("lang", key), lambda: Scorer(model.value))


def predict(docs: DataFrame, m: dict, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` plus a struct ``out_col`` (``lang_pred``, ``score``); only the text is an
    input."""
    model, key = docs.sparkSession.sparkContext.broadcast(m), uuid.uuid4().hex

    @F.arrow_udf("lang_pred string, score double")
    def run(text: pa.Array) -> pa.Array:
        scorer, got = scorer_of(model, key), []
        for i in range(0, len(text), SLICE_ROWS):
            got += map(scorer, text.slice(i, SLICE_ROWS).to_pylist())
        return pa.StructArray.from_arrays([pa.array([x for x, _ in got], pa.string()),
                                           pa.array([x for _, x in got], pa.float64())], names=["lang_pred", "score"])
    return docs.withColumn(out_col, run(text_or_empty(text_col)))


def recognized(docs: DataFrame, m: dict, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is recognized, with ``lang_col`` set to it;
    rows that get ``und`` are left out.  Every text is scored once: the decision and the
    label leave the same pass."""
    model, key = docs.sparkSession.sparkContext.broadcast(m), uuid.uuid4().hex
    at, text_at = docs.columns.index(lang_col), docs.columns.index(text_col)

    def run(batches):
        for b in slices(batches):
            found = [x for x, _ in map(scorer_of(model, key), b.column(text_at).cast(pa.string()).to_pylist())]
            out = b.set_column(at, b.schema.field(at).name, pa.array(found, pa.string()))
            kept = out.filter(pa.array([x != UND for x in found], pa.bool_()))
            if kept.num_rows:
                yield kept
    schema = T.StructType([T.StructField(f.name, T.StringType() if i == at else f.dataType) for i, f in enumerate(docs.schema)])
    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    return crc_mod(id_col, 3) == 1


def language_report(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document; learns only
    from the rows that are not held out."""
    rows = docs.select("doc_id", "text", "lang")
    m = fit(rows.where(~held_out()))
    return predict(rows.select("doc_id", "text"), m).select(
        "doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")
