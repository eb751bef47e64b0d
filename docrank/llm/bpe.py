"""Byte-pair encoding and decoding in batched numpy merge rounds.

The words of many texts lie in one flat array of symbols.  In each round the
adjacent pairs of every unfinished word are looked up by binary search in the
sorted pair keys; each word merges its lowest-ranked pair; merged symbols are
squeezed out.  A word whose pairs are all unknown is finished and leaves the
array.  Encoded words are kept in a bounded cache of the worker.

The split into words follows the tokenizer file: its own normalizer and
pre-tokenizer are applied to each white-space separated piece (the vocabulary
drops white space, so pieces are independent), and added tokens inside a piece
are taken out first.

Defined results: a null or empty text gives no ids and decodes to ''; null ids
decode to ''; rows are independent, so repeated rows and null document ids pass
through; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrank.llm.common import Recent, keep_one, text_or_empty
from docrank.llm.token_counts import tokenizer

CACHE_ENTRIES = 200_000   # of each of two generations
STEP_BYTES = 4 << 20      # texts whose words are encoded together
SLICE_ROWS = 500

# The split of the vocabulary file for which the short way below holds
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Pieces of these characters need no composing, and their letters are known
_PLAIN = re.compile("[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")
_LETTER = "a-z\u00df-\u00f6\u00f8-\u017f"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\\t-\\r {_LETTER}0-9]+")
NO_RANK = np.int32(2**31 - 1)


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 stands for itself, the others follow from
    code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


class BpeModel:
    """Merge tables of a ``tokenizers`` BPE file with an end-of-word suffix."""

    def __init__(self, path: str):
        spec = json.loads(open(path, encoding="utf-8").read())
        model, added = spec["model"], spec["added_tokens"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        chars = _byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + suffix] for c in chars], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        a = np.array([vocab[x] for x, _ in pairs], np.int64)
        b = np.array([vocab[y] for _, y in pairs], np.int64)
        made = np.array([vocab[x + y] for x, y in pairs], np.int64)
        rank = np.arange(len(pairs))
        keys = a << 32 | b
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], rank[order].astype(np.int32), made[order]
        # a merge may run at all places of a word at once unless its product
        # takes part in a pair that ranks before it
        first = np.full(max(vocab.values()) + 1, len(pairs))
        np.minimum.at(first, a, rank)
        np.minimum.at(first, b, rank)
        self.at_once = first[self.made] > self.rank
        self.added = {t["content"]: t["id"] for t in added}
        self.added_re = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True)) + ")") if added else None
        n = max([*vocab.values(), *self.added.values()]) + 1
        self.strings = [""] * n
        for s, i in [*vocab.items(), *self.added.items()]:
            self.strings[i] = s
        self.lib = tokenizer(path)
        self.back = {c: b for b, c in enumerate(chars)}
        first = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        self.known_split = first.get("pattern") == {"Regex": SPLIT} and kinds == ["NFC", "Replace", "Lowercase"]
        self.cache = Recent(CACHE_ENTRIES)

    # ---- words ---------------------------------------------------------------
    def plain_words(self, text: str) -> list[str] | None:
        """The words of a piece by the short way, where it holds."""
        if self.known_split and _PLAIN.fullmatch(text) and not (self.added_re and self.added_re.search(text)):
            return _WORDS.findall(text.lower())
        return None

    def other_words(self, text: str) -> list:
        """The words of a piece as byte strings; an added token as its id."""
        out: list = []
        for p in self.added_re.split(text) if self.added_re else [text]:
            if p in self.added:
                out.append(self.added[p])
            elif p:
                norm = self.lib.normalizer.normalize_str(p)
                out += [bytes(self.back[c] for c in w) for w, _ in self.lib.pre_tokenizer.pre_tokenize_str(norm)]
        return out

    # ---- merges --------------------------------------------------------------
    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the (non-empty) words, one after the other, and where each
        word's ids end."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes)
        sym = self.inner[flat]
        sym[ends - 1] = self.last[flat[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        out_sym, out_word = [], []
        while len(sym):
            rank, at = self._ranks(sym, word)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(rank, starts)
            length = np.diff(np.r_[starts, len(sym)])
            done = low == NO_RANK
            over = np.repeat(done, length)
            out_sym.append(sym[over])
            out_word.append(word[over])
            if done.all():
                break
            low_of = np.repeat(low, length)
            hit = (rank == low_of) & (low_of != NO_RANK)
            # leftmost first: of a run of overlapping places every second one
            pos = np.flatnonzero(hit)
            fresh = np.r_[True, (pos[1:] != pos[:-1] + 1) | (word[pos[1:]] != word[pos[:-1]])]
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(pos)), 0))
            keep = (np.arange(len(pos)) - run) % 2 == 0
            # a merge that may uncover a lower rank runs at the first place only
            lead = np.r_[True, word[pos[1:]] != word[pos[:-1]]]
            keep &= self.at_once[at[pos]] | lead
            pos = pos[keep]
            sym[pos] = self.made[at[pos]]
            live = ~over
            live[pos + 1] = False
            sym, word = sym[live], word[live]
        sym, word = np.concatenate(out_sym), np.concatenate(out_word)
        order = np.argsort(word, kind="stable")
        return sym[order].astype("<u4"), np.cumsum(np.bincount(word, minlength=len(words)))

    def _ranks(self, sym, word):
        """Rank of the pair that starts at each symbol, and its place in the
        pair table."""
        key = np.full(len(sym), -1, np.int64)
        if len(sym) > 1:
            same = word[1:] == word[:-1]
            key[:-1] = np.where(same, sym[:-1] << 32 | sym[1:], -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NO_RANK), at

    # ---- texts ---------------------------------------------------------------
    def learn(self, pieces) -> None:
        """Encode pieces and keep them."""
        words, ends, names, mixed = [], [], [], []
        for p in pieces:
            text = p.decode()
            plain = self.plain_words(text)
            if plain is not None:
                words += map(str.encode, plain)
            else:
                ws = self.other_words(text)
                if any(isinstance(w, int) for w in ws):
                    mixed.append((p, ws))
                    continue
                words += ws
            names.append(p)
            ends.append(len(words))
        if words:
            flat, word_ends = self.merge(words)
            raw, at = flat.tobytes(), np.r_[0, word_ends][ends] * 4
            for p, a, b in zip(names, [0, *at.tolist()], at.tolist()):
                self.cache.now[p] = raw[a:b]
        else:
            self.cache.now.update((p, b"") for p in names)
        for p, ws in mixed:
            self.cache.now[p] = b"".join(np.uint32(w).astype("<u4").tobytes() if isinstance(w, int) else self.merge([w])[0].tobytes() for w in ws)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        step: list[list[bytes]] = []
        size = 0
        for t in texts:
            step.append(t.split())
            size += len(t)
            if size >= STEP_BYTES:
                out += self._step(step)
                step, size = [], 0
        return out + self._step(step)

    def _step(self, step: list[list[bytes]]) -> list[bytes]:
        self.learn(self.cache.missing(set().union(*step)))
        return [b"".join(map(self.cache.now.__getitem__, ws)) for ws in step]

    def decode(self, ids: bytes) -> str:
        """The library joins the tokens of a file without a decoder by spaces."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def model(path: str) -> BpeModel:
    return keep_one(("bpe", path), lambda: BpeModel(path))


def encode(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` plus ``out_col``: the token ids of each whole text, as binary
    little-endian unsigned 32-bit integers."""
    @F.arrow_udf("binary")
    def run(text: pa.Array) -> pa.Array:
        return pa.array(model(path).encode(text.cast(pa.binary()).to_pylist()), pa.binary())
    return docs.withColumn(out_col, run(text_or_empty(text_col)))


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` plus ``out_col``: the text of the ids of ``encode``."""
    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        return pa.array([model(path).decode(x or b"") for x in ids.to_pylist()], pa.string())
    return rows.withColumn(out_col, run(F.col(ids_col)))


def round_trip(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids",
               out_col: str = "decoded") -> DataFrame:
    """``docs`` without the text, plus the ids of each text and the text of those ids,
    in one pass (two chained functions would encode twice) and ``SLICE_ROWS`` rows
    at a time, so that a task holds the ids and texts of few documents."""
    kept = [c for c in docs.columns if c != text_col]
    rows = docs.select(*kept, text_or_empty(text_col).alias("__text"))

    def run(batches):
        m = model(path)
        for b in (b.slice(i, SLICE_ROWS) for b in batches for i in range(0, b.num_rows, SLICE_ROWS)):
            ids = m.encode(b.column(len(kept)).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(ids, pa.binary()), pa.array(map(m.decode, ids), pa.string())],
                names=[*kept, ids_col, out_col])

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(ids_col, T.BinaryType()), T.StructField(out_col, T.StringType())])
    return rows.mapInArrow(run, schema)


def encoding_report(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every document."""
    rows = round_trip(docs.select("doc_id", "text"), path)
    return rows.select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
