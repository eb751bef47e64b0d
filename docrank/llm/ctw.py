"""Language-model scores by context-tree weighting over bytes.

The text (A-Z lower-cased) is a sequence of bytes followed by an end byte
``0xFF``, which never occurs in UTF-8.  A byte is eight binary decisions; each of
the 255 decision nodes has a context tree of its own.  The first 16 levels of a
tree split by single bits: the class of the byte before (6 bits), of the second
(5 bits) and of the third (5 bits).  The next levels split by the real bytes: the
three bytes before, then the fourth and the fifth.  Each tree node holds
the zeros and ones seen below it and their Krichevsky-Trofimov block probability
Pe; the weighted probability is Pw = 1/2 Pe + 1/2 of the product of the children's
Pw, and Pe at the last level.  A decision's probability mixes the KT estimates of
all levels of its context path, each by its posterior weight 1/2 Pe / Pw.

The counts come from every training text: each seen string of six bytes (context
and byte) with its count is a row of a stored table, which grows with the corpus.
The part of a tree below three real bytes is built by a task from the rows of these
three bytes.  Only the first 16 levels are bounded (2^16 contexts): the driver mixes
those of their contexts and nodes that occur, and broadcasts them to the tasks that
price strings.  The ``HOT_GRAMS`` most
frequent strings are broadcast with their log10 P and looked up by hash; those of a text
that miss them leave it once each, with their count, and are priced apart and joined.

Beside it stands the add-one unigram base over words.  Word counts cover all
training texts and stay in a table; only the ``HOT_WORDS`` most frequent are
broadcast, and the words that miss them are joined with the table.

Defined results: a null or empty text holds the end token and the end byte only;
without training texts all counts are 0 and every bit costs one bit; rows that
repeat an id are documents of their own, a null id counts as ''; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrank.llm.common import by_group, crc_mod, store, text_or_empty

BITS = 16
END_BYTE = 0xFF
END_WORD = b"\n"          # no word holds white space
HOT_WORDS = 200_000
FLUSH_WORDS = 500_000
HOT_GRAMS = 1_000_000
FLUSH_GRAMS = 2_000_000
GROUP_ROWS = 65_536
STEP_BYTES = 1 << 20      # a step's arrays hold about 50 bytes for each of text
FIRST, LAST = 3, 5        # bytes of context of the first and of the last level of real bytes


# ---- contexts --------------------------------------------------------------------
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of each byte in 6 and in 5 bits: letters, space, other white space,
    digits, sentence ends, other punctuation; the rest shares one class, or 32
    classes by its low bits."""
    five = np.full(256, 31, np.uint32)
    for b in range(33, 127):
        five[b] = 30
    for i in range(26):
        five[ord("a") + i] = five[ord("A") + i] = i
    five[32] = 26
    five[[9, 10, 11, 12, 13]] = 27
    five[ord("0"):ord("9") + 1] = 28
    five[[ord(c) for c in ".!?"]] = 29
    six = five.copy()
    six[128:] = 32 + (np.arange(128, 256) & 31)
    return six, five


SIX, FIVE = _classes()
C1, C2, C3 = SIX << np.uint32(18), FIVE << np.uint32(13), FIVE << np.uint32(8)


def grams(texts: list[bytes]):
    """``(first, last, grams, starts)`` for runs of texts: for every byte and end byte the
    ``LAST`` bytes before it, the nearest one highest, and the byte itself as the low
    one, and where each text's grams start."""
    pad, i = bytes([END_BYTE]) * LAST, 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) < STEP_BYTES):
            size += len(texts[j])
            j += 1
        # each text is led by ``LAST`` end bytes; the first of the next one's is its end
        raw = np.frombuffer(pad + b"".join(t + pad for t in texts[i:j]), np.uint8)
        sizes = np.fromiter((len(t) + LAST for t in texts[i:j]), np.int64, j - i)
        n = len(raw) - LAST
        gram = np.zeros(n, np.int64)
        for at in [*range(LAST - 1, -1, -1), LAST]:
            gram <<= 8
            gram |= raw[at:at + n]
        keep, ends = np.ones(n, bool), np.cumsum(sizes)
        for k in range(1, LAST):
            keep[ends - k] = False   # the other end bytes
        starts = np.r_[0, ends[:-1]] - (LAST - 1) * np.arange(j - i)
        yield i, j, gram[keep], starts
        i = j


def cells_of(gram: np.ndarray) -> np.ndarray:
    """The cell of a gram: the classes of three bytes, and the low byte."""
    near, second, third = ((gram >> 8 * (LAST - k)) & 255 for k in range(3))
    return C1[near] | C2[second] | C3[third] | (gram & 255).astype(np.uint32)


# ---- model -----------------------------------------------------------------------
def _lgamma(z: np.ndarray) -> np.ndarray:
    """log Gamma for z >= 0.5 (Stirling's series after a shift by eight)."""
    shift = np.ones_like(z)
    for k in range(8):
        shift *= z + k
    y = z + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(shift)


def _kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log KT block probability of counts."""
    out = np.zeros(n0.shape)
    m = (n0 + n1) > 0
    a, b = n0[m], n1[m]
    out[m] = _lgamma(a + 0.5) + _lgamma(b + 0.5) - 2 * math.lgamma(0.5) - _lgamma(a + b + 1)
    return out


# ---- levels of real bytes ----------------------------------------------------------
HALF = np.array([math.lgamma(i + 0.5) - math.lgamma(0.5) for i in range(4096)])
WHOLE = np.array([math.lgamma(i + 1) for i in range(4096)])


def _kt_sparse(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """``_kt`` where most counts are small."""
    out, small = np.empty(len(n0)), n0 + n1 < len(HALF)
    a, b = n0[small].astype(np.int64), n1[small].astype(np.int64)
    out[small] = HALF[a] + HALF[b] - WHOLE[a + b]
    out[~small] = _kt(n0[~small], n1[~small])
    return out


def _sums(key: np.ndarray, *values: np.ndarray) -> tuple:
    """Sorted distinct keys and the sums of the values by key."""
    keys, at = np.unique(key, return_inverse=True)
    return keys, *(np.bincount(at, v, len(keys)) for v in values)


def _at(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key among sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return at, keys[at] == key


def _node(byte: np.ndarray, bit: int) -> np.ndarray:
    return (1 << bit) | (byte >> (8 - bit))


def deep_levels(gram: np.ndarray, n: np.ndarray) -> list:
    """``(keys, n0, n1, Pe, Pw)`` by bytes of context, the fewest first, over the
    contexts and nodes that occur; a key is the context and, as the low byte, the
    node.  The grams hold all of a context of ``FIRST`` bytes or nothing of it."""
    out: list = []
    for size in range(LAST, FIRST - 1, -1):
        context = gram >> 8 * (LAST + 1 - size)
        cell, count = _sums((context << 8) | (gram & 255), n)
        byte, found = cell & 255, []
        for bit in range(8):       # cells are sorted, so are the nodes of a bit
            key = (cell & ~255) | _node(byte, bit)
            new = np.flatnonzero(np.diff(key, prepend=-1))
            ones = np.add.reduceat(count * ((byte >> (7 - bit)) & 1), new)
            found.append((key[new], np.add.reduceat(count, new) - ones, ones))
        keys, n0, n1 = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(keys, kind="stable")
        keys, n0, n1 = keys[order], n0[order], n1[order]
        e = w = _kt_sparse(n0, n1)
        if out:
            child, weighted = out[0][0], out[0][4]
            at, _ = _at(keys, ((child >> 16) << 8) | (child & 255))
            w = np.logaddexp(e, np.bincount(at, weighted, len(keys))) - math.log(2)
        out.insert(0, (keys, n0, n1, e, w))
    return out


def mix_classes(cells: np.ndarray, counts: np.ndarray, below: np.ndarray) -> list:
    """``(keys, done, rest)`` after each of the levels of classes, the deepest first,
    over the contexts and nodes that occur; a key is the context and, as the low
    byte, the node.  ``cells`` are both the cells that were counted and the keys whose
    children have the log product ``below``."""
    cells = cells.astype(np.int64)
    key, one, many = [], [], []
    for bit in range(8):
        at = counts > 0
        byte = cells[at] & 255
        key.append((cells[at] & ~255) | _node(byte, bit))
        one.append((byte >> (7 - bit)) & 1)
        many.append(counts[at])
    one, many = np.concatenate(one), np.concatenate(many)
    keys, n0, n1 = _sums(np.concatenate(key), many * (1 - one), many * one)
    at, here = _at(keys, cells)
    levels: list = []
    product = np.bincount(at[here], below[here], len(keys))
    for depth in range(BITS, -1, -1):
        e = _kt_sparse(n0, n1)
        w = np.logaddexp(e, product) - math.log(2)
        levels.append((keys, n0, n1, e, w))
        if depth:
            keys, n0, n1, product = _sums(((keys >> 9) << 8) | (keys & 255), n0, n1, w)
    out: list = []
    for i in range(BITS, -1, -1):
        keys, n0, n1, e, w = levels[i]
        if not out:
            done, rest = np.zeros(len(keys)), np.ones(len(keys))
        else:
            at, _ = _at(out[0][0], ((keys >> 9) << 8) | (keys & 255))
            done, rest = out[0][1][at], out[0][2][at]
        share = np.exp(e - math.log(2) - w)
        out.insert(0, (keys, done + rest * share * (n1 + 0.5) / (n0 + n1 + 1), rest * (1 - share)))
    return out


def price(classes: list, levels: list, gram: np.ndarray) -> np.ndarray:
    """log10 P of the byte of each gram after its context."""
    byte, total = gram & 255, np.zeros(len(gram))
    context = cells_of(gram).astype(np.int64) >> 8
    for bit in range(8):
        node = _node(byte, bit)
        done, rest, left = np.zeros(len(gram)), np.ones(len(gram)), np.arange(len(gram))
        for up, (keys, d, r) in enumerate(classes):      # the deepest level that was seen
            at, seen = _at(keys, ((context[left] >> up) << 8) | node[left])
            done[left[seen]], rest[left[seen]] = d[at[seen]], r[at[seen]]
            left = left[~seen]
            if not len(left):
                break
        for size, (keys, n0, n1, e, w) in enumerate(levels, FIRST):
            at, seen = _at(keys, ((gram >> 8 * (LAST + 1 - size)) << 8) | node)
            at = at[seen]
            share = np.ones(len(at)) if size == LAST else np.exp(e[at] - math.log(2) - w[at])
            done[seen] += rest[seen] * share * (n1[at] + 0.5) / (n0[at] + n1[at] + 1)
            rest[seen] *= 1 - share
        p1 = np.clip(done + rest / 2, 1e-12, 1 - 1e-12)   # a half below what was seen
        total += np.log10(np.where((byte >> (7 - bit)) & 1, p1, 1 - p1))
    return total


class Lookup:
    """Values of distinct non-negative keys in an open-addressing hash table, for many
    keys at once: a key that finds its place taken goes to the next one."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.full((1 << self.bits) + 1, -1, np.int64)
        self.values = np.zeros(len(self.keys))
        place, left = self._place(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[place[left]] < 0]
            self.keys[place[free]] = keys[free]          # the last of those that share a place stays
            mine = self.keys[place[left]] == keys[left]
            self.values[place[left[mine]]] = values[left[mine]]
            left = left[~mine]
            place[left] = (place[left] + 1) & ((1 << self.bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each key (0 where it is not held), and whether it is held."""
        place = self._place(keys)
        held = self.keys[place]
        known, out = held == keys, self.values[place]
        left = np.flatnonzero(~known)
        out[left] = 0.0
        left = left[held[left] >= 0]
        while len(left):
            place[left] = (place[left] + 1) & ((1 << self.bits) - 1)
            held = self.keys[place[left]]
            hit = held == keys[left]
            known[left[hit]] = True
            out[left[hit]] = self.values[place[left[hit]]]
            left = left[~hit & (held >= 0)]
        return out, known


_lookups: dict = {}


# ---- jobs ------------------------------------------------------------------------
def _top() -> Column:
    return F.shiftright("gram", 8 * (LAST + 1 - FIRST)).alias("top")


def _merge(held: list) -> tuple[np.ndarray, np.ndarray]:
    gram, n = _sums(np.concatenate([g for g, _ in held]), np.concatenate([n for _, n in held]))
    return gram, n.astype(np.int64)


def count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, gram, n`` over all texts: each word (and the end) with its count, and
    each gram with its count."""
    schema = pa.schema([("word", pa.binary()), ("gram", pa.int64()), ("n", pa.int64())])

    def of_words(words):
        return pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()), pa.nulls(len(words), pa.int64()),
                                           pa.array(list(words.values()), pa.int64())], schema=schema)

    def of_grams(gram, n):
        for i in range(0, len(gram), GROUP_ROWS):
            part = pa.array(gram[i:i + GROUP_ROWS])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(part), pa.binary()), part, pa.array(n[i:i + GROUP_ROWS])], schema=schema)

    def run(batches):
        words: Counter = Counter()
        held: list = []
        for b in batches:
            texts = [t.lower() for t in b.column(0).cast(pa.binary()).to_pylist()]
            words[END_WORD] += len(texts)
            for t in texts:
                words.update(t.split())
                if len(words) > FLUSH_WORDS:
                    yield of_words(words)
                    words = Counter()
            for _, _, gram, _ in grams(texts):
                held.append(np.unique(gram, return_counts=True))
                if sum(len(g) for g, _ in held) > FLUSH_GRAMS:
                    held = [_merge(held)]
                    if len(held[0][0]) > FLUSH_GRAMS // 2:
                        yield from of_grams(*held.pop())
        yield of_words(words)
        if held:
            yield from of_grams(*_merge(held))

    got = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(run, "word binary, gram long, n long")
    return got.groupBy("word", "gram").agg(F.sum("n").alias("n"))


def _hottest(counts: DataFrame, limit: int):
    """At most about ``limit`` rows of the largest counts, and the sums of counts and rows."""
    # rows by size, to choose the least count of a hot one (at most 64 * 16 rows)
    size = F.floor(F.log2("n") * 16)
    by = counts.groupBy(size.alias("size")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    held, least = 0, 64 * 16
    for r in sorted(by, key=lambda r: -r["size"]):
        held += r.rows
        if held > limit:
            break
        least = r["size"]
    return counts.where(size >= least), sum(r.n for r in by), sum(r.rows for r in by)


def fit(docs: DataFrame, text_col: str = "text", hot_words: int = HOT_WORDS) -> dict:
    """Count the training texts; returns the table of grams, the mixed levels of
    classes and the priced hot grams, the word table and its hot part, and the totals."""
    counts = store(count(docs, text_col), "ctw-counts")
    words = counts.where(F.col("word").isNotNull() & (F.col("n") > 0)).select("word", "n")
    seen = counts.where(F.col("gram").isNotNull()).select("gram", "n")
    hot, total, different = _hottest(words, hot_words)
    hot = hot.toArrow()

    def weigh(t: pa.Table) -> pa.Table:
        gram, n = t.column("gram").to_numpy(), t.column("n").to_numpy()
        keys, _, _, _, w = deep_levels(gram, n)[0]
        cell, below = _sums(cells_of((keys >> 8 << 8 * (LAST + 1 - FIRST)) | (keys & 255)), w)
        at, n = _sums(cells_of(gram), n)
        return pa.table({"cell": pa.array(np.r_[cell, at].astype(np.int32)),
                         "below": pa.array(np.r_[below, np.zeros(len(at))]),
                         "n": pa.array(np.r_[np.zeros(len(cell)), n].astype(np.int64))})

    weighed = by_group(seen.select(_top(), "gram", "n"), ["top"], weigh, "cell int, below double, n long", GROUP_ROWS)
    weighed = weighed.groupBy("cell").agg(F.sum("below").alias("below"), F.sum("n").alias("n")).toArrow()
    classes = mix_classes(*(weighed.column(c).to_numpy() for c in ("cell", "n", "below")))
    levels = docs.sparkSession.sparkContext.broadcast(classes)
    first, _, _ = _hottest(seen, HOT_GRAMS)
    priced = price_grams(first.select("gram"), seen, levels).toArrow().sort_by("gram")
    return {
        "grams": seen, "levels": levels, "hot_grams": (priced.column("gram").to_numpy(), priced.column("p").to_numpy()),
        "words": words, "hot": dict(zip(hot.column("word").to_pylist(), hot.column("n").to_pylist())),
        "whole": different == hot.num_rows, "N": total, "V": different}


def price_grams(asked: DataFrame, seen: DataFrame, levels) -> DataFrame:
    """``gram, p``: log10 P of each asked gram (distinct)."""
    asked = asked.select(_top(), "gram", F.lit(None).cast("long").alias("n"))
    rows = seen.select(_top(), "gram", "n").unionByName(asked)

    def run(t: pa.Table) -> pa.Table:
        ask = t.column("n").is_null().to_numpy()
        gram, n, top = t.column("gram").to_numpy(), t.column("n").fill_null(0).to_numpy(), t.column("top").to_numpy()
        here = ~ask & np.isin(top, np.unique(top[ask]))
        p = price(levels.value, deep_levels(gram[here], n[here]), gram[ask])
        return pa.table({"gram": pa.array(gram[ask]), "p": pa.array(p)})

    return by_group(rows, ["top"], run, "gram long, p double", GROUP_ROWS)


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, plus ``n_tokens``, ``n_known``, ``base_score``, ``score`` and
    ``bits_per_byte`` (code length, the end byte included)."""
    sc = docs.sparkSession.sparkContext
    table, hot, whole, key = sc.broadcast(model["hot_grams"]), sc.broadcast(model["hot"]), model["whole"], uuid.uuid4().hex
    made = ("n_tokens long, known long, logs double, score double, n_bytes long, tail array<struct<word:binary,n:long>>, "
            "cold array<struct<gram:long,n:long>>")

    @F.arrow_udf(made)
    def run(text: pa.Array) -> pa.Array:
        if key not in _lookups:      # a worker keeps the table of one model
            _lookups.clear()
            _lookups[key] = Lookup(*table.value)
        texts = [t.lower() for t in text.cast(pa.binary()).to_pylist()]
        scores, cold = np.empty(len(texts)), [np.empty((0, 3), np.int64)]
        for i, j, gram, starts in grams(texts):
            p, known = _lookups[key](gram)
            scores[i:j] = np.add.reduceat(p, starts)
            at = np.flatnonzero(~known)
            if len(at):              # each string once per text, with its count
                owner = np.searchsorted(starts, at, "right") - 1 + i
                order = np.lexsort((gram[at], owner))
                owner, missed = owner[order], gram[at][order]
                new = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(missed, prepend=-1) != 0))
                cold.append(np.stack([owner[new], missed[new], np.diff(np.r_[new, len(owner)])], axis=1))
        cold = np.concatenate(cold)
        ends = np.searchsorted(cold[:, 0], np.arange(len(texts) + 1)).astype(np.int32)
        cold = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
            [pa.array(np.ascontiguousarray(cold[:, 1])), pa.array(np.ascontiguousarray(cold[:, 2]))], names=["gram", "n"]))
        get, out = hot.value.get, []
        for t in texts:
            seen = Counter(t.split())
            seen[END_WORD] = 1
            known, logs, tail = 0, 0.0, []
            for w, n in seen.items():
                c = get(w)
                if c is None:
                    if not whole:
                        tail.append({"word": w, "n": n})
                else:
                    known += n
                    logs += n * math.log10(c + 1)
            out.append((seen.total(), known, logs, len(t) + 1, tail))
        tail_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
             pa.array([x[2] for x in out], pa.float64()), pa.array(scores), pa.array([x[3] for x in out], pa.int64()),
             pa.array([x[4] for x in out], tail_type), cold], names=["n_tokens", "known", "logs", "score", "n_bytes", "tail", "cold"])

    own = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*own).alias("row"), run(text_or_empty(text_col)).alias("m"),
                       F.monotonically_increasing_id().alias("rid"))
    rows = store(rows, "ctw-scores")
    tail = rows.select("rid", F.explode("m.tail").alias("t")).select("rid", "t.word", "t.n")
    counts = model["words"].withColumnRenamed("n", "c")
    more = tail.join(counts, "word").groupBy("rid").agg(
        F.sum("n").alias("tail_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("tail_logs"))
    # grams that miss the hot ones, seen in training or not, are priced once each
    cold = rows.select("rid", F.inline("m.cold"))
    priced = price_grams(cold.select("gram").distinct(), model["grams"], model["levels"])
    rest = cold.join(priced, "gram").groupBy("rid").agg(F.sum(F.col("p") * F.col("n")).alias("cold_score"))
    out = rows.join(more, "rid", "left").join(rest, "rid", "left").withColumn(
        "score", F.col("m.score") + F.coalesce("cold_score", F.lit(0.0)))
    known = F.col("m.known") + F.coalesce("tail_known", F.lit(0))
    base = (F.col("m.logs") + F.coalesce("tail_logs", F.lit(0.0))
            - F.col("m.n_tokens") * F.lit(math.log10(model["N"] + model["V"] + 1)))
    return out.select("row.*", "m.n_tokens", known.alias("n_known"), F.lit(model["N"]).cast("long").alias("train_tokens"),
                      base.alias("base_score"), "score",
                      (-F.col("score") * F.lit(math.log2(10)) / F.col("m.n_bytes")).alias("bits_per_byte"))


def held_out(id_col: str = "doc_id") -> Column:
    return crc_mod(id_col, 7) == 2


def score_report(docs: DataFrame) -> DataFrame:
    """Scores of every document by a model of the documents that are not held out."""
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return score(rows, fit(rows.where(~F.col("held_out"))))
