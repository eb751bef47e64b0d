"""What document filters take from each other: counts of every order of five filters.

Which filters a document fails does not depend on the order they run in, so the whole
audit follows from additive counts of failure masks: one count per (part, mask,
quality, toxic), whatever the number of documents.  From them come the documents
removed, kept and lost at each step of each order, and each filter's sum over all
orders.

The repeat filter is table-wide.  A counting Bloom filter runs before it: every task
counts its texts' slots (up to two), sketches are merged by block of slots, and a text
with a slot of count one is surely unique.  Only the other texts are shuffled, grouped
by the whole text for the smallest id; a document fails if its id is not the smallest.
The sketch has ``SLOTS_PER_ROW`` slots a row up to ``MAX_SLOTS``, so what is broadcast is
at most ``MAX_SLOTS / 8`` bytes; beyond that more texts count as possible repeats and
are shuffled, and the result stays the same.

Defined results: a null text is an empty one; a null ``lang`` belongs to the part '';
a null id is neither smaller nor larger than another, so its row never fails the
repeat filter; rows that repeat an id and a text do not make each other fail; labels
that repeat an id count once (good or toxic if any row says so), and documents without
a label are neither; texts of any length are read whole; an empty table gives an empty
result; columns other than the named ones are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrank.llm.common import store, text_or_empty

SLOTS_PER_ROW = 8
MAX_SLOTS = 1 << 28
BLOCK = 1 << 14            # slots that are merged together
HASHES = 3
STEP_ROWS = 1 << 20        # rows that a task sketches at a time

LETTERS = "ABCDE"
REPEAT = 4                 # bit of the repeat filter
SPACE = r"[\x20\x09-\x0D]+"
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


# ---- the sketch ------------------------------------------------------------------
def slots_of(hashes: np.ndarray, slots: int) -> np.ndarray:
    """``HASHES`` slots of each 64-bit hash (``slots`` is a power of two)."""
    shift = np.uint64(64 - (slots.bit_length() - 1))
    h = hashes.view(np.uint64)
    return np.stack([(h * np.uint64(m)) >> shift for m in _MULTIPLIERS]).astype(np.int64)


def n_slots(rows: int) -> int:
    return min(MAX_SLOTS, max(BLOCK, 1 << max(1, SLOTS_PER_ROW * rows - 1).bit_length()))


def repeat_sketch(hashes: DataFrame, slots: int, times: int = 2) -> np.ndarray:
    """One bit per slot: whether ``times`` (1 or 2) or more of the ``hash`` rows fall into it."""
    def sketch(batches):
        held, size = [], 0
        for b in batches:
            held.append(b.column(0).to_numpy())
            size += b.num_rows
            if size >= STEP_ROWS:
                yield _blocks(np.concatenate(held), slots)
                held, size = [], 0
        if size:
            yield _blocks(np.concatenate(held), slots)

    def merge(batches):
        block, count = None, np.zeros(BLOCK, np.uint8)
        for b in batches:
            for at, ones, more in zip(*(b.column(c).to_pylist() for c in ("block", "ones", "more"))):
                if at != block:
                    yield from _bits(block, count, times)
                    block, count = at, np.zeros(BLOCK, np.uint8)
                once = np.frombuffer(ones, np.uint16)
                count[once] = np.minimum(count[once] + 1, 2)
                count[np.frombuffer(more, np.uint16)] = 2
        yield from _bits(block, count, times)

    parts = hashes.mapInArrow(sketch, "block int, ones binary, more binary")
    merged = parts.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block int, bits binary")
    out = np.zeros(slots // 8, np.uint8)
    for r in merged.collect():   # at most slots / 8 bytes in all
        out[r.block * BLOCK // 8:(r.block + 1) * BLOCK // 8] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def _blocks(hashes: np.ndarray, slots: int) -> pa.RecordBatch:
    """Slots that occur once and more often, as offsets in their block."""
    slot, n = np.unique(slots_of(hashes, slots).ravel(), return_counts=True)
    block, offset = slot // BLOCK, (slot % BLOCK).astype(np.uint16)
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    ends = np.r_[starts[1:], len(slot)]
    return pa.RecordBatch.from_arrays(
        [pa.array(block[starts], pa.int32()),
         pa.array([offset[a:b][n[a:b] == 1].tobytes() for a, b in zip(starts, ends)], pa.binary()),
         pa.array([offset[a:b][n[a:b] > 1].tobytes() for a, b in zip(starts, ends)], pa.binary())],
        names=["block", "ones", "more"])


def _bits(block: int | None, count: np.ndarray, times: int):
    if block is not None and (count >= times).any():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(count >= times).tobytes()], pa.binary())],
                                         names=["block", "bits"])


def _test(hashes: DataFrame, times: int):
    """A function of a column of hashes: whether ``times`` or more of the ``hash`` rows may
    be equal to it."""
    slots = n_slots(hashes.count())
    bits = hashes.sparkSession.sparkContext.broadcast(repeat_sketch(hashes, slots, times))

    @F.arrow_udf("boolean")
    def test(hashes: pa.Array) -> pa.Array:
        at, table = slots_of(hashes.to_numpy(zero_copy_only=False), slots), bits.value
        return pa.array(((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0), pa.bool_())
    return test


def possible_repeat(docs: DataFrame, text: Column):
    """A function of a text column: whether another row of ``docs`` may hold the same
    text (never false for a text that occurs twice)."""
    test = _test(docs.select(F.xxhash64(text).alias("hash")), 2)
    return lambda c: test(F.xxhash64(c))


def possible_member(hashes: DataFrame):
    """A function of a column of 64-bit hashes: whether ``hashes`` (a column ``hash``) may
    hold it (never false for one that it holds)."""
    return _test(hashes, 1)


# ---- failures ----------------------------------------------------------------------
def words_in(text: Column) -> Column:
    bare = F.regexp_replace(text, rf"^{SPACE}|{SPACE}\z", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE, -1))


def text_failures(text: Column, words: Column) -> list[Column]:
    """Whether a text fails each of the filters A to D."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [n < 100, 100 * distinct < 80 * n, 100 * capitals > 10 * F.length(text), text.rlike(r"[#$%&*|]")]


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``doc_id, part, mask, n``: documents by the filters they fail (bit i for letter
    i); ``n`` rows share an id, a part and a mask."""
    text, doc_id = text_or_empty(text_col), F.col(id_col)
    possible = possible_repeat(docs, text)
    # the words are a column of their own, so that a text is split once
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       text.alias("text")).withColumn("words", words_in(F.col("text")))
    fails = text_failures(F.col("text"), F.col("words"))
    rows = rows.select("doc_id", "part", sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0)).alias("mask"),
                       F.when(F.col("doc_id").isNotNull(), F.sha2(F.col("text").cast("binary"), 256)).alias("key"),
                       possible(F.col("text")).alias("possible"))
    # equal rows fold before and after the shuffle; a text that is surely unique needs no key
    rows = rows.withColumn("key", F.when(F.col("possible"), F.col("key"))).drop("possible")
    rows = store(rows.groupBy("doc_id", "part", "mask", "key").agg(F.count(F.lit(1)).alias("n")), "audit-masks")
    again = docs.where(doc_id.isNotNull()).select(doc_id.alias("doc_id"), text.alias("text")).where(possible(F.col("text")))
    first = again.groupBy("text").agg(F.min("doc_id").alias("doc_id")).select(
        "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("key"), F.lit(True).alias("first"))
    # the key tells texts of one repeated id apart; ids spread the rows of a hot text
    told = rows.where(F.col("key").isNotNull()).join(first, ["doc_id", "key"], "left").select(
        "doc_id", "part", F.when(F.col("first"), F.col("mask")).otherwise(F.col("mask") + (1 << REPEAT)).alias("mask"), "n")
    return rows.where(F.col("key").isNull()).select("doc_id", "part", "mask", "n").unionByName(told)


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each mask, and how many of them are
    labelled good (``quality`` 1) and toxic (``toxic`` 1)."""
    said = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).where("good or toxic")
    rows = masks.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).join(said, "doc_id", "left")

    def where(c: str) -> Column:
        return F.sum(F.when(F.col(c), F.col("n")).otherwise(F.lit(0)))
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), where("good").alias("good"), where("toxic").alias("toxic"))


# ---- orders ------------------------------------------------------------------------
def step_counts(counts: DataFrame) -> DataFrame:
    """One row per part, filter and set of filters before it (80 per part)."""
    n = len(LETTERS)
    steps = [(f, before) for f in range(n) for before in range(1 << n) if not before >> f & 1]
    each = counts.withColumn("s", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.lit(1 << f).alias("bit"), F.lit(b).alias("before")) for f, b in steps])))
    bit, mask = F.col("s.bit"), F.col("mask")
    fails, earlier = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(F.col("s.before")) != 0

    def total(cond: Column, value: str = "n") -> Column:
        return F.sum(F.when(cond, F.col(value)).otherwise(F.lit(0))).cast("long")
    return each.groupBy("part", F.col("s.f").alias("f"), F.col("s.before").alias("before")).agg(
        total(~fails & ~earlier).alias("kept"), total(fails & ~earlier).alias("removed"), total(fails & earlier).alias("redundant"),
        total(mask == bit).alias("unique_fails"), total(fails & ~earlier, "good").alias("good_lost"),
        total(fails & ~earlier, "toxic").alias("toxic_lost"))


def audit_orders(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step (600 per part)."""
    n = len(LETTERS)
    steps = step_counts(counts)
    # orders in which exactly the filters ``before`` come before f
    times = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]), F.bit_count("before") + 1)
    shapley = steps.groupBy("part", "f").agg(F.sum(F.col("removed") * times).cast("long").alias("shapley"))
    rows = [("".join(LETTERS[f] for f in p), i + 1, p[i], sum(1 << f for f in p[:i])) for p in permutations(range(n)) for i in range(n)]
    orders = counts.sparkSession.createDataFrame(rows, "filter_order string, step int, f int, before int")
    return (steps.join(shapley, ["part", "f"]).join(F.broadcast(orders), ["f", "before"])   # 600 rows, fixed
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def audit_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters by language, for every order and step."""
    return audit_orders(store(mask_counts(failure_masks(docs), labels), "audit-counts"))
