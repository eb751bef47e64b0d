"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target of words.  A document of a source should be taken
``target / source size`` times (0 to ``MAX_COPIES``): the whole part is certain,
the fraction is rounded by the pivotal method.  Fractional documents meet in
pairs, and words move at random from one to the other (each keeping its
expectation) until one of them is taken whole or not at all; the other goes on.
So the words taken in a group stay as they are but for one last document.

Distribution: documents are dealt by a hash of their id into groups of about
``GROUP_ROWS`` per source, so a source with a third of all rows spreads over
many tasks.  Each group leaves one fractional document; those residuals meet in
the next round in groups of ``GROUP_ROWS``, and so on: a reduction tree of
log(rows) / log(GROUP_ROWS) rounds.  Larger documents meet first, so that the
document left at the end is a small one; it goes to the nearer side.

All random choices follow from hashes of the id and ``seed``: reruns agree.

Defined results: a null text has size 0; documents of size 0 are never taken;
sources go by code point with null last, and all null sources form one source;
rows that repeat an id are documents of their own; an empty table gives an empty
result; other columns pass through ``copies`` and are ignored by the report.
The per-source totals (one row a source, at most ``MAX_SOURCES``) are the only
rows that reach the driver.
"""

from __future__ import annotations

import math

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docrank.llm.common import store, text_or_empty

WEIGHTS = (1.0, 2.0, 3.0)
MAX_COPIES = 3
GROUP_ROWS = 4_096
MAX_SOURCES = 1_000_000


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in each text (bytes.split cuts at just
    those six characters)."""
    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([len(t.split()) for t in texts.cast(pa.binary()).to_pylist()], pa.int64())
    return count(text)


def targets(sizes: list[int], weights: list[float], most: float = MAX_COPIES) -> list[float]:
    """Share ``sum(sizes)`` by weight; a target stops at ``most`` times its size and
    the excess is shared among the others, until none is above."""
    out = [0.0] * len(sizes)
    left, live = float(sum(sizes)), list(range(len(sizes)))
    while live and left > 0:
        w = sum(weights[i] for i in live)
        over = [i for i in live if left * weights[i] / w > most * sizes[i]]
        if not over:
            for i in live:
                out[i] = left * weights[i] / w
            break
        for i in over:
            out[i] = float(most * sizes[i])
            left -= out[i]
        live = [i for i in live if i not in set(over)]
    return out


def pivot(size: list[int], mass: list[float], draw: list[float]) -> list[float]:
    """Pivotal rounding in the given order: ``mass[i]`` words of document i (0 to
    ``size[i]``) become 0 or ``size[i]`` but for at most one document; the sum stays and
    each document keeps its expectation.

    First each document in turn fights the ones after it with one draw: it wins
    all (with probability mass / size) or loses all, and each partner pays or
    gains the largest share that keeps the partner's expectation, until the
    document is whole.  What is still open then is settled pair by pair."""
    out = list(mass)
    for i in range(len(out)):
        x, s = out[i], size[i]
        if not 0 < x < s:
            continue
        wins, share = draw[i] * s < x, 1.0
        for j in range(i + 1, len(out)):
            if not 0 < out[j] < size[j]:
                continue
            part = min(out[j] / (s - x), (size[j] - out[j]) / x, share)
            out[j] = _snap(out[j] - part * (s - x) if wins else out[j] + part * x, size[j])
            share -= part
            if share < 1e-12:
                share = 0.0
                break
        out[i] = _snap(x + (1 - share) * (s - x) if wins else x - (1 - share) * x, s)
    at = -1
    for i in range(len(out)):
        if not 0 < out[i] < size[i]:
            continue
        if at < 0:
            at = i
            continue
        total = out[at] + out[i]
        high = min(size[at], total)
        low = total - min(size[i], total)
        a = high if (draw[i] * 7919) % 1 * (high - low) < out[at] - low else low
        out[at], out[i] = _snap(a, size[at]), _snap(total - a, size[i])
        at = at if 0 < out[at] < size[at] else i if 0 < out[i] < size[i] else -1
    return out


def _snap(x: float, size: int) -> float:
    return 0.0 if x < 1e-9 * size else float(size) if x > size * (1 - 1e-9) else x


def _round_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["size", "draw", "mass"], ascending=[False, True, True], kind="stable")
    pdf["mass"] = pivot(pdf["size"].tolist(), pdf["mass"].tolist(), pdf["draw"].tolist())
    return pdf


STATE = "rid long, key long, src int, size long, mass double, draw double, bucket long"


def round_masses(rows: DataFrame, seed: int = 0, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``rid, taken`` for rows ``rid, key, src, size, mass`` with 0 < mass < size: whole
    documents whose words sum to the masses' but for one document a source.  ``key``
    seeds a row's random choices; ``rid`` only names the row."""
    def draw(level: int) -> Column:
        return F.pmod(F.xxhash64("key", F.lit(seed), F.lit(level)), F.lit(1 << 40)) / F.lit(float(1 << 40))

    state, done, level = split_repeats(rows, group_rows), None, 0
    while True:
        counts = {r.src: r["count"] for r in state.groupBy("src").count().collect()}
        if not counts:
            break
        groups = {s: max(1, math.ceil(n / group_rows)) for s, n in counts.items()}
        wide = {s: g for s, g in groups.items() if g > 1}
        k = F.lit(1)
        if wide:  # one entry a source
            table = rows.sparkSession.createDataFrame(list(wide.items()), "src int, k int")
            state, k = state.join(F.broadcast(table), "src", "left"), F.coalesce("k", F.lit(1))
        dealt = state.select("rid", "key", "src", "size", "mass", draw(level).alias("draw"),
                             F.pmod(F.xxhash64("key", F.lit(seed), F.lit(-1 - level)), k).alias("bucket"))
        out = store(dealt.groupBy("src", "bucket").applyInPandas(_round_group, STATE), "mix-round")
        whole = (F.col("mass") <= 0) | (F.col("mass") >= F.col("size"))
        part = out.where(whole).select("rid", F.col("mass").cast("long").alias("taken"))
        done = part if done is None else done.unionByName(part)
        state = out.where(~whole).select("rid", "key", "src", "size", "mass")
        if not wide:
            # one document a source is left: it goes to the nearer side
            last = state.select("rid", F.when(F.col("mass") * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0)).cast("long").alias("taken"))
            return done.unionByName(last)
        level += 1
    return done if done is not None else rows.select("rid", F.col("size").alias("taken")).limit(0)


def split_repeats(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` with new keys for those keys that more than ``most`` rows share (rows that
    repeat an id and a text), so that no more than ``most`` rows are dealt together.

    Such rows are numbered without bringing them together: ``rid`` holds the stored
    partition in its high bits, rows are numbered within a partition, and running sums
    over the partitions' counts make the numbers consecutive.  Equal rows are
    interchangeable, so the numbers' dependence on the partitioning changes nothing."""
    often = rows.groupBy("key").count().where(F.col("count") > most).select("key")   # at most rows / most
    if often.isEmpty():
        return rows
    part = F.shiftright("rid", 33).alias("part")
    repeats = store(rows.select("key", "rid", part).join(often, "key").withColumn(
        "at", F.row_number().over(Window.partitionBy("key", "part").orderBy("rid")) - 1).drop("part"), "mix-repeats")
    each = repeats.groupBy("key", part).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    each = each.select("key", "part", F.coalesce(before, F.lit(0)).alias("before"))
    number = F.floor((F.col("at") + F.col("before")) / F.lit(most))
    named = repeats.select("key", "rid", "at", part).join(each, ["key", "part"]).select("rid", F.xxhash64("key", number).alias("new"))
    return rows.join(named, "rid", "left").withColumn("key", F.coalesce("new", "key")).drop("new")


def mix(docs: DataFrame, weights=WEIGHTS, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", group_rows: int = GROUP_ROWS, out_col: str = "mix") -> DataFrame:
    """``docs`` plus a struct ``out_col``: ``size``, ``source_size``, ``target``, ``copies`` (times the
    document is taken, 0 to ``MAX_COPIES``)."""
    return _mixed(store(_sized(docs, id_col, text_col), "mix-docs"), weights, seed, source_col, group_rows, out_col)


def _sized(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the size, a row id (fixed once stored) and the key of its
    random choices, which depends on nothing but the document."""
    return docs.withColumns({
        "__size": n_words(text_or_empty(text_col)),
        "__key": F.xxhash64(F.col(id_col), F.col(text_col)),
        "__rid": F.monotonically_increasing_id()})


def _mixed(fixed: DataFrame, weights, seed, source_col, group_rows, out_col) -> DataFrame:
    spark = fixed.sparkSession
    source = F.col(source_col).cast("string")
    per = fixed.groupBy(source.alias("source")).agg(F.sum("__size").alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(per) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    per = sorted(per, key=lambda r: (r.source is None, r.source or ""))  # Python orders text by code point
    sizes = [int(r.words) for r in per]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(per))])
    plan = spark.createDataFrame(
        [(i, r.source, sizes[i], goal[i]) for i, r in enumerate(per)],
        "__src int, __name string, __words long, __target double")
    rows = fixed.join(F.broadcast(plan), F.col("__name").eqNullSafe(source), "left").drop("__name")
    ratio = F.when(F.col("__words") > 0, F.least(F.col("__target") / F.col("__words"), F.lit(float(MAX_COPIES)))).otherwise(F.lit(0.0))
    rows = rows.withColumns({"__whole": F.floor(ratio), "__mass": (ratio - F.floor(ratio)) * F.col("__size")})
    open_rows = rows.where((F.col("__mass") > 0) & (F.col("__mass") < F.col("__size"))).select(
        *[F.col(f"__{c}").alias(c) for c in ("rid", "key", "src", "size", "mass")])
    taken = round_masses(open_rows, seed, group_rows).select(F.col("rid").alias("__rid"), F.col("taken").alias("__taken"))
    rows = rows.join(taken, "__rid", "left")
    copies = F.when(F.col("__size") > 0, F.col("__whole") + F.when(F.col("__taken") > 0, 1).otherwise(0)).otherwise(0).cast("int")
    out = F.struct(F.col("__size").alias("size"), F.col("__words").alias("source_size"), F.col("__target").alias("target"),
                   copies.alias("copies"))
    return rows.withColumn(out_col, out).drop("__size", "__key", "__rid", "__src", "__words", "__target", "__whole", "__mass", "__taken")


def mix_report(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document."""
    rows = _sized(docs.select("doc_id", "text", "source"), "doc_id", "text").drop("text")
    out = _mixed(store(rows, "mix-sizes"), WEIGHTS, 0, "source", GROUP_ROWS, "mix")
    return out.select("doc_id", "mix.size", "mix.source_size", "mix.target",
                      (F.col("mix.copies") * F.col("mix.size")).cast("long").alias("taken"))
