"""A join that stays balanced when one key holds a large share of the rows.

``skew_safe_join(facts, dim, key, rows_per_key, spread)`` joins a large fact
table to a table with one row per key whose column ``rows_per_key`` says how
many fact rows carry that key (for the vocabulary: the document frequency).

Keys with more than ``max_rows`` fact rows are *hot*.  Each hot key gets
``ceil(rows / max_rows)`` salt values: its fact rows pick a salt from a hash of
``spread`` (the document id) and its dimension row is repeated once per salt,
so the shuffled hash join on ``(key, salt)`` never gives one task more than
about ``max_rows`` fact rows of a key.  Cold keys keep salt 0.

The hot-key table is broadcast.  Its size has a proven bound: since the
per-key counts add up to the number of fact rows F, there are at most
``F / max_rows`` hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS_PER_KEY = 2_000_000


def salt_counts(dim: DataFrame, key: str, rows_per_key: str,
                max_rows: int = DEFAULT_MAX_ROWS_PER_KEY) -> DataFrame:
    """``(key, _n_salt)`` for hot keys only (bounded, see module doc)."""
    return (dim.where(F.col(rows_per_key) > max_rows)
            .select(key, F.ceil(F.col(rows_per_key) / F.lit(max_rows)).cast("int").alias("_n_salt")))


def skew_safe_join(facts: DataFrame, dim: DataFrame, key: str, spread: str,
                   rows_per_key: str | None = None, hot: DataFrame | None = None,
                   max_rows: int = DEFAULT_MAX_ROWS_PER_KEY,
                   dim_hint: str | None = "shuffle_hash") -> DataFrame:
    """Inner join of ``facts`` and ``dim`` on ``key``, salted for hot keys.

    Hot keys come from ``dim[rows_per_key]`` or from a ready ``hot`` table
    ``(key, _n_salt)`` (see ``salt_counts``).  ``dim`` may hold several rows
    per key: each is repeated once per salt, so every fact row still meets
    every matching dim row exactly once.  Output: columns of both sides.

    ``dim_hint='shuffle_hash'`` builds the hash table on the dim side of a
    shuffled join (right for a large dim such as a vocabulary); ``None``
    leaves the choice to the planner, which broadcasts a dim it estimates
    small (a query-term table) and then moves no fact row at all."""
    if hot is None:
        hot = salt_counts(dim, key, rows_per_key, max_rows)
    hot = F.broadcast(hot)
    n_salt = F.coalesce(F.col("_n_salt"), F.lit(1))
    f = (facts.join(hot, key, "left")
         .withColumn("_salt", F.pmod(F.xxhash64(F.col(spread)), n_salt).cast("int"))
         .drop("_n_salt"))
    d = (dim.join(hot, key, "left")
         .withColumn("_salt", F.explode(F.sequence(F.lit(0), n_salt - 1)))
         .drop("_n_salt"))
    if dim_hint:
        d = d.hint(dim_hint)
    return f.join(d, [key, "_salt"]).drop("_salt")
