"""Connected components of a link table, by repeated contraction.

Each round every node points at its smallest neighbour (or itself, if that is
smaller); pointers are doubled until they reach a root; roots become the nodes
of the next, at most half as large graph.  Nothing is collected: a node with a
third of all links is only ever aggregated (min) or joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrank.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` for every node of the links ``a, b`` (long ids): ``comp`` is the
    smallest node that links lead to."""
    links = store(_proper(links.select("a", "b")), "cc-links")
    maps = []
    while not links.isEmpty():
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = store(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("comp")), "cc-up")
        up = _roots(up)
        maps.append(up)
        to = up.select(F.col("node").alias("a"), F.col("comp").alias("ra"))
        tb = up.select(F.col("node").alias("b"), F.col("comp").alias("rb"))
        moved = links.join(to, "a").join(tb, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        links = store(_proper(moved), "cc-links")
    if not maps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    out = maps[0]
    for up in maps[1:]:
        nxt = up.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        out = out.join(nxt, "comp", "left").select("node", F.coalesce("next", "comp").alias("comp"))
    return out


def _proper(links: DataFrame) -> DataFrame:
    return (links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where(F.col("a") < F.col("b")).distinct())


def _roots(up: DataFrame) -> DataFrame:
    """Follow the pointers to their roots by doubling, twice in each step."""
    def twice(p: DataFrame) -> DataFrame:
        step = p.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        return p.join(step, "comp").select("node", F.col("comp").alias("near"), "far")

    while True:
        two = twice(up).select("node", F.col("far").alias("comp"))
        four = store(twice(two), "cc-roots")
        up = four.select("node", F.col("far").alias("comp"))
        if four.where("near <> far").isEmpty():
            return up
