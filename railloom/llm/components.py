"""Connected components over links, by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return int(r["n"]), int(r["h"] or 0)


def _stars(pairs: DataFrame, small: bool) -> DataFrame:
    """Hang the neighbours of each node on the least of them: the greater ones (large star) or the lesser ones and itself (small)."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    if small:
        hung = pairs.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        hung = hung.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        hung = pairs.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
    return hung.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of links (a, b); loops and repeats do no harm.

    No node's neighbours are ever gathered: each round is a minimum per node and a join, both of which split hot nodes.
    """
    edges = stash(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _stars(both, small=False)
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        edges = stash(_stars(down, small=True), "links")
        last, state = state, _state(edges)
        if state == last:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
