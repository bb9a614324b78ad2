"""Connected components of an edge table, by alternating large and small stars.

Each round hangs every vertex below the lowest vertex it can see; after a few rounds every component is a star around
its lowest vertex.  Minima are summed map-side, and the joins have one row for each vertex on one side, so that a hub
with very many neighbours can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges (u, v)``; the root is the lowest node of its component."""
    low, high = F.least("u", "v"), F.greatest("u", "v")
    edges = written(edges.filter("u <> v").select(high.alias("u"), low.alias("v")).distinct())
    nodes = edges
    before, state = None, _state(edges)
    while state != before and state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(edges)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    if not state[0]:
        roots = nodes.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
