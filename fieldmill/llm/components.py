"""Connected components of an edge table, by joins and aggregations only.

Alternates the large-star and small-star steps: every node's neighbours are linked to the smallest node
known nearby until only stars are left. Each round is two grouped minima, which combine before the
shuffle, and joins whose large side adaptive execution may split, so a node with very many neighbours is
no task's burden. Every round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.sources.shared import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; the component is its smallest node.

    Null ends, loops and repeated edges don't matter; without edges the result is empty. The number of
    rounds grows with the logarithm of the longest chain.
    """
    edges = edges.select("u", "v").filter("u <> v").distinct()
    edges = stored(edges, "edges")
    state = _state(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
