"""Connected components of an edge table by alternating large-star and small-star
steps (Kiveris et al., "Connected Components in MapReduce and Beyond").

Every step is a map-side combined minimum and a join; each round's edges are
written to the shared folder, so the plan stays short and no link, component or
node is collected.  The rounds grow with the logarithm of the longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import forget, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lows = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(lows, "u").filter("v > u").select(
        F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lows = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lows, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lows.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", n_bytes: int | None = None) -> DataFrame:
    """``node, root`` for every node that has a link; root is the smallest node of
    its component.  Self links and repeated links are allowed.  ``n_bytes``, about what
    the edges take, sizes the files they are written in."""
    edges = stored(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges", n_bytes)
    mark = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == mark:
            break
        mark = tuple(state)
        before, edges = edges, stored(_small_star(_large_star(edges)), "edges", n_bytes)
        forget(before)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.union(edges.select("u", "v"))


__all__ = ["components"]
