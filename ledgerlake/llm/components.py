"""Connected components of a link table, as Spark joins and group-bys.

Alternates two steps until only stars are left: every vertex hooks its larger
neighbours to its smallest neighbour (large star), then its smaller ones
(small star). Both only read (vertex, neighbour) rows and a per-vertex
minimum, so a vertex with very many links is pre-aggregated map-side and its
rows never have to meet in one task. Each round is written to the shared
folder, which cuts the lineage. Links that are stars from the start take no
round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import landed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b) in both directions; hook b to the minimum around a."""
    if large:
        near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = near.where("b > a").join(least, "a")
        # as many rows as links: the small star that follows removes repeats
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    joined = near.join(least, "a")
    hooked = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return hooked.union(least.select("a", F.col("m").alias("b"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Every larger end (a) has one link, and no centre (b) is a larger end
    itself: the links name the components then. One row reaches the driver."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up")).union(
        edges.select(F.col("b").alias("v"), F.lit(0).alias("up")))
    seen = ends.groupBy("v").agg(F.sum("up").alias("up"), F.count("*").alias("links"))
    # a vertex with a link up must have no other link
    return seen.where("up > 0 AND links > 1").limit(1).count() == 0


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every vertex of ``edges(a, b)`` that has a smaller
    vertex in its component; a component is named by its smallest vertex."""
    edges = landed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "links")
    rounds = 0
    while not _is_stars(edges):
        if rounds == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        edges = landed(_star(_star(edges, True), False), "links")
        rounds += 1
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
