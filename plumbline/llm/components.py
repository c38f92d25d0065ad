"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b) with a > b: hang neighbours on the least node of each neighbourhood.

    Each neighbourhood's least node is an aggregate joined back to the edges, so a hub
    with very many neighbours is never gathered in one place.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        joined = edges.join(least, "a")
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in `links` (a, b); the root is the least node it can reach."""
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stage(links.where(F.col("a") != F.col("b")).select(a, b).distinct(), "edges")
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    seen = mark(edges)
    while True:
        edges = stage(_star(_star(edges, True), False), "edges")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
