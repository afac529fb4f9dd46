"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chronotab.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's neighbours (large: those above it, small: those below) to the least one."""
    if large:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
    else:
        least = edges.groupBy("b").agg(F.min("a").alias("m"))
        out = edges.join(least, "b").select(F.col("m").alias("a"), F.when(F.col("a") > F.col("m"), F.col("a")).otherwise(F.col("b")).alias("b"))
        out = out.union(least.select(F.col("m").alias("a"), "b"))
    return out.where("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node that has an edge (a, b), with the least node of its component.

    Every round cuts the lineage in the shared checkpoint folder; the rounds end when the edges
    are stars, whatever their number (it grows with the logarithm of the component's size).
    Null ends and self links are ignored.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    edges = cut_lineage(edges.where("a is not null and b is not null and a <> b")
                        .select(a.alias("a"), b.alias("b")).distinct())
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
                edges.select(F.col("a"), F.col("a")).distinct())
        state = now
        edges = cut_lineage(_star(_star(edges, True), False))
