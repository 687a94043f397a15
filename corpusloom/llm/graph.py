"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.union(edges.select(F.col("b"), F.col("a")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 30)), F.sum(F.xxhash64("b", "a") % (1 << 30))
        ).first()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of the links ``a, b``; a component is its smallest node.

    Every round is written to the shared folder, so lineage stays short; the rounds grow with the
    logarithm of the longest chain.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        edges = written(_stars(written(_stars(edges, True), "large-star"), False), "small-star")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b"), F.col("b")).distinct()
    )
