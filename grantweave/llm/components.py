"""Connected components of a stored table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantweave.llm.tables import join_groups, stored


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest node around it."""
    both = stored(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
    least = both.groupBy("u").agg(F.min("v").alias("_m"), F.count(F.lit(1)).alias("_n"))
    joined = join_groups(both, stored(least, "least"), ["u"], "_n")
    return joined.filter("v > u").select(F.col("v").alias("u"), F.least("u", "_m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each smaller neighbour of a node, and the node, to the smallest of them."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("_m"), F.count(F.lit(1)).alias("_n")), "least")
    joined = join_groups(edges, least, ["u"], "_n")
    return (
        joined.filter("v != _m")
        .select(F.col("v").alias("u"), F.col("_m").alias("v"))
        .unionByName(least.select("u", F.col("_m").alias("v")))
        .distinct()
    )


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component``, the smallest node of its component, for every node but the smallest.

    Alternates large-star and small-star steps until every component is a star. Each step moves rows of
    two integers, and nodes with a large share of the links are joined by broadcast.
    """
    edges = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = stored(edges.distinct(), "edges")
    before = _fingerprint(edges)
    while before[0]:
        edges = stored(_small_star(stored(_large_star(edges), "edges")), "edges")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
