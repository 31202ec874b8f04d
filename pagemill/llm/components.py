"""Connected components of a graph of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.sources.storage import stage


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links(a, b)`; a component is named by its smallest node.

    Alternates two steps until nothing changes: each node hands its larger neighbours to the
    smallest node around it, then the smaller ones. Both are an aggregate with pre-aggregation and a
    join back, so a node with very many links is not held in one task. Every round is written to
    the shared folder. The number of rounds grows with the logarithm of the longest chain.
    """
    edges = stage(_distinct(links), "links")
    before = None
    while True:
        edges = stage(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(
        found.select(F.col("component").alias("node"), "component").distinct()
    )


def _distinct(links: DataFrame) -> DataFrame:
    """Links from the larger to the smaller node, once each."""
    return links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).filter("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node among the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("m"))
    smallest = smallest.select("a", F.least("a", "m").alias("m"))
    return _distinct(both.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(smallest, "a")
    return _distinct(
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(smallest.select("a", F.col("m").alias("b")))
    )
