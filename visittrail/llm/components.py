"""Connected components of a graph that only executors hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, low: str = "a", high: str = "b") -> DataFrame:
    """(node, component) of every node of an edge; component is the smallest node reachable.

    Large-star and small-star steps in turn: each links nodes to the smallest known neighbour, so
    that no step gathers a node's neighbours, and the number of steps grows with the logarithm of
    the longest path. Each step is checkpointed. Self-links and repeated links are allowed.
    """
    links = _ordered(edges.select(F.col(low).alias("u"), F.col(high).alias("v"))).checkpoint()
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        links = _ordered(_to_smallest(both).filter("w > u").select(F.col("w").alias("u"), "v"))
        links = _ordered(_small_star(links)).checkpoint()
        now = links.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 65521)
        ).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, from the larger node u to the smaller node v."""
    return links.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).filter("u <> v").distinct()


def _to_smallest(links: DataFrame) -> DataFrame:
    """(u, w, v): for each link u-w the smallest v among u and its neighbours."""
    smallest = links.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("k"), F.least("u", "m").alias("v")
    )
    return links.withColumnRenamed("v", "w").join(smallest, F.col("u") == F.col("k")).drop("k")


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of u, and u itself, linked to u's smallest neighbour."""
    found = _to_smallest(links)
    return found.select(F.col("w").alias("u"), "v").unionByName(found.select("u", "v"))
