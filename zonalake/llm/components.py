"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from zonalake.session import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node tells its larger neighbours of the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select("a", F.least("a", "low").alias("low"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node tells its smaller neighbours, and itself, of the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    told = edges.join(least, "a").where(F.col("b") > F.col("low"))
    return told.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
        least.select("a", F.col("low").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    `edges` has the columns a and b. Large-star and small-star steps alternate until nothing changes;
    each is an aggregation that combines in the map tasks and a join, so a node with very many edges is
    spread over tasks. Every round is written to the shared folder; only a count and a checksum of the
    edges come to the driver.
    """
    ordered = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now, mark = settle(ordered.distinct(), "component-edges"), None
    while True:
        seen = Observation("edges")
        digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        then = _small_star(_large_star(now)).distinct()
        then = settle(then.observe(seen, F.count(F.lit(1)).alias("n"), digest.alias("digest")), "component-edges")
        found = seen.get
        if found == mark:
            nodes = then.select(F.col("a").alias("node"), F.col("b").alias("component"))
            roots = then.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return nodes.unionByName(roots)
        now, mark = then, found
