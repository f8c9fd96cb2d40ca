"""Connected components of a table of links by alternating star contraction.

Every round is two aggregates that are combined before the exchange and two joins
that Spark can split when a node is hot; rounds end in stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from readgrade.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of its component for every node that has a link.

    Links are undirected; repeated links and links to oneself do no harm, links with a null
    end are no links, an empty table has no components.
    """
    edges = stored(_down(links.select(F.col(a).alias("u"), F.col(b).alias("v"))).distinct(), "links")
    state = _state(edges)
    while True:
        large = _large_star(edges)
        edges = stored(_small_star(large), "links")
        now = _state(edges)
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()[:]


def _down(pairs: DataFrame) -> DataFrame:
    """Links from the larger to the smaller end."""
    return pairs.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # a larger neighbour v of u is the upper end of a link, so the links themselves are what is joined
    return edges.select(F.col("v").alias("c"), F.col("u").alias("w")).join(
        least.withColumnRenamed("u", "c"), "c").select(F.col("w").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    edges = edges.where("u != v").distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _down(others.unionByName(least.withColumnRenamed("m", "v"))).distinct()
