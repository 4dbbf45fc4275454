"""Connected components by alternating star contraction, with every round on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import landed


def _settled(edges: DataFrame) -> bool:
    """Whether every node is in one edge toward its top, or a top itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("top")).union(edges.select("v", F.lit(0), F.lit(1)))
    open_ = ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("top").alias("top")).filter("low + top > 1")
    return open_.agg(F.count(F.lit(1))).first()[0] == 0


def _toward_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Every node's neighbours point to its least neighbour (or itself).  ``larger_only``
    moves the neighbours above the node, else those below it and the node itself."""
    both = edges.select(F.col("u").alias("node"), F.col("v").alias("other"))
    if larger_only:
        both = both.union(edges.select("v", "u"))
    else:
        both = edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("other"))
    least = both.groupBy("node").agg(F.min("other").alias("low")).withColumn("low", F.least("low", "node"))
    moved = both.join(least, "node")
    out = moved.filter(F.col("other") > F.col("node")) if larger_only else moved.filter(F.col("other") != F.col("low"))
    out = out.select(F.col("other").alias("u"), F.col("low").alias("v"))
    if not larger_only:
        out = out.union(least.select(F.col("node").alias("u"), F.col("low").alias("v")))
    out = out.filter("u != v")
    return out if larger_only else out.distinct()


def components(links: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component) of every node of ``links``; the component is its least node.

    Rounds go on until the edges are stars; each is written to the shared
    folder.  A node of very many links meets its least neighbour by a partial
    aggregate and a join that adaptive execution can split."""
    edges = landed(links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u != v").distinct(), "edges")
    while not _settled(edges):
        edges = landed(_toward_least(_toward_least(edges, True), False), "edges")
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
