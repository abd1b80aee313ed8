"""Connected components of a graph of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import discard, materialize


def _towards_least(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked with the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _down(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked with the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Tells two sets of edges apart: their number, and a sum of their hashes."""
    part = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(part)).first())


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node, root`` for all nodes of ``links`` (``a, b``) but the roots, which
    are the least nodes of their components.

    The number of rounds grows with the logarithm of a component's width; each
    round is written to the shared folder.  No node's neighbours are collected.
    """
    # edges lead from larger to smaller nodes before and after each round
    edges = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, mark = materialize(spark, edges.distinct(), "edges"), None
    while mark != (now := _mark(edges)):
        mark, last = now, edges
        edges = materialize(spark, _down(_towards_least(edges)), "edges")
        discard(spark, last)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
