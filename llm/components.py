"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import in_few_files, stash


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Of each edge (u, v), u > v, the upper node is linked to the least neighbour of the lower one, or to that one itself."""
    least = _lowest(edges).withColumnRenamed("u", "v")
    return edges.join(least.hint("merge"), "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its lower neighbours are linked to the least of these."""
    least = _lowest(edges)
    joined = edges.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every upper node has one lower node, which is no upper node: then these are the components."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("lower"), F.lit(0).alias("upper"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("lower").alias("lower"), F.max("upper").alias("upper"))
    return ends.where("lower > 1 or (lower = 1 and upper = 1)").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link (a, b); the component is its least node.

    Each round is written to the shared scratch folder; the rounds grow with the logarithm of the
    longest path. Joins are by shuffle also while a side is small: each broadcast would take memory on the driver,
    round after round.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges = stash(in_few_files(edges), "edges")
    while not _settled(edges):
        edges = stash(in_few_files(_small_star(_large_star(edges))), "edges")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select("v", "v")).distinct()
