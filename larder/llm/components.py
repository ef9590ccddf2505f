"""Distributed connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.sources.staging import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    `edges` has two columns of one orderable type; order, repeats, self-links and rows with a null are of no matter.
    Each round shuffles by node with partial minima, never gathers a node's neighbours, and is written as a table, so
    the plan stays short and a lost executor costs a task. The rounds grow with the logarithm of the longest path.
    """
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = settle(pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    before = None
    while (now := _state(pairs)) != before:
        before = now
        if not now[0]:
            break
        pairs = settle(_small_star(_large_star(pairs)), "edges")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Link each node's larger neighbours with the smallest node around it."""
    around = pairs.union(pairs.select("v", "u")).toDF("x", "y")
    least = around.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    larger = pairs.select(F.col("v").alias("x"), F.col("u").alias("y"))
    return larger.join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours with the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    others = pairs.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least).distinct()
