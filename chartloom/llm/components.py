"""Connected components by alternating stars, with every step a join or an aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.session import materialize


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Hang every node's larger neighbours (or, if ``small``, the node and its smaller ones) on the
    smallest node next to it. Smallest neighbours are aggregated before any join, so that a node
    with many neighbours is only ever a skewed join key, which adaptive execution splits."""
    if small:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        down = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    low = low.withColumn("low", F.least("u", "low"))
    joined = down.join(low, "u")
    if small:
        hung = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            low.select("u", F.col("low").alias("v"))
        )
    else:
        hung = joined.where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("low").alias("v")
        )
    return hung.where(F.col("u") != F.col("v")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and none that others hang on hangs itself."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"))
    )
    counts = ends.groupBy("x").agg(F.sum("up").alias("up"), F.min("up").alias("low"))
    return counts.where((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("low") == 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``edges`` (u, v) that are not the smallest of their component,
    which is the label.

    Each round is stored; the number of rounds grows with the logarithm of the longest chain. Only a
    yes or no per round reaches the driver. Edges with a null end are ignored, repeated edges count
    once, no edges give no rows.
    """
    edges = edges.select("u", "v").where(F.col("u") != F.col("v"))
    while True:
        edges = materialize(_stars(_stars(edges, False), True), "stars")
        if _settled(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
