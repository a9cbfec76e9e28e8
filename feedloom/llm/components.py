"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import materialize


def _stars(edges: DataFrame) -> DataFrame:
    """Tie every node's larger neighbours to the smallest of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_stars(edges: DataFrame) -> DataFrame:
    """Tie every node and its smaller neighbours to the smallest of them. Edges go from u to v < u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and that one has none."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))
    per = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return per.where("up > 1 OR up = 1 AND least = 0").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node of its component) of all nodes with an edge.

    ``edges`` has ``u`` and ``v`` of any ordered type. Each round is written to the shared
    folder; the number of rounds grows with the logarithm of the number of nodes. Edges that are
    stars already take no round.
    """
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = materialize(ordered, "component-edges")
    while not _are_stars(current):
        current = materialize(_small_stars(_stars(current)), "component-edges")
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
