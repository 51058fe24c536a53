"""Connected components without gathering links anywhere: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import discard, materialise


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
    return moved.select("e.*").where("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars already: every u has one v, and no v is a u."""
    once = edges.groupBy("u").agg(F.count("*").alias("n"))
    double = once.where("n > 1").select("u").limit(1)
    chained = once.select("u").join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1)
    return double.unionByName(chained).count() == 0


def components(links: DataFrame, most: int = 40) -> DataFrame:
    """links (a, b) of longs to (node, comp): comp is the smallest node that can be reached. Nodes without links are absent.

    Minima are pre-aggregated, and joins back to a hub's edges can be split, so a hub of very many links is no hot task.
    """
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for k in range(most + 1):
        if _settled(edges):
            break
        if k == most:
            raise RuntimeError(f"components are not settled after {most} rounds")
        before, edges = edges, materialise(_small(_large(edges)))
        discard(before)
    tops = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(tops.select("node", F.col("node").alias("comp")))
