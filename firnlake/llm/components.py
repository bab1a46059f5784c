"""Connected components of links, by alternating large and small stars over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (a, b): every neighbour is linked to the least one. Large: of greater neighbours, small: of lesser."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_m")).withColumn("_m", F.least("_a", "_m"))
    joined = both.join(least, F.col("a") == F.col("_a"))
    if large:
        return joined.filter("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(least.select(F.col("_a").alias("a"), F.col("_m").alias("b")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and root (the least node of its component) of every node of edges (a, b) that is not its own root."""
    edges = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        old, edges = edges, materialize(_star(_star(edges, True).filter("a <> b").distinct(), False).filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(old)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError(f"components were not found within {rounds} rounds")
