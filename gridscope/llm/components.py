"""Connected components by alternating stars, each step written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscope.sources.tables import cut_lineage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node (the larger or the smaller ones) on its least neighbour."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    joined = both.join(least, F.col("a") == F.col("c"))
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select(F.col("c").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for the nodes of edges (a, b), save the roots."""
    now = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        now = cut_lineage(_stars(_stars(now, large=True), large=False), "stars")
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
