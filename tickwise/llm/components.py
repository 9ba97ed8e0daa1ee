"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("w")).select(
        F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    moved = down.join(least, F.col("u") == F.col("w")).filter("v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the component's least node) for the nodes of ``edges`` (u, v) but the
    roots themselves.  The edges shrink to stars in a few rounds, each one staged."""
    state, edges = None, staged(edges.filter("u <> v").distinct(), "edges")
    while True:
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state or not new[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state, edges = new, staged(_small_star(_large_star(edges)), "edges")
