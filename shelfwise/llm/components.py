"""Connected components of an undirected graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.workspace import deleted, written


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))


def connected_components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """node, root (the smallest node that it reaches) for every node in edges a, b (longs); root itself has no row.

    Each round hangs neighbours on the smallest node that either end sees, by joins on least neighbours, so nothing is
    gathered for a node; each round's edges are written. Rounds grow with the logarithm of the longest path. Loops and
    repeated edges do no harm; edges with a null are no edges; no edges give no rows.
    """
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    last = None
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, e = e, written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        deleted(before)
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = state
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
