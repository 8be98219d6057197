"""Connected components by alternating large and small stars, as DataFrame joins.

Every round is written to the shared folder and read back, so lineage stays
short and a lost executor costs one round at most.  Hubs are safe: minima are
pre-aggregated before the shuffle and joins may be split by the optimizer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veilspark.sources.stage import drop_stage, stage_path, staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a"), F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger to the smaller node."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of an edge list ``a, b``; the root is the
    smallest node of the component, and its own row is included.  Self loops
    and repeated edges do no harm; nulls must be gone."""
    spark = edges.sparkSession
    start = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    path = stage_path(spark)
    now = staged(start, path)
    alone = now.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    now = now.filter("a != b")
    paths: list[str] = []
    before = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or before == tuple(mark):
            break
        before = tuple(mark)
        path = stage_path(spark)
        now = staged(_small_star(_large_star(now)), path)
        for old in paths:
            drop_stage(spark, old)
        paths = [path]
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).union(alone).groupBy("node").agg(F.min("root").alias("root"))
