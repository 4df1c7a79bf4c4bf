"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.filter(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") > F.col("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    kids = down.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return kids.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(spark: SparkSession, edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """(node, root) for every node of the long pairs (a, b); root: its smallest node.

    Each round is written to the shared scratch folder (by at most `tasks` tasks),
    which cuts lineage. Only the count and a checksum of the edges come to the driver.
    """
    def written(frame: DataFrame) -> tuple[DataFrame, tuple]:
        path = scratch_path(spark, "star")
        (frame.coalesce(tasks) if tasks else frame).write.parquet(path)
        frame = spark.read.parquet(path)
        h = F.xxhash64("a", "b")
        got = frame.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first()
        return frame, tuple(got)

    edges, mark = written(edges.select("a", "b").filter(F.col("a") != F.col("b"))
                          .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while mark[0]:
        edges, now = written(_small_star(_large_star(edges)))
        if now == mark:
            break
        mark = now
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
