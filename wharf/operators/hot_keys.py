"""Hot keys from a mergeable summary kept with a staging table (JN-1, JN-7).

:func:`wharf.operators.joins.salted_join` finds hot keys by counting all rows of
the right side, for every join anew. Here each load leaves a summary of its
frequent keys behind (a frequent-items sketch of bounded size), summaries of
loads are merged by an aggregate, and a join asks the merged one. Its answer is a
list of at most ``k`` keys, so no side of the join is shuffled for it, and if
there is none the join is the plain one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharf.operators.joins import key_condition, salted_join


def summarise(df: DataFrame, key: str, tracked: int = 10_000) -> DataFrame:
    """One row: the rows with a key, and the sketch of the ``tracked`` most frequent ones at most (as text)."""
    text = F.col(key).cast("string")
    return df.filter(text.isNotNull()).select(text.alias("k")).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(k, {tracked})").alias("sketch"))


class HotKeys:
    """The summaries of a staging table's loads, stored below ``path``."""

    def __init__(self, spark: SparkSession, path: str, tracked: int = 10_000):
        self.spark, self.path, self.tracked = spark, path.rstrip("/"), tracked

    def add(self, load: str, df: DataFrame, key: str) -> None:
        """The summary of one load; a repeated load replaces it."""
        summarise(df, key, self.tracked).write.mode("overwrite").parquet(f"{self.path}/load={load}")

    def hot(self, more_than: int, k: int = 1000) -> list[str]:
        """The keys (as text) that more than ``more_than`` rows of all loads have, ``k`` at most.

        The sketch may err by a share of 1 / ``tracked`` of all rows; a key that is
        judged wrong costs time, never a row of a join."""
        merged = self.spark.read.parquet(self.path).agg(
            F.expr(f"approx_top_k_combine(sketch, {self.tracked})").alias("sketch"))
        found = merged.select(F.expr(f"inline(approx_top_k_estimate(sketch, {k}))"))
        return sorted(r["item"] for r in found.filter(F.col("count") > more_than).collect())


def join_with_hot_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot: Sequence[str],
                       how: str = "left", buckets: int = 16) -> DataFrame:
    """:func:`salted_join` with the hot keys of the right side known; without any, the plain join."""
    if not hot:
        return left.join(right, key_condition(left, right, [left_key], [right_key]), how)
    return salted_join(left, right, [left_key], [right_key], how=how, buckets=buckets, hot=list(hot))
