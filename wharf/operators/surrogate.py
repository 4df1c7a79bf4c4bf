"""Surrogate keys (SNK-8): ``IDENTITY(0,1)`` and sequence defaults.

* :func:`unique_ids` — ``monotonically_increasing_id()``: unique, increasing
  within a partition, with gaps; no shuffle, no second pass.
* :func:`dense_ids` — gap-free ``0 … n-1`` in the order of the given columns,
  equal to ``row_number() OVER (ORDER BY cols) - 1``, computed without
  pulling all rows into one partition: the frame is range-partitioned and
  sorted, checkpointed (so both passes see the same partitioning), rows are
  counted per partition, and a running sum over the per-partition counts
  (one row per partition — bounded by the partition count, so it is broadcast)
  gives each partition its offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wharf.session import checkpoint_dir

# monotonically_increasing_id() puts the partition index in the upper 31 bits.
_PARTITION_SHIFT = 33


def unique_ids(df: DataFrame, col: str = "id") -> DataFrame:
    """Unique 64-bit ids with gaps (partition index << 33 | row index)."""
    return df.withColumn(col, F.monotonically_increasing_id())


def dense_ids(df: DataFrame, order_cols: Sequence[str], col: str = "id",
              start: int = 0) -> DataFrame:
    """Gap-free ids in ``order_cols`` order, without a single-partition window."""
    checkpoint_dir(df.sparkSession)  # make sure a shared folder is registered
    ordered = (
        df.orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    with_pos = ordered.withColumn("_part", F.shiftright("_mid", _PARTITION_SHIFT)).withColumn(
        "_pos", F.col("_mid") - F.shiftleft(F.col("_part"), _PARTITION_SHIFT)
    )
    offsets = (
        with_pos.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_offset",
            F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select("_part", F.coalesce("_offset", F.lit(0)).alias("_offset"))
    )
    return (
        with_pos.join(F.broadcast(offsets), "_part")
        .withColumn(col, F.col("_offset") + F.col("_pos") + F.lit(start))
        .drop("_mid", "_part", "_pos", "_offset")
    )
