"""Window, sort and limit operators (WIN-1, WIN-2, SRT-1 … SRT-4, LIM-1, LIM-2).

Top-N per group is written as ``row_number() … <= n``; Catalyst's
``InferWindowGroupLimit`` then inserts a partial ``WindowGroupLimit`` below the
shuffle, so each map task sends at most ``n`` rows per group and a huge group
never reaches one task whole. Global top-k is ``orderBy().limit(k)``, planned
as ``TakeOrderedAndProject`` (per-partition top-k, then a k·P merge).

Ties: the warehouse breaks ties arbitrarily (T-7); here the caller passes
tie-breaker columns so results are deterministic and comparable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _asc(c: str | Column) -> Column:
    """Ascending, NULLs last — the warehouse default (T-6)."""
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def _desc(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_last()


def order_spec(desc: Sequence[str | Column] = (), asc: Sequence[str | Column] = ()) -> list[Column]:
    """Descending keys first, then ascending tie-breakers (SRT-1 … SRT-3)."""
    return [_desc(c) for c in desc] + [_asc(c) for c in asc]


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                    n: int, rank_col: str = "rank") -> DataFrame:
    """WIN-1 + WIN-2: ``ROW_NUMBER() OVER (PARTITION BY g ORDER BY …) <= n``."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """LIM-1: ``ORDER BY … LIMIT k``."""
    return df.orderBy(*order).limit(k)


def sort_asc(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """SRT-2: ascending with NULLs last (T-6)."""
    return df.orderBy(*[_asc(c) for c in cols])


def clustered(df: DataFrame, partition_cols: Sequence[str], clustering_cols: Sequence[str]) -> DataFrame:
    """SRT-4: rows of one partition key together, ordered by the clustering key.

    A ``REBALANCE`` on the partition key, then a sort inside each partition;
    no global sort, so it scales with the number of partitions. Unlike
    ``repartition(key)``, the rebalance lets adaptive execution split a key
    that holds too many rows for one task across several tasks (each part
    still sorted by the clustering key) instead of sending it to one.
    """
    return df.hint("rebalance", *partition_cols).sortWithinPartitions(
        *partition_cols, *clustering_cols
    )
