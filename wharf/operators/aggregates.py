"""Aggregation and distinct (AGG-1 … AGG-13).

All aggregates here are algebraic (count, sum, max, max_by), so Spark runs a
partial aggregation on the map side before the shuffle: a group that holds a
third of the rows costs one partial row per input partition, not a third of
the data in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharf.functions import exprs as X


def count_by(df: DataFrame, keys: Sequence[str | Column], alias: str = "count") -> DataFrame:
    """AGG-1: ``SELECT keys, COUNT(*) … GROUP BY keys``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def count_all(df: DataFrame, alias: str = "count") -> DataFrame:
    """AGG-2: global ``COUNT(*)`` as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def duplicate_count(col: str) -> Column:
    """AGG-3: ``COUNT(col) - COUNT(DISTINCT col)``; 0 means unique."""
    return F.count(F.col(col)) - F.count_distinct(F.col(col))


def collapse(df: DataFrame, key: str | Sequence[str], exprs: Mapping[str, Column]) -> DataFrame:
    """AGG-4 / AGG-5 / AGG-9: one row per key, attributes collapsed by ``exprs``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*[e.alias(name) for name, e in exprs.items()])


def paid_wins(level: str | Column = "level") -> Column:
    """AGG-5: a group with a paid member is paid, any other is free."""
    return F.max(X.paid_or_free(level))


def distinct_rows(df: DataFrame, cols: Sequence[str | Column] | None = None) -> DataFrame:
    """AGG-10 / AGG-11: ``SELECT DISTINCT cols`` (all columns when ``None``)."""
    return (df.select(*cols) if cols else df).distinct()


def distinct_count(df: DataFrame, cols: Sequence[str], alias: str = "n") -> DataFrame:
    """AGG-12: number of distinct tuples of ``cols`` as a one-row frame.

    Deduplicates with a shuffle on the tuple (map-side partial first) and
    counts the groups; nothing is collected.
    """
    return df.select(*cols).distinct().agg(F.count(F.lit(1)).alias(alias))


def exact_sum(value: Column, result_type: str = "double") -> Column:
    """Sum of exact decimal products, cast at the end (T-21)."""
    return F.sum(value).cast(result_type)
