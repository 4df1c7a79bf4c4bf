"""Projections and filters (PRJ-1 … PRJ-7, FLT-1 … FLT-13).

Thin, declarative helpers: every one returns a Catalyst expression, so column
pruning and predicate pushdown reach the Parquet scan unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_map(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """PRJ-1 / PRJ-7: target column → source expression (SQL text or Column)."""
    return df.select(
        *[(F.expr(e) if isinstance(e, str) else e).alias(name) for name, e in mapping.items()]
    )


def with_derived_first(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """PRJ-4: ``SELECT expr AS name, *``."""
    return df.select(expr.alias(name), *[F.col(f"`{c}`") for c in df.columns])


def drop_fields(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """PRJ-5: drop the named columns."""
    return df.drop(*paths)


def all_of(preds: Sequence[Column | str]) -> Column:
    """FLT-4: AND of the constraints of every source table used."""
    cols = [F.expr(p) if isinstance(p, str) else p for p in preds]
    return reduce(lambda a, b: a & b, cols) if cols else F.lit(True)


def non_empty(col: str) -> Column:
    """FLT-10: skip rows whose value is NULL or the empty string."""
    return F.col(col).isNotNull() & (F.col(col) != F.lit(""))


def in_list_and_equal(list_col: str, values: Sequence[str], eq_col: str, eq_value: str) -> Column:
    """FLT-9: ``list_col IN (values) AND eq_col = eq_value``."""
    return F.col(list_col).isin(list(values)) & (F.col(eq_col) == F.lit(eq_value))


def key_lookup(df: DataFrame, key: Mapping[str, object]) -> DataFrame:
    """FLT-12 / FLT-13: conjunctive equality on (a prefix of) the primary key.

    On a table bucketed on the partition key (SNK-7) Spark prunes to one
    bucket; on Parquet the equality is pushed to row-group min/max statistics.
    """
    return df.filter(all_of([F.col(c) == F.lit(v) for c, v in key.items()]))
