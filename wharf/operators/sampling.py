"""Random sample of exactly n rows (SMP-1, DQ-10).

``orderBy(rand(seed)).limit(n)`` plans as ``TakeOrderedAndProject``: each
partition keeps its n smallest random keys and one task merges n × P rows, so
the cost is one scan plus a tiny merge regardless of table size. The sample is
checkpointed to the shared folder before it is counted, so the check and the
returned rows are the same draw even if an executor is lost.
"""

from __future__ import annotations

import random
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharf.session import checkpoint_dir


class SampleError(ValueError):
    """Fewer rows than requested, or a size outside the allowed set."""


def check_allowed(value: int, allowed: Iterable[int]) -> None:
    """DQ-10: a driver-side argument check (e.g. n in 5, 10, 20)."""
    allowed = tuple(allowed)
    if value not in allowed:
        raise SampleError(f"{value} is not one of {allowed}")


def sample_exact(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """n rows drawn uniformly without replacement; raises if fewer exist.

    Without a seed every call draws anew."""
    seed = random.SystemRandom().getrandbits(62) if seed is None else seed
    checkpoint_dir(df.sparkSession)
    picked = (
        df.withColumn("_r", F.rand(seed))
        .orderBy("_r")
        .limit(n)
        .drop("_r")
        .checkpoint(eager=True)
    )
    got = picked.count()
    if got < n:
        raise SampleError(f"asked for {n} rows, only {got} match")
    return picked
