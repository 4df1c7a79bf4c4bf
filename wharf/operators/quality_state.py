"""Data-quality checks by increment (DQ-1 … DQ-5 on a table that is loaded again and again).

:func:`wharf.operators.quality.run_suite` measures whole tables. Here every load
leaves its measures behind (rows, NULLs of each checked column, rows with a
key), which add up, and its new keys go to a :class:`KeyedTable`, whose key
ranges and Bloom filters say in which files a key of the load may be stored
already; those candidates are compared exactly. So a report costs the new load
and a sum over small rows, and equals the suite over everything loaded so far.

A load has a name (such as its date). Loading a name again changes nothing, also
if the first attempt died between its steps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharf.operators.quality import TableChecks, _measures, _passed
from wharf.sinks.keyed_table import Commit, KeyedTable, Layout

_REPEATS = ": repeats of "


class CheckState:
    """The stored state of the checks of one table below ``path``."""

    def __init__(self, spark: SparkSession, path: str, spec: TableChecks, layout: Layout = Layout()):
        self.spark, self.path, self.spec, self.layout = spark, path.rstrip("/"), spec, layout

    def _plain(self) -> list:
        """The measures that add up over loads: all but the repeats of the key."""
        return [m for m in _measures(self.spec) if _REPEATS not in m[0]]

    def add(self, load: str, rows: DataFrame) -> Commit | None:
        """Take in the rows of one load; only they, and the keys that may be repeated, are read."""
        key, commit = self.spec.key, None
        aggregates = [m.cast("bigint").alias(f"m{i}") for i, (_, m, _, _) in enumerate(self._plain())]
        if key:
            keys = rows.filter(F.col(key).isNotNull()).select(key)
            commit = KeyedTable(self.spark, f"{self.path}/keys", [key], keys.schema, self.layout).insert_new(keys, tag=load)
            aggregates += [F.count(key).alias("keyed"), F.lit(commit.rows_new).cast("bigint").alias("new_keys")]
        # Written last: a load counts once its keys are stored. A repeated load has the same figures.
        rows.agg(*aggregates).write.mode("overwrite").parquet(f"{self.path}/measures/load={load}")
        return commit

    def report(self) -> DataFrame:
        """(check, actual, passed) over all loads, as :func:`run_suite` gives for one table."""
        loads = self.spark.read.parquet(f"{self.path}/measures")
        added = [F.sum(f"m{i}") for i in range(len(self._plain()))]
        if self.spec.key:
            added.append(F.sum("keyed") - F.sum("new_keys"))
        measures = [*self._plain(), *[m for m in _measures(self.spec) if _REPEATS in m[0]]]
        sums = loads.agg(*[a.alias(f"s{i}") for i, a in enumerate(added)])
        rows = [F.struct(F.lit(name).alias("check"), F.col(f"s{i}").alias("actual"), F.lit(cmp).alias("comparison"),
                         F.lit(expected).cast("bigint").alias("expected")) for i, (name, _, cmp, expected) in enumerate(measures)]
        out = sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        return out.select("check", "actual", _passed(F.col("actual"), F.col("comparison"), F.col("expected")).alias("passed"))


def add_load(spark: SparkSession, path: str, load: str, tables: Mapping[str, DataFrame], specs: Sequence[TableChecks],
             layout: Layout = Layout()) -> dict[str, Commit | None]:
    """One load of several tables into their states."""
    return {s.table: CheckState(spark, f"{path}/{s.table}", s, layout).add(load, tables[s.table]) for s in specs}


def report(spark: SparkSession, path: str, specs: Sequence[TableChecks]) -> DataFrame:
    """The suite's report over all loads so far."""
    return reduce(DataFrame.unionByName, [CheckState(spark, f"{path}/{s.table}", s).report() for s in specs])
