"""Identity that goes on over loads (SNK-8 on a table that is appended to).

:func:`wharf.operators.surrogate.dense_ids` numbers one frame. Here each load
reserves the range that follows the last one in a ledger, in one commit, and its
rows are numbered within it: no gap and no overlap over any number of loads, and
none of the rows already there is read. A load keeps its range: repeated after a
failure, or by mistake, it writes the same ids to the same place.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wharf.operators.surrogate import dense_ids
from wharf.session import scratch_path
from wharf.sinks.commits import CommitConflict, CommitLog


@dataclass(frozen=True)
class IdRange:
    """``count`` ids from ``first``."""

    first: int
    count: int


class IdentityLedger:
    """The ranges of ids reserved so far, below ``path``; ``IDENTITY(start, 1)``."""

    def __init__(self, spark: SparkSession, path: str, start: int = 0):
        self.log, self.start = CommitLog(spark, path), start

    def reserve(self, load: str, count: int, attempts: int = 20) -> IdRange:
        """The range of a load; the next free one if it has none. Loads may reserve at the same time."""
        for _ in range(attempts):
            held = self.log.named(load)
            if held:
                if held["count"] != count:
                    raise ValueError(f"load {load!r} has {held['count']} ids, not {count}")
                return IdRange(held["first"], held["count"])
            last = self.log.last()
            number, first = (last[0] + 1, last[1]["first"] + last[1]["count"]) if last else (0, self.start)
            try:
                self.log.add(number, {"first": first, "count": count}, name=load)
                return IdRange(first, count)
            except CommitConflict:
                continue  # another load was first: take the range after its
        raise CommitConflict(f"no range for load {load!r} after {attempts} attempts")

    def ranges(self) -> list[IdRange]:
        return [IdRange(e["first"], e["count"]) for e in map(self.log.entry, self.log.numbers())]


def append_with_ids(df: DataFrame, path: str, ledger: IdentityLedger, load: str, order_cols: Sequence[str],
                    col: str = "id") -> IdRange:
    """Append ``df`` to the table at ``path`` with the load's ids, in the order of ``order_cols``.

    ``order_cols`` should order the rows fully, or a repeated load may number rows
    that tie otherwise. A load's rows are one partition, which a repeated load
    replaces."""
    spark, staged = df.sparkSession, scratch_path(df.sparkSession, "identity-load")
    df.write.parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged)
    ids = ledger.reserve(load, rows.count())
    dense_ids(rows, order_cols, col=col, start=ids.first).write.mode("overwrite").parquet(f"{path.rstrip('/')}/_load={load}")
    return ids


def read_with_ids(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all loads."""
    return spark.read.option("basePath", path).parquet(path).drop("_load")
