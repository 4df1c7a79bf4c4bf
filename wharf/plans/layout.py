"""Physical layout studies (PL-14, PL-15).

PL-14 writes the same star twice — plain Parquet, and bucketed + sorted on
the join key (the warehouse's DISTKEY / SORTKEY) — times each query on both
with a ``noop`` sink (full execution, no result cache, no collect), and
reports ``100 · (plain − bucketed) / plain``. The bucket column is a
parameter, so the study can reproduce the reference's mismatched key (T-19)
or use the key the queries join on.

PL-15 compares loading a folder of N gzip parts (N tasks) against one gzip
file (one task, then a repartition).

Timings are wall-clock on the driver; the report is one small row per query.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from wharf.functions import exprs as X
from wharf.sinks.writers import save_bucketed

QueryOnTables = Callable[[Mapping[str, DataFrame]], DataFrame]


def run_noop(df: DataFrame) -> float:
    """Execute ``df`` fully into the ``noop`` sink; seconds elapsed."""
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def write_plain(tables: Mapping[str, DataFrame], base: str) -> dict[str, str]:
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{base.rstrip('/')}/plain/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def write_bucketed(tables: Mapping[str, DataFrame], keys: Mapping[str, str], buckets: int,
                   base: str, prefix: str) -> dict[str, str]:
    """Bucketed + sorted catalog tables; tables without a key are written plain."""
    names = {}
    for name, df in tables.items():
        table = f"{prefix}_{name}"
        path = f"{base.rstrip('/')}/bucketed/{name}"
        if name in keys:
            save_bucketed(df, table, bucket_by=[keys[name]], buckets=buckets,
                          sort_by=[keys[name]], path=path)
        else:
            df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(table)
        names[name] = table
    return names


def compare_layouts(spark: SparkSession, queries: Mapping[str, QueryOnTables],
                    plain: Mapping[str, DataFrame], bucketed: Mapping[str, DataFrame],
                    repeats: int = 3, warmup: int = 1) -> DataFrame:
    """Median seconds per query on each layout and the % improvement (FN-14, JN-10)."""

    def timed(layout: Mapping[str, DataFrame]) -> list[tuple[str, float]]:
        out = []
        for name, q in queries.items():
            for _ in range(warmup):
                run_noop(q(layout))
            runs = sorted(run_noop(q(layout)) for _ in range(repeats))
            out.append((name, runs[len(runs) // 2]))
        return out

    a = spark.createDataFrame(timed(plain), "query string, time_plain double")
    b = spark.createDataFrame(timed(bucketed), "query string, time_bucketed double")
    return a.join(b, "query", "left").withColumn(
        "improvement_pct", X.improvement_pct("time_plain", "time_bucketed"))


def compare_loads(spark: SparkSession, sources: Mapping[str, str], schema: str,
                  sep: str = ";", spread: int | None = None) -> DataFrame:
    """PL-15 on existing files: load each source, report partitions and seconds.

    ``sources`` maps a label to a path (a folder or glob of gzip parts). A
    source that reads as one partition (a single unsplittable file) is
    repartitioned to ``spread`` tasks (default: the session's parallelism),
    as a load of one big file must be before any further work.
    """
    from wharf.sources.files import read_delimited

    spread = spread or spark.sparkContext.defaultParallelism
    rows = []
    for label, path in sources.items():
        loaded = read_delimited(spark, path, schema, sep=sep)
        n_in = loaded.rdd.getNumPartitions()
        t = run_noop(loaded.repartition(spread) if n_in == 1 else loaded)
        rows.append((label, n_in, t))
    return spark.createDataFrame(rows, "layout string, input_partitions int, load_seconds double")


def split_vs_single(spark: SparkSession, df: DataFrame, base: str, schema: str,
                    parts: int = 8, sep: str = ";") -> DataFrame:
    """PL-15: write ``df`` as ``parts`` gzip files and as one, load both, report.

    The single file is written by one task by construction — that is the
    slow path the study measures; do not use it for production loads.
    """
    split_dir = f"{base.rstrip('/')}/split"
    single_dir = f"{base.rstrip('/')}/single"
    w = lambda d: d.write.mode("overwrite").option("sep", sep).option("compression", "gzip")
    w(df.repartition(parts)).csv(split_dir)
    w(df.coalesce(1)).csv(single_dir)
    return compare_loads(spark, {"split": f"{split_dir}/part*", "single": f"{single_dir}/part*"},
                         schema, sep=sep, spread=parts)
