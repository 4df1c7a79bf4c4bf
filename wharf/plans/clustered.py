"""A layout clustered by several columns, with skipping (SNK-7, PL-14, T-19).

Buckets help the join on one key. Here the fact's rows are laid out by the
interleaved bits of several columns (Z order), so that each file has a narrow
range of every one of them, and a query reads the files whose ranges meet its
filters. A filter on a dimension becomes a range of the fact's key first: the
least and the greatest key of the dimension rows that qualify.

Each column is cut at sampled quantiles into 2^bits ranges of about as many rows
each, whatever its values are. The rows of a Z value that is too frequent for one
file are spread over several. The ranges of every file are stored beside the
data; within a file rows are in the same order, so the row groups' own statistics
skip further.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Error of the quantiles, as a share of all rows.
_QUANTILE_ERROR = 0.002

Range = tuple[float, float]


@dataclass(frozen=True)
class Skipped:
    """The files of a clustered table that a query reads, of all that there are."""

    rows: DataFrame
    files: list[str]
    all_files: int


def quantile_bounds(df: DataFrame, cols: Sequence[str], bits: int) -> dict[str, list[float]]:
    """2^bits - 1 bounds for each column, from one pass (a mergeable sketch)."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    return dict(zip(cols, df.approxQuantile(list(cols), shares, _QUANTILE_ERROR)))


def range_number(col: Column, bounds: Sequence[float]) -> Column:
    """How many bounds are at most the value, by binary search; 0 for NULL."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(col >= F.lit(bounds[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(bounds))


def z_value(cols: Sequence[str], bounds: Mapping[str, Sequence[float]], bits: int) -> Column:
    """The columns' range numbers with their bits interleaved, the first column's leading."""
    z = F.lit(0).cast("long")
    for i, c in enumerate(cols):
        number = range_number(F.col(c), bounds[c]).cast("long")
        for b in range(bits):
            bit = F.shiftright(number, b).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, b * len(cols) + len(cols) - 1 - i))
    return z


def write_clustered(df: DataFrame, path: str, cols: Sequence[str], files: int, bits: int = 6,
                    row_group_bytes: int = 16 << 20) -> None:
    """Write ``df`` in Z order of ``cols`` (numbers) as about ``files`` files, with their ranges."""
    if not 0 < bits * len(cols) < 63:
        raise ValueError("bits of all columns must fit into one number")
    base, bounds = path.rstrip("/"), quantile_bounds(df, cols, bits)
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    (df.withColumn("_z", z_value(cols, bounds, bits)).withColumn("_spread", spread)
     # Range bounds are sampled; the second column lets a frequent Z value go to several files.
     .repartitionByRange(files, "_z", "_spread").sortWithinPartitions("_z").drop("_z", "_spread")
     .write.option("parquet.block.size", row_group_bytes).parquet(f"{base}/data"))
    data = df.sparkSession.read.schema(df.schema).parquet(f"{base}/data")
    ends = [f(c).alias(f"{name}_{i}") for i, c in enumerate(cols) for name, f in (("low", F.min), ("high", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(cols)]
    (data.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends, *nulls)
     .write.parquet(f"{base}/ranges"))


def dimension_range(dim: DataFrame, key: str) -> Range | None:
    """The least and the greatest key of the rows of a (filtered) dimension; None if there are none."""
    row = dim.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    return None if row["low"] is None else (row["low"], row["high"])


def read_clustered(spark: SparkSession, path: str, cols: Sequence[str], ranges: Mapping[str, Range | None]) -> Skipped:
    """The rows whose columns are within ``ranges`` (inclusive; None: no row), from the files that may hold one."""
    base = path.rstrip("/")
    stored = spark.read.parquet(f"{base}/ranges")
    wanted = F.lit(True)
    for c, r in ranges.items():
        i = list(cols).index(c)
        wanted &= F.lit(False) if r is None else (F.col(f"high_{i}") >= F.lit(r[0])) & (F.col(f"low_{i}") <= F.lit(r[1]))
    files = sorted(unquote(r["file"]) for r in stored.filter(wanted).select("file").collect())
    everything = spark.read.parquet(f"{base}/data")
    rows = spark.read.schema(everything.schema).parquet(*files) if files else everything.limit(0)
    for c, r in ranges.items():
        if r is not None:
            rows = rows.filter(F.col(c).between(*r))
    return Skipped(rows, files, stored.count())
