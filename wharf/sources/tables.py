"""Reading the driver's Parquet tables.

Every reader returns a lazy DataFrame over the whole file; callers project and
filter afterwards and Catalyst pushes both into the scan (``ReadSchema`` and
``PushedFilters`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a DataFrame (schema from the Parquet footer)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Attribute access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return load(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def register_views(self, names: tuple[str, ...] = TABLES) -> None:
        """SRC-14: expose the tables to ``spark.sql`` as temporary views."""
        for name in names:
            load(self.spark, self.sf_dir, name).createOrReplaceTempView(name)
