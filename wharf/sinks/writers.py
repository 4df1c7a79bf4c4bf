"""Sinks and table definition (SNK-1 … SNK-12).

Writes are bulk DataFrame writes: one task per partition, no row-at-a-time
inserts. Table DDL goes through the session catalog, so bucketed and sorted
layouts (the warehouse's DISTKEY / SORTKEY) are real Spark bucketed tables
that later joins on the bucket key read without an Exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.operators.quality import DataQualityError, check_record_schema, column_count_rule
from wharf.sources.files import CSV_FORMAT


def _existing(spark: SparkSession, path: str, fmt: str,
              schema: T.StructType | None = None) -> DataFrame | None:
    """The dataset at ``path``, or ``None`` if nothing has been written there.

    With ``schema`` the partition columns keep their declared types instead
    of being inferred from the folder names.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise


def overwrite(df: DataFrame, path: str, fmt: str = "parquet",
              partition_by: Sequence[str] = ()) -> None:
    """SNK-2 / SNK-10: truncate-then-insert as an overwrite of the path."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def persist(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write an intermediate table that later steps read, and return the re-read.

    A ``REBALANCE`` before the write lets adaptive execution cut the rows into
    partitions of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    (and split a skewed one), so the files are balanced whatever the source
    layout was — one huge source file or millions of small ones — and every
    later step that reads them, including a fan-out join, starts with even
    tasks.
    """
    overwrite(df.hint("rebalance"), path, fmt)
    return df.sparkSession.read.format(fmt).load(path)


def write_by_month(df: DataFrame, path: str, ts_ms_col: str = "ts", mode: str = "append",
                   fmt: str = "parquet") -> None:
    """SRC-4 as a layout: ``year=/month=`` partitions from an epoch-ms column.

    A run for one date then reads its month only (partition pruning, see
    :func:`wharf.sources.files.read_month`) instead of listing a date prefix.
    """
    ts = F.timestamp_millis(F.col(ts_ms_col))
    # Rows of a month meet before the write, so a month has few files; a large month is split.
    (df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts)).hint("rebalance", "year", "month")
     .write.mode(mode).format(fmt).partitionBy("year", "month").save(path))


def append(df: DataFrame, path: str, fmt: str = "parquet",
           partition_by: Sequence[str] = ()) -> None:
    """SNK-1 / SNK-3: ``INSERT INTO … SELECT`` without truncate."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_new(df: DataFrame, path: str, key: str, fmt: str = "parquet",
               partition_by: Sequence[str] = ()) -> None:
    """SNK-1 with ``dedupe_on``: append only rows not yet in the target (T-11).

    A row is known by its key or, where the key is NULL, by all its columns. Of
    rows of one batch that are known alike the smallest (in column order) is
    kept, and none if the target holds one; so the result of a rerun or of a
    replayed batch is the same. With ``partition_by`` (e.g. the event date) the target is
    partitioned on write and only the partitions the batch touches are probed
    (a semi join on the partition columns, which dynamic partition pruning
    turns into a partition filter on the target's scan), so an hourly run
    does not read the whole fact's key column. Single writer per target.
    """
    target = _existing(df.sparkSession, path, fmt, schema=df.schema)
    if target is not None:
        present = target
        if partition_by:
            touched = df.select(*partition_by).distinct()
            present = present.join(touched, list(partition_by), "left_semi")
    else:
        present = df.limit(0)
    batch, keyed = df.columns, F.col(key).isNotNull()
    others = [c for c in batch if c != key]
    rows = (df.filter(keyed).groupBy(key).agg(F.min(F.struct(*others)).alias("_row"))
            .select(key, "_row.*").select(*batch))
    rows = rows.join(present.select(key).distinct(), key, "left_anti").select(*batch)
    # EXCEPT compares all columns, NULL with NULL, and keeps one of equal rows.
    unkeyed = df.filter(~keyed).subtract(present.filter(~keyed).select(*batch))
    append(rows.unionByName(unkeyed), path, fmt, partition_by=partition_by)


def save_json_table(df: DataFrame, table: str, path: str, mode: str = "append",
                    partition_keys: Sequence[str] = (),
                    options: Mapping[str, str] | None = None) -> None:
    """SNK-4: JSON files at ``path`` that are also a catalog table.

    The table is created on the first write and appended (or replaced) on
    later ones, optionally partitioned; the column-count rule runs first
    (DQ-7).
    """
    column_count_rule(df)
    w = df.write.format("json").options(**(options or {})).option("path", path).mode(mode)
    if partition_keys:
        w = w.partitionBy(*partition_keys)
    w.saveAsTable(table)


def quoted_csv(df: DataFrame, path: str, header: bool = True, files: int | None = None) -> None:
    """SNK-5: CSV with every field quoted, as :func:`wharf.sources.files.read_csv_dir`
    reads it back. ``files`` merges to that many files without a shuffle
    (``coalesce``); leave it ``None`` at scale."""
    out = df.coalesce(files) if files else df
    (out.write.mode("overwrite").options(**CSV_FORMAT | {"header": header}).option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def create_table(spark: SparkSession, table: str, schema: T.StructType | str, *,
                 path: str | None = None, fmt: str = "parquet",
                 bucket_by: Sequence[str] = (), buckets: int = 0,
                 sort_by: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
    """SNK-7: ``CREATE TABLE`` from a spec, with optional bucket and sort keys.

    DISTKEY becomes ``CLUSTERED BY (key) INTO n BUCKETS``, SORTKEY becomes
    ``SORTED BY``; a composite primary key becomes bucketing on the partition
    key and sorting on the clustering key.
    """
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
    )
    sql = f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING {fmt}"
    if partition_by:
        sql += f" PARTITIONED BY ({', '.join(partition_by)})"
    if bucket_by:
        sql += f" CLUSTERED BY ({', '.join(bucket_by)})"
        if sort_by:
            sql += f" SORTED BY ({', '.join(sort_by)})"
        sql += f" INTO {buckets} BUCKETS"
    if path:
        sql += f" LOCATION '{path}'"
    spark.sql(sql)


def save_bucketed(df: DataFrame, table: str, bucket_by: Sequence[str], buckets: int,
                  sort_by: Sequence[str] = (), path: str | None = None,
                  mode: str = "overwrite") -> None:
    """SNK-7 from a DataFrame: ``bucketBy().sortBy().saveAsTable()``.

    Each write task emits one file per bucket it holds. A ``REBALANCE`` on
    the bucket key into ``buckets`` partitions makes that about one file per
    bucket, and — unlike ``repartition`` — lets adaptive execution split a
    partition that a hot key made large across several tasks (a bucket may
    hold several files), so one key with a third of the rows does not write
    through one task.
    """
    w = df.hint("rebalance", buckets, *bucket_by).write.mode(mode).format("parquet")
    if path:
        w = w.option("path", path)
    w = w.bucketBy(buckets, *bucket_by)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(table)


def drop_tables(spark: SparkSession, tables: Sequence[str]) -> None:
    """SNK-9: ``DROP TABLE IF EXISTS`` for every table of a schema map."""
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def truncate_table(spark: SparkSession, table: str) -> None:
    """SNK-10: ``TRUNCATE TABLE``.

    Spark refuses TRUNCATE on external (path-backed) tables; those are
    overwritten with an empty frame of the table's schema instead.
    """
    ext = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(
        (F.col("col_name") == "Type") & (F.col("data_type") == "EXTERNAL")).count() > 0
    if not ext:
        spark.sql(f"TRUNCATE TABLE {table}")
        return
    empty = spark.createDataFrame([], spark.table(table).schema)
    empty.write.insertInto(table, overwrite=True)


def use_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """SNK-11: ``CREATE DATABASE IF NOT EXISTS`` then ``USE``."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")
    spark.sql(f"USE {name}")


def append_record(df: DataFrame, record: Mapping[str, object], schema: T.StructType | None = None,
                  explode_lists: Sequence[str] = ()) -> DataFrame:
    """SNK-12 / SET-2 / DQ-12: ``df`` plus one new record, union by column name.

    The record is checked against ``schema`` (required fields present; extra
    fields are dropped). A list value in one of ``explode_lists`` becomes one
    row per element, matching the table's scalar column (T-16); an empty list
    is rejected.
    """
    schema = schema or df.schema
    check_record_schema(record, schema)
    rows = [dict(record)]
    for c in explode_lists:
        value = record.get(c)
        if isinstance(value, (list, tuple)):
            if not value:
                raise DataQualityError(f"{c} must not be empty")
            rows = [{**r, c: v} for r in rows for v in value]
    known = [f.name for f in schema.fields]
    new = df.sparkSession.createDataFrame(
        [tuple(r.get(n) for n in known) for r in rows], schema
    )
    return df.unionByName(new.select(*[F.col(c) for c in df.columns if c in known]),
                          allowMissingColumns=True)
