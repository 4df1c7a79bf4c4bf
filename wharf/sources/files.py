"""File and catalog sources (SRC-1 … SRC-15).

Readers take an explicit schema wherever the reference declares one: no
inference pass over 100 TB, and columns typed as the DDL says. Gzip files are
not splittable, so a folder of N ``.gz`` parts reads as N tasks; a single big
``.gz`` reads as one task and is repartitioned right after (SRC-6).
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOP_LEVEL = re.compile(r"^\$\.([A-Za-z_][A-Za-z0-9_]*)$")


def read_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
              rename: Mapping[str, str] | None = None,
              options: Mapping[str, str] | None = None) -> DataFrame:
    """SRC-1 / SRC-10: JSON lines loaded by key — each key fills the column of that name.

    Spark matches keys to a given schema case-sensitively (T-3), so the schema
    is given in the file's case and ``rename`` maps to the table's names.
    ``options`` go to the JSON reader (e.g. a timestamp format).
    """
    df = spark.read.options(**(options or {})).schema(schema).json(path)
    for src, dst in (rename or {}).items():
        df = df.withColumnRenamed(src, dst)
    return df


def read_json_paths(spark: SparkSession, path: str | Sequence[str],
                    columns: Sequence[tuple[str, str, str]]) -> DataFrame:
    """SRC-2: JSON lines loaded by a JSON path list — the i-th path fills the i-th column.

    ``columns`` is ``[(column, json_path, type), …]``. When every path is a
    top-level key the record is parsed once with ``json_tuple``; otherwise
    each path is extracted with ``get_json_object``.
    """
    text = spark.read.text(path)
    keys = [_TOP_LEVEL.match(p) for _, p, _ in columns]
    if all(keys):
        parsed = text.select(F.json_tuple("value", *[m.group(1) for m in keys]))
        return parsed.select(*[
            F.col(f"c{i}").cast(ty).alias(name) for i, (name, _, ty) in enumerate(columns)
        ])
    return text.select(*[
        F.get_json_object("value", p).cast(ty).alias(name) for name, p, ty in columns
    ])


def dated_prefix(key: str, run_date: dt.date | dt.datetime) -> str:
    """SRC-4: ``{key}/{year}/{month}/`` from the run date, month not zero-padded."""
    return f"{key.rstrip('/')}/{run_date.year}/{run_date.month}/"


def stage(spark: SparkSession, source: str, target: str, schema: T.StructType | str | None = None,
          json_paths: Sequence[tuple[str, str, str]] | None = None,
          run_date: dt.date | None = None, fmt: str = "parquet",
          table: str | None = None) -> DataFrame:
    """SRC-3: staging load ``(table, bucket, key, timestamped, json_path)``.

    Create + truncate + copy become one overwrite of ``target``; with
    ``table`` the data is also the catalog table of that name (created on the
    first load, replaced on the next). With ``run_date`` the source is the date
    prefix of SRC-4; with ``json_paths`` the load is positional (SRC-2),
    otherwise by key (SRC-1).
    """
    src = dated_prefix(source, run_date) if run_date else source
    if json_paths:
        df = read_json_paths(spark, src, json_paths)
    elif schema is not None:
        df = read_json(spark, src, schema)
    else:
        df = spark.read.json(src)
    w = df.write.mode("overwrite").format(fmt)
    if table:
        w.option("path", target).saveAsTable(table)
        return spark.table(table)
    w.save(target)
    return spark.read.format(fmt).load(target)


def read_month(spark: SparkSession, path: str, run_date: dt.date, fmt: str = "parquet") -> DataFrame:
    """SRC-4 on a ``year=/month=`` layout: the run date's month only.

    The equality on the partition columns becomes a partition filter, so only
    that month's folders are listed and read.
    """
    df = spark.read.format(fmt).load(path)
    return df.filter((F.col("year") == run_date.year) & (F.col("month") == run_date.month))


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
                   sep: str = ",", header: bool = False, repartition: int | None = None,
                   options: Mapping[str, str] | None = None, trailing_sep: bool = False) -> DataFrame:
    """SRC-5 / SRC-6 / SRC-7: delimited text, gzip or plain, with a declared schema.

    ``repartition`` is for a single unsplittable file (SRC-6): the read is one
    task, so spread the rows before any further work. ``options`` go to the
    CSV reader (e.g. a timestamp format). A malformed row fails the read unless
    ``options`` set another mode (:func:`malformed` counts such rows).
    ``trailing_sep``: every row ends with a separator.
    """
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    df = (spark.read.option("sep", sep).option("header", header).option("mode", "FAILFAST")
          .options(**(options or {})).schema(ddl + (", `_end` string" if trailing_sep else "")).csv(path))
    df = df.drop("_end")
    return df.repartition(repartition) if repartition else df


def ends_with_separator(spark: SparkSession, path: str | Sequence[str], sep: str) -> bool:
    """Whether the first row of a delimited text ends with the separator."""
    row = spark.read.text(path).first()
    return row is not None and row["value"].endswith(sep)


def malformed(spark: SparkSession, path: str | Sequence[str], schema: str, fmt: str = "csv",
              options: Mapping[str, str] | None = None) -> DataFrame:
    """``(rows, malformed)``: rows of a text source (``csv`` without a header, or
    ``json`` lines), and those that do not fit the schema."""
    given = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", **(options or {})}
    parse = F.from_csv if fmt == "csv" else F.from_json
    row = parse(F.col("value"), schema + ", `_bad` string", given)
    return (spark.read.text(path).select(row.alias("row"))
            .agg(F.count(F.lit(1)).alias("rows"), F.count("row._bad").alias("malformed")))


def load_tables(spark: SparkSession, tables: Mapping[str, tuple[str, T.StructType | str]],
                database: str | None = None, sep: str = "|",
                bucket_by: Mapping[str, tuple[Sequence[str], int]] | None = None,
                location: str | None = None) -> DataFrame:
    """SRC-7: load several delimited tables into the catalog, timing each.

    Each table is read with its schema and saved as a catalog table (bucketed
    when ``bucket_by`` names its key and bucket count), below ``location``
    when given (external tables), else in the warehouse. Returns a DataFrame
    of ``(table, load_seconds)`` — one row per table.
    """
    import time

    from wharf.sinks.writers import save_bucketed

    timings = []
    for name, (path, schema) in tables.items():
        full = f"{database}.{name}" if database else name
        t0 = time.perf_counter()
        df = read_delimited(spark, path, schema, sep=sep,
                            trailing_sep=ends_with_separator(spark, path, sep))
        target = f"{location.rstrip('/')}/{name}" if location else None
        if bucket_by and name in bucket_by:
            cols, n = bucket_by[name]
            save_bucketed(df, full, bucket_by=cols, buckets=n, sort_by=cols, path=target)
        else:
            w = df.write.mode("overwrite").format("parquet")
            (w.option("path", target) if target else w).saveAsTable(full)
        timings.append((name, time.perf_counter() - t0))
    return spark.createDataFrame(timings, "table string, load_seconds double")


def read_json_recursive(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8: inferred JSON, one record per line, all files below ``path``."""
    return (spark.read.option("multiLine", False).option("recursiveFileLookup", True)
            .json(path))


def read_catalog(spark: SparkSession, database: str | None, table: str) -> DataFrame:
    """SRC-9: a catalog table by database and name."""
    return spark.table(f"{database}.{table}" if database else table)


def create_external_json_table(spark: SparkSession, table: str, schema: T.StructType,
                               location: str, options: Mapping[str, str] | None = None) -> None:
    """SRC-10: external JSON table with declared columns over a path.

    ``options`` are reader options stored with the table (e.g. a timestamp
    format), applied whenever the table is read.
    """
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    opts = ""
    if options:
        def lit(v: str) -> str:
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        opts = " OPTIONS (" + ", ".join(f"{lit(k)} = {lit(v)}" for k, v in options.items()) + ")"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING json{opts} LOCATION '{location}'")


#: How this library writes and reads quoted CSV: quotes are doubled inside quotes, fields
#: may hold line ends, an empty field is an empty text and NULL has a mark of its own.
CSV_FORMAT = {"header": True, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\\N"}


def read_csv_dir(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 schema: T.StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    """SRC-11 (+ SET-1): every file of a folder, header skipped, all values as text
    (or of ``schema``).

    Fields may hold line ends, so a file is read by one task; ``multi_line=False``
    splits large files whose fields hold none. Unquoted empty fields are NULL.
    """
    reader = spark.read.options(**CSV_FORMAT).option("multiLine", multi_line)
    if columns and schema is None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """SRC-12: CSV with header and inferred types (one extra pass)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def list_files(spark: SparkSession, prefix: str, glob: str = "*") -> DataFrame:
    """SRC-13: ``(path, length)`` of the files under a prefix; contents not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True).load(prefix).select("path", "length"))


def sql_over(spark: SparkSession, query: str, mapping: Mapping[str, DataFrame]) -> DataFrame:
    """SRC-14: SQL over frames — each frame registered as a view under its name."""
    for name, df in mapping.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               options: Mapping[str, str] | None = None) -> DataFrame:
    """SRC-15: a tabular source (the question bank) as a DataFrame."""
    return spark.read.format(fmt).options(**(options or {})).load(path)
