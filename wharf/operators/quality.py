"""Data-quality checks (DQ-1 … DQ-13).

Checks are data: a name, a measured value and a pass rule. Measuring is a
Spark aggregation; one pass per table computes all of that table's measures
(row count, NULL counts, duplicate counts), and the report is a DataFrame of
``(check, actual, passed)`` rows, so nothing but the final scalars ever
reaches the driver — and only when :func:`raise_on_failure` asks for them.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.operators.aggregates import duplicate_count

# The comparison operators a check may use (DQ-6).
COMPARISONS: dict[str, Callable[[object, object], bool]] = {
    "==": operator.eq,
    "!=": operator.ne,
    ">": operator.gt,
    "<": operator.lt,
    ">=": operator.ge,
    "<=": operator.le,
}


class DataQualityError(ValueError):
    """A check failed, returned no rows, or used an unknown comparison."""


# --- per-table measures (DQ-1 … DQ-5) ----------------------------------------------


@dataclass(frozen=True)
class TableChecks:
    """Checks of one table: non-empty, key not NULL, key unique, extra not-NULLs."""

    table: str
    key: str | None = None
    not_null: Sequence[str] = field(default_factory=tuple)


def _measures(spec: TableChecks) -> list[tuple[str, Column, str, int]]:
    """(check name, measure, comparison, expected) for one table."""
    out: list[tuple[str, Column, str, int]] = [
        (f"{spec.table}: rows", F.count(F.lit(1)), ">", 0)
    ]
    null_cols = ([spec.key] if spec.key else []) + [c for c in spec.not_null if c != spec.key]
    for c in null_cols:
        out.append((f"{spec.table}: NULLs in {c}", F.count_if(F.col(c).isNull()), "==", 0))
    if spec.key:
        out.append((f"{spec.table}: repeats of {spec.key}", duplicate_count(spec.key), "==", 0))
    return out


def check_table(df: DataFrame, spec: TableChecks) -> DataFrame:
    """All checks of one table in one aggregation pass → report rows."""
    measures = _measures(spec)
    wide = df.agg(*[m.cast("bigint").alias(f"_m{i}") for i, (_, m, _, _) in enumerate(measures)])
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            F.col(f"_m{i}").alias("actual"),
            F.lit(cmp).alias("comparison"),
            F.lit(expected).cast("bigint").alias("expected"),
        )
        for i, (name, _, cmp, expected) in enumerate(measures)
    ]
    return (
        wide.select(F.explode(F.array(*rows)).alias("r"))
        .select("r.*")
        .withColumn("passed", _passed(F.col("actual"), F.col("comparison"), F.col("expected")))
    )


def _passed(actual: Column, cmp: Column, expected: Column) -> Column:
    return (
        F.when(cmp == "==", actual == expected)
        .when(cmp == "!=", actual != expected)
        .when(cmp == ">", actual > expected)
        .when(cmp == "<", actual < expected)
        .when(cmp == ">=", actual >= expected)
        .when(cmp == "<=", actual <= expected)
        .otherwise(F.lit(False))
    )


def run_suite(tables: Mapping[str, DataFrame], specs: Sequence[TableChecks]) -> DataFrame:
    """DQ-4 / DQ-5: the suite over several tables; one status per check (T-12)."""
    reports = [check_table(tables[s.table], s) for s in specs]
    return reduce(DataFrame.unionByName, reports).select("check", "actual", "passed")


def report_lines(report: DataFrame) -> list[str]:
    """DQ-5: one ``PASSED`` / ``FAILED`` line per check, with its value.

    Collects the report (one row per check); every check gets exactly one
    status, unlike the reference, which printed PASSED after a failure (T-12).
    """
    return [
        f"{'PASSED' if r['passed'] else 'FAILED'}: {r['check']} (value: {r['actual']})"
        for r in report.collect()
    ]


# --- comparison checks on SQL (DQ-6) ----------------------------------------------------


@dataclass(frozen=True)
class SqlCheck:
    """``{"check_name", "test_sql", "expected_result", "comparison"}`` of the reference."""

    check_name: str
    test_sql: str
    expected_result: int
    comparison: str


def sql_check_report(spark: SparkSession, checks: Sequence[SqlCheck]) -> DataFrame:
    """Each check's first value next to its rule, as a lazy DataFrame.

    A query that returns no rows yields ``actual = NULL`` and ``passed = false``.
    """
    for c in checks:
        if c.comparison not in COMPARISONS:
            raise DataQualityError(f"Unsupported comparison: {c.comparison}")
    parts = []
    for c in checks:
        q = spark.sql(c.test_sql)
        first = q.columns[0]
        # The first value; a global aggregate over at most one row returns one
        # row, NULL when the query returned none.
        value = q.select(F.col(first).cast("bigint").alias("v")).limit(1).agg(
            F.max("v").alias("actual"))
        parts.append(value.select(
            F.lit(c.check_name).alias("check_name"),
            F.lit(c.expected_result).cast("bigint").alias("expected"),
            F.lit(c.comparison).alias("comparison"),
            "actual",
        ))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn(
        "passed",
        F.coalesce(_passed(F.col("actual"), F.col("comparison"), F.col("expected")), F.lit(False)),
    )


def raise_on_failure(report: DataFrame) -> None:
    """DQ-6 runner: raise on the first failed check, with its value.

    Collects the report only — one small row per check.
    """
    for row in report.collect():
        name = row["check_name"] if "check_name" in row else row["check"]
        if row["actual"] is None:
            raise DataQualityError(f"Data quality check {name} failed: no records")
        if not row["passed"]:
            raise DataQualityError(
                f"Data quality check {name} failed. Result was {row['actual']}"
            )


def compare(actual: object, expected: object, comparison: str) -> bool:
    """DQ-6 comparison of two scalars; unknown operators raise."""
    try:
        return COMPARISONS[comparison](actual, expected)
    except KeyError as exc:
        raise DataQualityError(f"Unsupported comparison: {comparison}") from exc


# --- column-count rule with metrics in the write pass (DQ-7) ----------------------------


def column_count_rule(df: DataFrame, minimum: int = 1) -> None:
    """DQ-7: the output must have more than ``minimum - 1`` columns; a schema
    property, checked without a job."""
    if len(df.columns) < minimum:
        raise DataQualityError(f"column count {len(df.columns)} is not > {minimum - 1}")


def observed(df: DataFrame, name: str = "dq") -> tuple[DataFrame, Observation]:
    """Attach row-count metrics that are filled in by the job that writes ``df``."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


# --- verification, profile and domain checks (DQ-8, DQ-9, DQ-11, DQ-12, DQ-13) ------------


def verify_table(df: DataFrame) -> tuple[int, object]:
    """DQ-8: row count and first row (one count job, one limit-1 job)."""
    return df.count(), df.limit(1).collect()[:1]


def profile(df: DataFrame) -> DataFrame:
    """DQ-11: ``(column_name, data_type, non_null)`` for every column, one pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"_c{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def missing_values(df: DataFrame, column: str, requested: Sequence[str]) -> DataFrame:
    """DQ-9: requested values that do not occur in ``df[column]`` (must be empty).

    The requested list is a handful of user inputs; the table side is reduced
    to its distinct values (map-side) before the anti join.
    """
    spark = df.sparkSession
    req = spark.createDataFrame([(v,) for v in dict.fromkeys(requested)], "value string")
    present = df.select(F.col(column).cast("string").alias("value")).distinct()
    return req.join(present, "value", "left_anti").withColumnRenamed("value", "missing")


def require_values(df: DataFrame, column: str, requested: Sequence[str]) -> None:
    missing = [r["missing"] for r in missing_values(df, column, requested).collect()]
    if missing:
        raise DataQualityError(f"{', '.join(missing)} not found in {column}")


def check_record_schema(record: Mapping[str, object], schema: T.StructType) -> None:
    """DQ-12: a new record must carry every non-nullable field of ``schema``."""
    missing = [f.name for f in schema.fields if not f.nullable and record.get(f.name) is None]
    if missing:
        raise DataQualityError(f"missing required field(s): {', '.join(missing)}")


def csv_line_count(spark: SparkSession, path: str) -> DataFrame:
    """DQ-13: records of the CSV files written at ``path`` → ``(lines, rows, files)``.

    ``lines`` are records with the headers, ``rows`` without; a line end inside
    quotes does not start a record.
    """
    from wharf.sources.files import read_csv_dir

    rows = read_csv_dir(spark, path).agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("long").alias("files"))
    files = (spark.read.text(path).select(F.input_file_name().alias("f")).distinct()
             .agg(F.lit(0).cast("long").alias("rows"), F.count("f").alias("files")))
    total = rows.unionByName(files).agg(F.sum("rows").alias("rows"), F.sum("files").alias("files"))
    return total.select((F.col("rows") + F.col("files")).alias("lines"), "rows", "files")
