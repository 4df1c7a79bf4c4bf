"""Layered lake jobs, landing → trusted → curated (PL-3 … PL-7).

Each job is a function from input DataFrames to the output DataFrame, plus
:func:`publish` which applies the column-count rule, attaches row-count
metrics to the write pass (``Observation``: no second job) and writes a JSON
table (SNK-4). Chain order: customer_trusted → accelerometer_trusted →
customer_curated → step_trainer_trusted → machine_learning_curated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wharf.operators.joins import existence_join, right_join_distinct, salted_join
from wharf.operators.quality import column_count_rule, observed
from wharf.sinks.writers import save_json_table


def customer_trusted(landing: DataFrame, consent_col: str = "shareWithResearchAsOfDate") -> DataFrame:
    """PL-3: ``SELECT * … WHERE consent IS NOT NULL`` (FLT-2, PRJ-2)."""
    return landing.filter(F.col(consent_col).isNotNull())


def accelerometer_trusted(readings: DataFrame, customers: DataFrame,
                          reading_user: str = "user", customer_key: str = "email",
                          keep: Sequence[str] = ("user", "timestamp", "x", "y", "z")) -> DataFrame:
    """PL-4: readings of known customers, reading columns only (JN-4, PRJ-3).

    An inner join on differently named keys (both kept until the select): a
    customer listed twice doubles its readings, as in the reference. ``keep``
    is resolved against the reading side, so a column named ``user`` is never
    mistaken for ``current_user()`` (T-5).
    """
    missing = [c for c in keep if c not in readings.columns]
    if missing:
        raise ValueError(f"columns not in readings: {missing}")
    r, c = readings.alias("act"), customers.alias("cus")
    joined = r.join(c, F.col(f"act.{reading_user}") == F.col(f"cus.{customer_key}"))
    return joined.select(*[F.col(f"act.{k}") for k in keep])


def customer_curated(customers: DataFrame, readings: DataFrame, customer_key: str = "email",
                     reading_user: str = "user") -> DataFrame:
    """PL-5: customers with at least one reading, deduplicated (JN-5, AGG-11)."""
    return existence_join(customers, readings, [customer_key], [reading_user])


def step_trainer_trusted(landing: DataFrame, curated: DataFrame, key: str = "serialNumber",
                         curated_key: str = "serialNumber",
                         cols: Sequence[str] = ("serialNumber", "sensorReadingTime",
                                                "distanceFromObject"),
                         keep_null_row: bool = True) -> DataFrame:
    """PL-6: ``SELECT DISTINCT landing cols FROM landing RIGHT JOIN curated``
    (JN-6, AGG-10; the all-NULL row of T-13 is kept by default)."""
    return right_join_distinct(landing, curated, [key], [curated_key], list(cols), keep_null_row)


def machine_learning_curated(steps: DataFrame, readings: DataFrame,
                             step_time: str = "sensorReadingTime", reading_time: str = "timestamp",
                             step_cols: Sequence[str] = ("serialNumber", "sensorReadingTime",
                                                         "distanceFromObject"),
                             reading_cols: Sequence[str] = ("x", "y", "z"),
                             salt_buckets: int = 16, hot_rows: int = 1_000_000) -> DataFrame:
    """PL-7: steps left-joined to readings on equal time, no DISTINCT (JN-7, T-14).

    AQE can split a hot time only on the steps side of this left join; times
    with more than ``hot_rows`` readings are spread over ``salt_buckets`` tasks
    (:func:`wharf.operators.joins.salted_join`); 0 turns this off.
    """
    if salt_buckets > 0:
        st = steps.select(*[F.col(c).alias(f"s_{c}") for c in steps.columns])
        rd = readings.select(*[F.col(c).alias(f"r_{c}") for c in readings.columns])
        joined = salted_join(st, rd, [f"s_{step_time}"], [f"r_{reading_time}"], how="left",
                             buckets=salt_buckets, hot_rows=hot_rows)
        return joined.select(*[F.col(f"s_{c}").alias(c) for c in step_cols],
                             *[F.col(f"r_{c}").alias(c) for c in reading_cols])
    s, r = steps.alias("stt"), readings.alias("act")
    joined = s.join(r, F.col(f"stt.{step_time}") == F.col(f"act.{reading_time}"), "left")
    return joined.select(*[F.col(f"stt.{c}") for c in step_cols],
                         *[F.col(f"act.{c}") for c in reading_cols])


def publish(df: DataFrame, table: str, path: str, mode: str = "append",
            partition_keys: Sequence[str] = ()) -> Observation:
    """DQ-7 + SNK-4: rule check, metrics in the write pass, JSON table sink."""
    column_count_rule(df)
    df, obs = observed(df, f"dq_{table}")
    save_json_table(df, table, path, mode=mode, partition_keys=partition_keys)
    return obs


# The table names of the chain, in run order.
CHAIN_TABLES = (
    "customer_trusted", "accelerometer_trusted", "customer_curated",
    "step_trainer_trusted", "machine_learning_curated",
)


@dataclass(frozen=True)
class ChainResult:
    """Catalog table and published row count of every job of the chain."""

    tables: dict[str, str]
    rows: dict[str, int]


def run_chain(customer_landing: DataFrame, accelerometer_landing: DataFrame,
              step_trainer_landing: DataFrame, base: str, suffix: str = "") -> ChainResult:
    """PL-3 … PL-7 in the reference's chain order, each job reading the previous
    jobs' output through the catalog (SRC-9) and publishing its own (SNK-4).

    Each table is a JSON table below ``base``; ``suffix`` keeps repeated runs
    apart. Row counts come from the metrics observed in each write pass
    (DQ-7), not from extra count jobs. Every job is its own Spark job with its
    own files, so a failed step is rerun alone.
    """
    spark = customer_landing.sparkSession
    names = {job: f"{job}{suffix}" for job in CHAIN_TABLES}
    rows: dict[str, int] = {}

    def out(job: str, df: DataFrame) -> DataFrame:
        obs = publish(df, names[job], f"{base.rstrip('/')}/{job}", mode="overwrite")
        rows[job] = int(obs.get["rows"])
        return spark.table(names[job])

    trusted = out("customer_trusted", customer_trusted(customer_landing))
    accel = out("accelerometer_trusted", accelerometer_trusted(accelerometer_landing, trusted))
    curated = out("customer_curated", customer_curated(trusted, accel))
    steps = out("step_trainer_trusted", step_trainer_trusted(step_trainer_landing, curated))
    out("machine_learning_curated", machine_learning_curated(steps, accel))
    return ChainResult(names, rows)
