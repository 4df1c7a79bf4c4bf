"""The left join on equal time as an incremental job (PL-7 by STR-1).

:func:`wharf.plans.lake.machine_learning_curated` joins whole tables. Here steps
and readings arrive as files, each in its own time and not in order, and a run
joins what is new. Rows that may still find a partner are the state of the
stream; a step whose time the watermark of both sides has passed leaves the state,
with NULL readings if it never had a match. So state and work of a run are
bounded by the rows within ``delay``, not by the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.operators.quality import DataQualityError
from wharf.streaming.incremental import _source
from wharf.streaming.keyed import _STATE_STORE, _settings

#: Marks the row that closes a landing folder.
CLOSING = "_closing"


def _landing(spark: SparkSession, path: str, schema: T.StructType, time: str, delay: str, fmt: str, prefix: str) -> DataFrame:
    """A stream of ``schema``; columns get the prefix, the event time is ``<prefix>event_time``."""
    marked = T.StructType([*schema.fields, T.StructField(CLOSING, T.BooleanType())])
    df = _source(spark, path, marked, fmt, None)
    df = df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns], F.timestamp_millis(F.col(time)).alias(f"{prefix}event_time"))
    return df.withWatermark(f"{prefix}event_time", delay)


def close_landing(spark: SparkSession, path: str, schema: T.StructType, time: str, at_ms: int, fmt: str = "parquet") -> None:
    """Say that nothing older than ``at_ms`` will come any more: a marked row that moves the watermark there.

    Without it the last rows wait for later ones. The row is in no result."""
    row = {f.name: at_ms if f.name == time else None for f in schema.fields} | {CLOSING: True}
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields] + [T.StructField(CLOSING, T.BooleanType())])
    spark.createDataFrame([tuple(row[f.name] for f in nullable.fields)], nullable).write.mode("append").format(fmt).save(path)


def run_time_join(spark: SparkSession, steps: str, steps_schema: T.StructType, readings: str, readings_schema: T.StructType,
                  sink: str, checkpoint: str, *, step_time: str, reading_time: str, step_cols: Sequence[str],
                  reading_cols: Sequence[str], delay: str, fmt: str = "parquet") -> list[dict]:
    """PL-7 by increment: join the files that arrived since the last run, then stop. Returns the batches' figures.

    Times are epoch milliseconds above 0 (where watermarks begin). Rows may come up to ``delay`` later than the
    newest of their side; a row older than that cannot be joined any more, and the
    run ends with :class:`DataQualityError` saying how many there were. A step
    without a time is in the result at once, with NULL readings. After all runs,
    and :func:`close_landing` on both sides, the sink holds the batch join's rows."""
    left = _landing(spark, steps, steps_schema, step_time, delay, fmt, "s_")
    right = _landing(spark, readings, readings_schema, reading_time, delay, fmt, "r_").filter(
        F.col(f"r_{reading_time}").isNotNull())
    timed = left.filter(F.col("s_event_time").isNotNull())
    joined = timed.join(right, F.col("s_event_time") == F.col("r_event_time"), "leftOuter")
    # With the event time in the condition it stays above the watermark, which the closing row has to reach.
    joined = joined.filter(F.col(f"s_{CLOSING}").isNull() | F.col("s_event_time").isNull())
    columns = [F.col(f"s_{c}").alias(c) for c in step_cols]
    joined = joined.filter(F.col(f"r_{CLOSING}").isNull() | F.col("s_event_time").isNull()).select(*columns, *[F.col(f"r_{c}").alias(c) for c in reading_cols])
    types = {f.name: f.dataType for f in readings_schema.fields}
    untimed = _source(spark, steps, steps_schema, fmt, None).filter(F.col(step_time).isNull()).select(
        *step_cols, *[F.lit(None).cast(types[c]).alias(c) for c in reading_cols])
    with _settings(spark, _STATE_STORE):
        query = (joined.unionByName(untimed).writeStream.format("parquet").option("checkpointLocation", checkpoint)
                 .outputMode("append").trigger(availableNow=True).start(sink))
        query.awaitTermination()
    batches = []
    for p in query.recentProgress:
        state = p["stateOperators"][0] if p["stateOperators"] else {}
        batches.append({"batch": p["batchId"], "rows": p["numInputRows"], "state_rows": state.get("numRowsTotal", 0),
                        "too_late": state.get("numRowsDroppedByWatermark", 0)})
    late = sum(b["too_late"] for b in batches)
    if late:
        raise DataQualityError(f"{late} rows came later than the delay of {delay}")
    return batches
