"""Keyed append that does not read its target (STR-2, T-11).

:func:`wharf.streaming.incremental.run_keyed_append` finds the rows already
loaded by a join with the target, which grows with its history. Here the keys
seen so far are the state of the stream: Spark keeps them in a RocksDB state
store below the checkpoint, partitioned by key, so a micro-batch costs its own
rows and one state lookup for each of them. The target is written by the file
sink, whose commit log and the checkpoint together make each row appear once,
also if a run dies at any point and is started again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from wharf.operators.quality import DataQualityError
from wharf.streaming.incremental import Transform, _source

_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A commit uploads what changed, not the whole store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def known_by(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``_key`` and ``_row``: a row is known by its key or, where that is NULL, by all its columns."""
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)
    return df.withColumn("_key", F.col(key)).withColumn("_row", F.when(F.col(key).isNull(), row))


def keyed_append_writer(spark: SparkSession, landing: str, schema: T.StructType, key: str, checkpoint: str, *,
                        fmt: str = "parquet", transform: Transform | None = None,
                        event_time: str | None = None, horizon: str | None = None,
                        partition_by: Sequence[str] = (), max_files_per_trigger: int | None = None) -> DataStreamWriter:
    """The stream of :func:`run_keyed_stream`, not started."""
    df = _source(spark, landing, schema, fmt, max_files_per_trigger)
    if transform is not None:
        df = transform(df)
    columns = df.columns
    if horizon:
        df = known_by(df.withWatermark(event_time, horizon), key).dropDuplicatesWithinWatermark(["_key", "_row"])
    else:
        df = known_by(df, key).dropDuplicates(["_key", "_row"])
    writer = (df.select(*columns).writeStream.format("parquet").option("checkpointLocation", checkpoint)
              .outputMode("append").trigger(availableNow=True))
    return writer.partitionBy(*partition_by) if partition_by else writer


def run_keyed_stream(spark: SparkSession, landing: str, schema: T.StructType, target: str, key: str, checkpoint: str,
                     **options) -> list[dict]:
    """STR-2: append the rows of new files whose key was never seen, then stop. Returns the batches' figures.

    Replayed files, repeated rows and late rows add nothing that is there
    already; a row with a NULL key is known by all its columns. Of different rows
    with one key that arrive in one micro-batch one is kept, which one is not
    defined; over batches the first stays.

    Without ``horizon`` the state holds every key for good. With it (and
    ``event_time``) a key is forgotten once the watermark passes its row by that
    time, so the state is bounded; a row older than the watermark cannot be
    judged then, and the run ends with :class:`DataQualityError` saying how many
    there were, as Spark leaves them out.
    """
    with _settings(spark, _STATE_STORE):
        query = keyed_append_writer(spark, landing, schema, key, checkpoint, **options).start(target)
        query.awaitTermination()
    batches = []
    for p in query.recentProgress:
        state = p["stateOperators"][0] if p["stateOperators"] else {}
        batches.append({"batch": p["batchId"], "rows": p["numInputRows"], "new_keys": state.get("numRowsUpdated", 0),
                        "known_keys": state.get("numRowsTotal", 0),
                        "too_late": state.get("numRowsDroppedByWatermark", 0)})
    late = sum(b["too_late"] for b in batches)
    if late:
        raise DataQualityError(f"{late} rows are older than the horizon; load them with append_new")
    return batches
