"""PL-2 by increment: each run of the v2 star costs its own rows.

:func:`wharf.plans.star.run_v2` reads the whole fact for `time` and writes the
dimensions anew. Here all five tables are :class:`KeyedTable`s: a run's plays are
inserted by ``songplay_id``, `time` gets the rows of the same plays, and a
dimension, which is a set of distinct rows, gets the rows that it does not hold
yet. Key ranges and Bloom filters tell which stored files may hold a row of the
run, so neither the fact's history nor untouched dimension files are read. The
checks are kept as a mergeable state (:mod:`wharf.operators.quality_state`).

Each run has a name (its hour); every step remembers the runs it has taken in,
so a run that died can be started again, and a run that is repeated adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.operators import quality_state
from wharf.operators.quality import TableChecks, raise_on_failure
from wharf.plans import star
from wharf.session import scratch_path
from wharf.sinks import writers
from wharf.sinks.keyed_table import Commit, KeyedTable, Layout

#: The checks of v2 as additive measures: at least one user, every song with an id.
V2_STATE_CHECKS = (TableChecks("users"), TableChecks("songs", not_null=("song_id",)))

#: A play without an id is known by all its columns.
_FACT_KEY = ("songplay_id", "row_digest")


def _with_digest(fact: DataFrame) -> DataFrame:
    row = F.to_json(F.struct(*fact.columns), {"ignoreNullFields": "false"})
    return fact.withColumn("row_digest", F.when(F.col("songplay_id").isNull(), F.sha2(row, 256)))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def refresh_v2(spark: SparkSession, events: DataFrame, songs: DataFrame, out_dir: str, run: str,
               play_page: str = star.PLAY_PAGE, checks: Sequence[TableChecks] = V2_STATE_CHECKS,
               layout: Layout = Layout()) -> dict[str, Commit]:
    """Take in one run: its ``events`` (new rows only) and the song catalogue as staged by it.

    Gives what each table's commit did. The result of several runs is that of one
    run over all their events. Raises :class:`DataQualityError` if a check fails
    over all runs so far."""
    base = out_dir.rstrip("/")
    # The fact is written once for its two tables; the catalogue grows, so it is not sent through the driver.
    fact = writers.persist(_with_digest(star.songplays_v2(events, songs.hint("merge"), play_page)), scratch_path(spark, "run-fact"))
    tables = {
        "songplays": (fact, _FACT_KEY),
        "time": (fact.select(*_FACT_KEY, *star.time_columns("start_time")), _FACT_KEY),
        "users": (star.users_v2(events, play_page), None),
        "songs": (star.songs_v2(songs), None),
        "artists": (star.artists_v2(songs), None),
    }
    done = {}
    for name, (rows, key) in tables.items():
        table = KeyedTable(spark, f"{base}/{name}", key or rows.columns, _nullable(rows.schema), layout)
        done[name] = table.insert_new(rows, tag=run)
    quality_state.add_load(spark, f"{base}/_checks", run, {n: rows for n, (rows, _) in tables.items()}, checks, layout)
    raise_on_failure(quality_state.report(spark, f"{base}/_checks", checks))
    return done


def read_v2(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """One of the five tables, with the columns that :func:`wharf.plans.star.run_v2` gives it."""
    rows = KeyedTable.open(spark, f"{out_dir.rstrip('/')}/{name}").read()
    return rows.drop("songplay_id", "row_digest") if name == "time" else rows.drop("row_digest")
