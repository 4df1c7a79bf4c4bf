"""Star-schema builds from the staging tables (PL-1, PL-2).

v1 is spec-driven: each target table is a :class:`TableSpec` (role, column
map, sources, join, constraints, group-by) and :func:`build_table` turns it
into one DataFrame plan. Sources are named explicitly (the reference derived
them by splitting strings, so their order varied — T-15).

v2 is the hand-written variant: a left join on three keys for the fact, an
md5 surrogate key, DISTINCT dimensions, and a time dimension read from the
fact. :func:`run_v2` runs the steps in the reference's order (stage → fact →
dims → checks) and writes Parquet.

Differences between the two are kept as parameters (T-8 … T-11): ``how``
(inner / left), the join keys (title only / title, artist, duration), and the
fact's ``dedupe_on`` for reruns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wharf.functions import exprs as X
from wharf.operators.aggregates import distinct_rows, paid_wins
from wharf.operators.surrogate import unique_ids
from wharf.operators.joins import key_condition
from wharf.operators.projections import all_of
from wharf.operators.quality import (
    DataQualityError, SqlCheck, TableChecks, raise_on_failure, run_suite, sql_check_report,
)
from wharf.sinks import writers

# Fixed value: the page value of a song play in the event log.
PLAY_PAGE = "NextSong"


@dataclass(frozen=True)
class TableSpec:
    """Metadata of one star table (v1 maps, one record per table)."""

    name: str
    role: str  # "staging" | "fact" | "dimension"
    columns: Mapping[str, str | Column]  # target column → expression over source aliases
    sources: Sequence[str]  # the first is the base of the FROM clause
    joins: Mapping[str, str | Column] = field(default_factory=dict)  # source → ON condition
    where: Sequence[str | Column] = ()
    group_by: Sequence[str] = ()  # target column names
    how: str = "inner"


def _expr(e: str | Column) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def build_table(spec: TableSpec, sources: Mapping[str, DataFrame]) -> DataFrame:
    """One target table as a DataFrame plan; nothing runs until it is written."""
    base = sources[spec.sources[0]].alias(spec.sources[0])
    for name in spec.sources[1:]:
        base = base.join(sources[name].alias(name), _expr(spec.joins[name]), spec.how)
    if spec.where:
        base = base.filter(all_of([_expr(w) for w in spec.where]))
    if spec.group_by:
        keys = [_expr(spec.columns[g]).alias(g) for g in spec.group_by]
        aggs = [_expr(e).alias(c) for c, e in spec.columns.items() if c not in spec.group_by]
        # DISTINCT over GROUP BY is redundant (AGG-13): the group-by alone.
        return base.groupBy(*keys).agg(*aggs).select(*spec.columns.keys())
    out = base.select(*[_expr(e).alias(c) for c, e in spec.columns.items()])
    return out if spec.role == "fact" else out.distinct()


def v1_specs(play_page: str = PLAY_PAGE) -> list[TableSpec]:
    """The five v1 target tables: fact ``songplay`` and four dimensions.

    Target column names are fixed values; the expressions are this library's."""
    def ev(name: str) -> Column:
        return F.col(f"staging_events.{name}")

    def song(name: str) -> Column:
        return F.col(f"staging_songs.{name}")

    plays = [ev("page") == play_page, ev("userId").isNotNull()]
    known_songs = [song("song_id").isNotNull()]
    start = X.epoch_ms_to_timestamp(ev("ts"))
    fact = {"start_time": start} | {target: ev(source) for target, source in (
        ("user_id", "userId"), ("level", "level"))}
    fact |= {c: song(c) for c in ("song_id", "artist_id")}
    fact |= {target: ev(source) for target, source in (
        ("session_id", "sessionId"), ("location", "location"), ("user_agent", "userAgent"))}
    users = {"user_id": ev("userId")} | {target: F.max(ev(source)) for target, source in (
        ("first_name", "firstName"), ("last_name", "lastName"), ("gender", "gender"))}
    artists = {"artist_id": song("artist_id")} | {
        c: F.max(song(f"artist_{c}")) for c in ("name", "location", "latitude", "longitude")}
    time = {"start_time": start, "hour": X.hour(start), "day": X.day(start), "week": X.iso_week(start),
            "month": X.month(start), "year": X.year(start), "weekday": X.is_weekday(start)}
    return [
        # T-8: plays meet songs on the title only.
        TableSpec("songplay", "fact", fact, sources=["staging_events", "staging_songs"],
                  joins={"staging_songs": ev("song") == song("title")}, where=plays + known_songs),
        # AGG-5: a user seen on both levels is a paying one.
        TableSpec("users", "dimension", users | {"level": paid_wins(ev("level"))},
                  sources=["staging_events"], where=plays, group_by=["user_id"]),
        TableSpec("songs", "dimension", {c: song(c) for c in ("song_id", "title", "artist_id", "year", "duration")},
                  sources=["staging_songs"], where=known_songs),
        TableSpec("artists", "dimension", artists, sources=["staging_songs"], where=known_songs,
                  group_by=["artist_id"]),
        TableSpec("time_dim", "dimension", time, sources=["staging_events"], where=plays),
    ]


def build_v1(staging_events: DataFrame, staging_songs: DataFrame,
             play_page: str = PLAY_PAGE) -> dict[str, DataFrame]:
    """PL-1: all v1 tables as lazy DataFrames keyed by table name."""
    sources = {"staging_events": staging_events, "staging_songs": staging_songs}
    return {s.name: build_table(s, sources) for s in v1_specs(play_page)}


def with_play_ids(fact: DataFrame) -> DataFrame:
    """The fact with its generated key first: unique, increasing within a task, not dense (SNK-8)."""
    return unique_ids(fact, "songplay_id").select("songplay_id", *fact.columns)


def run_v1(staging_events: DataFrame, staging_songs: DataFrame, out_dir: str,
           play_page: str = PLAY_PAGE, fail: bool = False) -> dict[str, str]:
    """PL-1 as a job: persist staging once, write the five tables, run DQ-4.

    Staging is written as balanced Parquet (:func:`writers.persist`) and
    re-read, so the five table plans share one computation of the staging
    joins. Returns the paths of the tables and of the report (``dq_report``),
    which has one status for each check (T-12); with ``fail`` a failed check
    raises :class:`DataQualityError` after the report is written.
    """
    spark = staging_events.sparkSession
    base = out_dir.rstrip("/")
    tables = build_v1(writers.persist(staging_events, f"{base}/staging_events"),
                      writers.persist(staging_songs, f"{base}/staging_songs"), play_page)
    tables["songplay"] = with_play_ids(tables["songplay"])
    paths = {name: f"{base}/{name}" for name in tables}
    for name, df in tables.items():
        writers.overwrite(df, paths[name])
    report = run_suite({n: spark.read.parquet(p) for n, p in paths.items()}, V1_CHECKS)
    paths["dq_report"] = f"{base}/dq_report"
    writers.overwrite(report, paths["dq_report"])
    if fail:
        failed = [r["check"] for r in spark.read.parquet(paths["dq_report"]).filter("not passed").collect()]
        if failed:
            raise DataQualityError("failed checks: " + "; ".join(failed))
    return paths


V1_CHECKS = [
    TableChecks("users", key="user_id"),
    TableChecks("artists", key="artist_id"),
    TableChecks("songs", key="song_id"),
    TableChecks("time_dim", key="start_time"),
    TableChecks("songplay", key="songplay_id", not_null=("user_id", "start_time")),
]


# --- v2 --------------------------------------------------------------------------------


def songplays_v2(staging_events: DataFrame, staging_songs: DataFrame,
                 play_page: str = PLAY_PAGE, how: str = "left") -> DataFrame:
    """Fact v2: plays left-joined to songs on (title, artist name, duration).

    ``songplay_id`` is ``md5(sessionid || start_time)`` (FN-9), so reruns
    produce the same keys and :func:`wharf.sinks.writers.append_new` can skip
    rows already loaded (T-11).
    """
    events = staging_events.filter(F.col("page") == play_page).select(
        X.epoch_ms_to_timestamp_v2("ts").alias("start_time"),
        "userId", "level", "song", "artist", "length", "sessionId", "location", "userAgent",
    )
    songs = staging_songs.select("song_id", "title", "artist_id", "artist_name", "duration")
    joined = events.join(
        songs, key_condition(events, songs, ["song", "artist", "length"],
                             ["title", "artist_name", "duration"]), how,
    )
    return joined.select(
        X.md5_key("sessionId", "start_time").alias("songplay_id"),
        "start_time",
        F.col("userId").alias("userid"),
        "level", "song_id", "artist_id",
        F.col("sessionId").alias("sessionid"),
        "location",
        F.col("userAgent").alias("useragent"),
    )


def users_v2(staging_events: DataFrame, play_page: str = PLAY_PAGE) -> DataFrame:
    """DISTINCT over five columns: a user on two levels has two rows (T-10)."""
    return distinct_rows(staging_events.filter(F.col("page") == play_page), [
        F.col("userId").alias("userid"), F.col("firstName").alias("firstname"),
        F.col("lastName").alias("lastname"), "gender", "level",
    ])


def songs_v2(staging_songs: DataFrame) -> DataFrame:
    return distinct_rows(staging_songs, ["song_id", "title", "artist_id", "year", "duration"])


def artists_v2(staging_songs: DataFrame) -> DataFrame:
    return distinct_rows(staging_songs, [
        "artist_id", "artist_name", "artist_location", "artist_latitude", "artist_longitude"])


def time_columns(start_time: str | Column) -> list[Column]:
    """The columns of `time` v2 for a start time; weekday 0 = Sunday."""
    st = F.col(start_time) if isinstance(start_time, str) else start_time
    return [st.alias("start_time"), X.hour(st).alias("hour"), X.day(st).alias("day"), X.iso_week(st).alias("week"),
            X.month(st).alias("month"), X.year(st).alias("year"), X.dow_sunday0(st).alias("weekday")]


def time_v2(songplays: DataFrame) -> DataFrame:
    """Time v2 reads the fact and keeps every row (no DISTINCT); weekday 0 = Sunday."""
    return songplays.select(*time_columns("start_time"))


V2_CHECKS = [
    SqlCheck("at least one user", "SELECT COUNT(*) FROM users", 0, ">"),
    SqlCheck("every song has an id", "SELECT COUNT(*) - COUNT(song_id) FROM songs", 0, "=="),
]


def run_v2(staging_events: DataFrame, staging_songs: DataFrame, out_dir: str,
           play_page: str = PLAY_PAGE, truncate_dims: bool = True,
           checks: Sequence[SqlCheck] = tuple(V2_CHECKS), dedupe_on: str | None = None) -> dict[str, str]:
    """PL-2: stage → fact → dims → checks, writing Parquet below ``out_dir``.

    Staging is written once and re-read, so the fact and the four dimensions
    do not each recompute the staging joins. The fact appends; with ``dedupe_on``
    (``songplay_id``) it skips plays already present (T-11), see
    :func:`writers.append_new`, and is partitioned by the play's date, so that a
    run only reads the dates that it brings. Dimensions overwrite unless ``truncate_dims`` is
    False (SNK-2 / SNK-3). Raises :class:`DataQualityError` on a failed check.
    """
    spark = staging_events.sparkSession
    paths = {n: f"{out_dir.rstrip('/')}/{n}" for n in
             ("staging_events", "staging_songs", "songplays", "users", "songs", "artists", "time")}
    ev = writers.persist(staging_events, paths["staging_events"])
    sg = writers.persist(staging_songs, paths["staging_songs"])
    fact = songplays_v2(ev, sg, play_page).withColumn("play_date", F.to_date("start_time"))
    if dedupe_on:
        writers.append_new(fact, paths["songplays"], key=dedupe_on, partition_by=["play_date"])
    else:
        writers.append(fact, paths["songplays"], partition_by=["play_date"])
    dims = {
        "users": users_v2(ev, play_page),
        "songs": songs_v2(sg),
        "artists": artists_v2(sg),
        "time": time_v2(read_songplays(spark, paths["songplays"])),
    }
    for name, df in dims.items():
        (writers.overwrite if truncate_dims else writers.append)(df, paths[name])
    for name in ("users", "songs", "artists", "time", "songplays"):
        spark.read.parquet(paths[name]).createOrReplaceTempView(name)
    raise_on_failure(sql_check_report(spark, list(checks)))
    return paths


def read_songplays(spark: SparkSession, path: str) -> DataFrame:
    """The written v2 fact without its partition column."""
    return spark.read.parquet(path).drop("play_date")


def check_v1(tables: Mapping[str, DataFrame]) -> DataFrame:
    """DQ-4 over the v1 output: 5 tables × (non-empty, key not NULL, unique) + 2."""
    return run_suite({**tables, "songplay": with_play_ids(tables["songplay"])}, V1_CHECKS)
