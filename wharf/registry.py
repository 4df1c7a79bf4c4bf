"""Registered queries: one Spark plan per operator / job, with its SQL oracle.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables of that folder; the paired SQL computes the same result in
plain SQL (DuckDB dialect) on the same tables, for the correctness check.
Column names and types are aliased identically on both sides.

Stand-ins (the driver's tables replace the reference's inputs):
``events`` → event log (``purchase`` plays ``NextSong``), ``part`` → song
catalogue, ``customer`` → users, ``lineitem ⋈ orders`` → SSB ``lineorder``,
``conversations`` → session/item tables, ``documents ⟕ labels`` → customer
landing with a consent column.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.functions import exprs as X
from wharf.operators import quality as Q
from wharf.operators import quality_state as QS
from wharf.operators.aggregates import distinct_count
from wharf.operators.hot_keys import HotKeys, join_with_hot_keys
from wharf.operators.identity import IdentityLedger, append_with_ids, read_with_ids
from wharf.operators.joins import broadcast_if_small
from wharf.operators.projections import drop_fields
from wharf.operators.surrogate import dense_ids
from wharf.operators.upsert import last_write_wins
from wharf.plans import analytics as A
from wharf.plans import lake as L
from wharf.plans import questions as Qs
from wharf.plans import serving as S
from wharf.plans import star
from wharf.plans import star_refresh as SR
from wharf.plans.clustered import dimension_range, read_clustered, write_clustered
from wharf.session import scratch_path
from wharf.sinks.keyed_table import KeyedTable, Layout
from wharf.sinks.writers import (
    append, append_new, append_record, create_table, drop_tables, overwrite, persist, quoted_csv,
    save_bucketed, save_json_table, truncate_table, use_namespace,
)
from wharf.sources import conform as C
from wharf.sources.files import (
    create_external_json_table, dated_prefix, list_files, load_tables, read_catalog,
    malformed, read_csv_dir, read_csv_inferred, read_delimited, read_json, read_json_recursive,
    read_table, stage,
)
from wharf.sources.listing import FileLedger
from wharf.sources.tables import Tables
from wharf.streaming.incremental import run_incremental, run_keyed_append
from wharf.streaming.joins import close_landing, run_time_join
from wharf.streaming.keyed import run_keyed_stream

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# The stand-in for page = 'NextSong'.
PLAY_PAGE = "purchase"


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


_SE = C.STAGING_EVENTS_SQL
_SS = C.STAGING_SONGS_SQL
_LO = C.LINEORDER_SQL
_START = C.sql_epoch_ms_to_timestamp


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# =========================================================================== scalars


@register("json_field_extract", """
SELECT event_id,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k_parsed
FROM events
""")
def json_field_extract(spark, sf_dir):
    """FN-13 (path and schema forms), FN-11."""
    ev = _t(spark, sf_dir).events
    return ev.select(
        "event_id",
        X.json_field("props", "$.k").cast("bigint").alias("k"),
        F.from_json("props", "k bigint")["k"].alias("k_parsed"),
    )


# A stand-in shift: this less an event's time is before 1970, with a fraction of a second.
EARLIER_MS = 1_500_000_000_499


@register("epoch_to_timestamp", f"""
SELECT event_id, ms // 1000 AS epoch_s,
       {_START('ms')} AS start_time, {_START('ms')} AS start_time_v2,
       {_START(f'trunc(({{EARLIER_MS}} - ms) / 1000.0)::BIGINT * 1000')} AS before_1970
FROM (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events) t
""".replace("{EARLIER_MS}", str(EARLIER_MS)))
def epoch_to_timestamp(spark, sf_dir):
    """FN-1, FN-2, T-1, T-22: epoch ms → whole-second timestamps, both spellings."""
    ev = _t(spark, sf_dir).events.select("event_id", X.epoch_ms("ts").alias("ms"))
    return ev.select(
        "event_id",
        F.expr("ms div 1000").alias("epoch_s"),
        X.epoch_ms_to_timestamp("ms").alias("start_time"),
        X.epoch_ms_to_timestamp_v2("ms").alias("start_time_v2"),
        X.epoch_ms_to_timestamp(F.lit(EARLIER_MS) - F.col("ms")).alias("before_1970"),
    )


@register("sign_label", """
SELECT event_id, CASE WHEN value - 50.0 >= 0 THEN 'positive' ELSE 'negative' END AS label
FROM events
""")
def sign_label(spark, sf_dir):
    """FN-15: score sign → label (score = value − 50)."""
    ev = _t(spark, sf_dir).events
    return ev.select("event_id", X.sign_label(F.col("value") - F.lit(50.0)).alias("label"))


# ======================================================================= star v1 / v2


def _v1(spark, sf_dir) -> dict[str, DataFrame]:
    t = _t(spark, sf_dir)
    return star.build_v1(C.staging_events(t), C.staging_songs(t), play_page=PLAY_PAGE)


_EV_WHERE = f"page = '{PLAY_PAGE}' AND userId IS NOT NULL"


@register("time_dim_v1", _with(_SE) + f"""
SELECT DISTINCT start_time,
       CAST(extract(hour FROM start_time) AS INTEGER) AS hour,
       CAST(extract(day FROM start_time) AS INTEGER) AS day,
       CAST(extract(week FROM start_time) AS INTEGER) AS week,
       CAST(extract(month FROM start_time) AS INTEGER) AS month,
       CAST(extract(year FROM start_time) AS INTEGER) AS year,
       CASE WHEN extract(dow FROM start_time) IN (0, 6) THEN FALSE ELSE TRUE END AS weekday
FROM (SELECT {_START('ts')} AS start_time FROM staging_events WHERE {_EV_WHERE}) t
""")
def time_dim_v1(spark, sf_dir):
    """FN-3 … FN-6, AGG-10: v1 time dimension (DISTINCT, weekday flag)."""
    return _v1(spark, sf_dir)["time_dim"]


@register("songplay_v1", _with(_SE, _SS) + f"""
SELECT {_START('se.ts')} AS start_time, se.userId AS user_id, se.level, ss.song_id,
       ss.artist_id, se.sessionId AS session_id, se.location, se.userAgent AS user_agent
FROM staging_events se JOIN staging_songs ss ON se.song = ss.title
WHERE se.page = '{PLAY_PAGE}' AND se.userId IS NOT NULL AND ss.song_id IS NOT NULL
""")
def songplay_v1(spark, sf_dir):
    """PL-1 fact: JN-1 (title only, inner), FLT-1, FLT-2, FLT-4 (T-8, T-9)."""
    return _v1(spark, sf_dir)["songplay"]


@register("user_dim_v1", _with(_SE) + f"""
SELECT userId AS user_id, MAX(firstName) AS first_name, MAX(lastName) AS last_name,
       MAX(gender) AS gender,
       MAX(CASE WHEN level = 'paid' THEN 'paid' ELSE 'free' END) AS level
FROM staging_events WHERE {_EV_WHERE}
GROUP BY userId
""")
def user_dim_v1(spark, sf_dir):
    """AGG-4, AGG-5, FN-7, AGG-9, AGG-13."""
    return _v1(spark, sf_dir)["users"]


@register("song_dim", _with(_SS) + """
SELECT DISTINCT song_id, title, artist_id, year, duration
FROM staging_songs WHERE song_id IS NOT NULL
""")
def song_dim(spark, sf_dir):
    """AGG-10: DISTINCT song dimension."""
    return _v1(spark, sf_dir)["songs"]


@register("artist_dim_v1", _with(_SS) + """
SELECT artist_id, MAX(artist_name) AS name, MAX(artist_location) AS location,
       MAX(artist_latitude) AS latitude, MAX(artist_longitude) AS longitude
FROM staging_songs WHERE song_id IS NOT NULL
GROUP BY artist_id
""")
def artist_dim_v1(spark, sf_dir):
    """AGG-4: attributes collapsed per artist."""
    return _v1(spark, sf_dir)["artists"]


def _v1_check_sql() -> str:
    """The 17 checks, written out: non-empty, key without NULL, key unique, and two columns of the fact."""
    plays = f"SELECT * FROM staging_events WHERE {_EV_WHERE}"
    tables = {
        "users": ("user_id", f"SELECT userId AS user_id FROM ({plays}) p GROUP BY userId"),
        "artists": ("artist_id", "SELECT DISTINCT artist_id FROM staging_songs WHERE song_id IS NOT NULL"),
        "songs": ("song_id", "SELECT DISTINCT song_id, title, artist_id, year, duration FROM staging_songs "
                             "WHERE song_id IS NOT NULL"),
        "time_dim": ("start_time", f"SELECT DISTINCT {_START('ts')} AS start_time FROM ({plays}) p"),
        "songplay": ("songplay_id", f"SELECT row_number() OVER () AS songplay_id, {_START('p.ts')} AS start_time, "
                                    f"p.userId AS user_id FROM ({plays}) p JOIN staging_songs s ON p.song = s.title "
                                    "WHERE s.song_id IS NOT NULL"),
    }
    parts = []
    for name, (key, sql) in tables.items():
        nulls = [key, "user_id", "start_time"] if name == "songplay" else [key]
        parts.append(f"SELECT '{name}: rows' AS \"check\", count(*) AS actual, count(*) > 0 AS passed FROM ({sql}) t")
        parts += [f"SELECT '{name}: NULLs in {c}', count(*) - count({c}), count(*) = count({c}) FROM ({sql}) t" for c in nulls]
        parts.append(f"SELECT '{name}: repeats of {key}', count({key}) - count(DISTINCT {key}), "
                     f"count({key}) = count(DISTINCT {key}) FROM ({sql}) t")
    return _with(_SE, _SS) + "\nUNION ALL\n".join(parts)


def _suite_sql(specs) -> str:
    parts = []
    for spec in specs:
        t = spec.table
        parts.append(f"SELECT '{t}: rows' AS \"check\", count(*) AS actual, count(*) > 0 AS passed FROM {t}")
        parts += [f"SELECT '{t}: NULLs in {c}', count(*) - count({c}), count(*) = count({c}) FROM {t}"
                  for c in dict.fromkeys(([spec.key] if spec.key else []) + list(spec.not_null))]
        if spec.key:
            parts.append(f"SELECT '{t}: repeats of {spec.key}', count({spec.key}) - count(DISTINCT {spec.key}), "
                         f"count({spec.key}) = count(DISTINCT {spec.key}) FROM {t}")
    return "\nUNION ALL\n".join(parts)


@register("dq_star_v1", _v1_check_sql())
def dq_star_v1(spark, sf_dir):
    """DQ-1 … DQ-5 on the v1 star: 5 tables × 3 checks + 2, one status each."""
    return star.check_v1(_v1(spark, sf_dir))


def _songplays_v2_sql() -> str:
    return f"""
songplays AS (
  SELECT md5(CAST(ev.sessionId AS VARCHAR) || CAST(ev.start_time AS VARCHAR)) AS songplay_id,
         ev.start_time, ev.userId AS userid, ev.level, s.song_id, s.artist_id,
         ev.sessionId AS sessionid, ev.location, ev.userAgent AS useragent
  FROM (SELECT {_START('ts')} AS start_time, * FROM staging_events
        WHERE page = '{PLAY_PAGE}') ev
  LEFT JOIN staging_songs s
    ON ev.song = s.title AND ev.artist = s.artist_name AND ev.length = s.duration
)"""


@register("songplay_v2", _with(_SE, _SS, _songplays_v2_sql()) + "SELECT * FROM songplays")
def songplay_v2(spark, sf_dir):
    """PL-2 fact: JN-2 (three keys, left), FN-9 md5 key, PRJ-4, T-23."""
    t = _t(spark, sf_dir)
    return star.songplays_v2(C.staging_events(t), C.staging_songs(t), PLAY_PAGE)


@register("time_dim_v2", _with(_SE, _SS, _songplays_v2_sql()) + """
SELECT start_time,
       CAST(extract(hour FROM start_time) AS INTEGER) AS hour,
       CAST(extract(day FROM start_time) AS INTEGER) AS day,
       CAST(extract(week FROM start_time) AS INTEGER) AS week,
       CAST(extract(month FROM start_time) AS INTEGER) AS month,
       CAST(extract(year FROM start_time) AS INTEGER) AS year,
       CAST(extract(dow FROM start_time) AS INTEGER) AS weekday
FROM songplays
""")
def time_dim_v2(spark, sf_dir):
    """FN-3 … FN-5 on the v2 fact, no DISTINCT, weekday 0 = Sunday (T-2, T-10)."""
    t = _t(spark, sf_dir)
    return star.time_v2(star.songplays_v2(C.staging_events(t), C.staging_songs(t), PLAY_PAGE))


@register("user_dim_v2", _with(_SE) + f"""
SELECT DISTINCT userId AS userid, firstName AS firstname, lastName AS lastname, gender, level
FROM staging_events WHERE page = '{PLAY_PAGE}'
""")
def user_dim_v2(spark, sf_dir):
    """AGG-10: DISTINCT over five columns (a user on two levels has two rows)."""
    return star.users_v2(C.staging_events(_t(spark, sf_dir)), PLAY_PAGE)


@register("artist_dim_v2", _with(_SS) + """
SELECT DISTINCT artist_id, artist_name, artist_location, artist_latitude, artist_longitude
FROM staging_songs
""")
def artist_dim_v2(spark, sf_dir):
    """AGG-10 on the song catalogue."""
    return star.artists_v2(C.staging_songs(_t(spark, sf_dir)))


@register("song_dim_v2", _with(_SS) + """
SELECT DISTINCT song_id, title, artist_id, year, duration FROM staging_songs
""")
def song_dim_v2(spark, sf_dir):
    return star.songs_v2(C.staging_songs(_t(spark, sf_dir)))


# ============================================================================ lake jobs


def _landing(t: Tables) -> DataFrame:
    """Customer landing stand-in: documents with an optional consent (labels.quality)."""
    d = t.documents
    lb = t.labels.select("doc_id", F.col("quality").alias("consent"), "toxic")
    return d.join(lb, "doc_id", "left").select(
        "doc_id", "text", "lang", "source", "n_chars", "consent", "toxic"
    )


@register("consent_filter", """
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality AS consent, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL
""")
def consent_filter(spark, sf_dir):
    """PL-3: ``SELECT * … WHERE consent IS NOT NULL`` (FLT-2, PRJ-2)."""
    return L.customer_trusted(_landing(_t(spark, sf_dir)), consent_col="consent")


@register("join_two_keys_select", """
SELECT e.user_id, e.ts, e.event_type, e.value
FROM events e JOIN customer c ON e.user_id = c.c_custkey
""")
def join_two_keys_select(spark, sf_dir):
    """PL-4: JN-4 (user ↔ key of another name) + PRJ-3."""
    t = _t(spark, sf_dir)
    return L.accelerometer_trusted(
        t.events, t.customer, reading_user="user_id", customer_key="c_custkey",
        keep=("user_id", "ts", "event_type", "value"),
    )


@register("existence_curated", """
SELECT DISTINCT c.* FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 2 = 0) c
JOIN events e ON c.c_custkey = e.user_id
""")
def existence_curated(spark, sf_dir):
    """PL-5: JN-5 as a semi join + AGG-11 whole-row dedupe (every second customer twice)."""
    t = _t(spark, sf_dir)
    twice = t.customer.unionAll(t.customer.filter(F.col("c_custkey") % 2 == 0))
    return L.customer_curated(twice, t.events, customer_key="c_custkey",
                              reading_user="user_id")


@register("right_join_distinct", """
SELECT DISTINCT l.l_orderkey, l.l_shipdate, l.l_quantity
FROM lineitem l RIGHT JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def right_join_distinct(spark, sf_dir):
    """PL-6: JN-6 with the all-NULL row of unmatched right rows (T-13)."""
    t = _t(spark, sf_dir)
    return L.step_trainer_trusted(
        t.lineitem, t.orders, key="l_orderkey", curated_key="o_orderkey",
        cols=("l_orderkey", "l_shipdate", "l_quantity"),
    )


_TIMES = """
steps AS (SELECT *, event_id // 3 AS instant FROM events),
readings AS (SELECT *, event_id // 4 * 2 AS instant FROM events)"""
_LEFT_JOIN_TIME = _with(_TIMES) + """
SELECT s.event_id AS serial_number, s.instant AS sensor_reading_time, s.value AS distance,
       r.event_id AS x_event, r.value AS x_value
FROM steps s LEFT JOIN readings r ON s.instant = r.instant
"""


def _steps_and_readings(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """All events as steps and as readings. Three steps share an instant; even instants have four readings, odd
    ones none, so fan-out and padding occur while the output stays linear."""
    ev = _t(spark, sf_dir).events
    steps = ev.select(F.col("event_id").alias("serial_number"), F.expr("event_id div 3").alias("sensor_reading_time"),
                      F.col("value").alias("distance"))
    readings = ev.select(F.expr("event_id div 4 * 2").alias("reading_time"), F.col("event_id").alias("x_event"),
                         F.col("value").alias("x_value"))
    return steps, readings


@register("left_join_time", _LEFT_JOIN_TIME)
def left_join_time(spark, sf_dir):
    """PL-7: JN-7, left join on equal time, no DISTINCT (T-14)."""
    steps, readings = _steps_and_readings(spark, sf_dir)
    return L.machine_learning_curated(
        steps, readings, step_time="sensor_reading_time", reading_time="reading_time",
        step_cols=("serial_number", "sensor_reading_time", "distance"),
        reading_cols=("x_event", "x_value"),
    )


@register("left_join_hot_keys", """
SELECT s.event_id AS serial_number, s.event_type AS step_type, s.instant, r.n AS x_readings, r.event_id AS x_event
FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN -1 ELSE event_id // 3 END AS instant FROM events) s
LEFT JOIN (SELECT instant, count(*) AS n, min(event_id) AS event_id FROM (
    SELECT *, CASE WHEN event_id % 3 = 1 THEN -2 ELSE event_id // 4 * 2 END AS instant FROM events) x GROUP BY instant) r
ON s.instant = r.instant
UNION ALL
SELECT s.event_id, s.event_type, -2, NULL, r.event_id FROM (SELECT min(event_id) AS event_id, min(event_type) AS event_type FROM events) s
JOIN events r ON r.event_id % 3 = 1
""")
def left_join_hot_keys(spark, sf_dir):
    """JN-7 with hot keys on either side: a third of the steps has one time, a third of the readings another.

    The hot keys come from summaries that two loads of the readings leave behind;
    one step has the readings' hot time, so that its join is spread."""
    ev = _t(spark, sf_dir).events
    steps = ev.select(F.col("event_id").alias("serial_number"), F.col("event_type").alias("step_type"),
                      F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.expr("event_id div 3")).cast("long").alias("instant"))
    hot_time = F.when(F.col("event_id") % 3 == 1, F.lit(-2)).otherwise(F.lit(0)).cast("long")
    probe = ev.agg(F.min("event_id").alias("serial_number"), F.min("event_type").alias("step_type"), F.min(hot_time).alias("instant"))
    readings = ev.select(F.when(F.col("event_id") % 3 == 1, F.lit(-2)).otherwise(F.expr("event_id div 4 * 2")).cast("long").alias("time"),
                         F.col("event_id").alias("x_event"))
    state = HotKeys(spark, scratch_path(spark, "hot_times"))
    for load in (0, 1):
        state.add(f"load-{load}", readings.filter(F.col("x_event") % 2 == load), "time")
    n = ev.count()
    joined = join_with_hot_keys(steps.unionAll(probe), readings, "instant", "time", state.hot(more_than=n // 10))
    # The rows of all but the spread time are counted per step, which keeps the result linear.
    rest = (joined.filter(F.col("instant") != -2).groupBy("serial_number", "step_type", "instant")
            .agg(F.count("x_event").alias("n"), F.min("x_event").alias("x_event"))
            .select("serial_number", "step_type", "instant", F.when(F.col("n") > 0, F.col("n")).alias("x_readings"), "x_event"))
    spread = joined.filter(F.col("instant") == -2).select("serial_number", "step_type", "instant",
                                                           F.lit(None).cast("long").alias("x_readings"), "x_event")
    return rest.unionAll(spread)


# ====================================================================== serving tables

_LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@register("upsert_last_wins", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY {', '.join(c + ' DESC' for c in _LI_ORDER)}) AS rn
      FROM lineitem) t
WHERE rn = 1
""")
def upsert_last_wins(spark, sf_dir):
    """SNK-6: one row per (l_orderkey, l_linenumber), the latest arrival wins."""
    li = _t(spark, sf_dir).lineitem
    return last_write_wins(li, ["l_orderkey", "l_linenumber"], _LI_ORDER).select(*li.columns)


_CONV_DEDUP = """
conv AS (
  SELECT conv_id, turn, role, text FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY role DESC, text DESC) AS rn
    FROM (SELECT conv_id, turn, role, text FROM conversations
          UNION ALL SELECT conv_id, turn, role, 'again: ' || text FROM conversations WHERE turn % 2 = 1) u) t
  WHERE rn = 1
)"""


def _conversations(spark, sf_dir) -> DataFrame:
    """Conversations, every second turn twice, so that a key repeats."""
    conv = _t(spark, sf_dir).conversations.select("conv_id", "turn", "role", "text")
    again = conv.filter(F.col("turn") % 2 == 1).withColumn("text", F.concat(F.lit("again: "), "text"))
    return conv.unionAll(again)


def _songs_by_session(spark, sf_dir) -> DataFrame:
    return S.serving_table(_conversations(spark, sf_dir), ["conv_id", "turn"], ["role", "text"], ["role", "text"])


@register("serving_by_session", _with(_CONV_DEDUP) + "SELECT * FROM conv")
def serving_by_session(spark, sf_dir):
    """PL-9 table: PK (session, item) built by last-write-wins upsert (SNK-6)."""
    return _songs_by_session(spark, sf_dir)


# Stand-in parameters: keys present in the driver tables for the point lookups.
LOOKUP_SESSION, LOOKUP_ITEM = 1, 1
LOOKUP_ROLE, LOOKUP_CONV = "user", 1
LOOKUP_PART = 7


@register("lookup_composite", _with(_CONV_DEDUP) + f"""
SELECT role, text FROM conv WHERE conv_id = {LOOKUP_SESSION} AND turn = {LOOKUP_ITEM}
""")
def lookup_composite(spark, sf_dir):
    """PL-9 query: point lookup on the composite key (FLT-12)."""
    return S.lookup(_songs_by_session(spark, sf_dir),
                    {"conv_id": LOOKUP_SESSION, "turn": LOOKUP_ITEM}, ["role", "text"])


@register("lookup_ordered", _with(_CONV_DEDUP) + f"""
SELECT turn, text FROM conv WHERE role = '{LOOKUP_ROLE}' AND conv_id = {LOOKUP_CONV}
ORDER BY turn
""")
def lookup_ordered(spark, sf_dir):
    """PL-10: PK ((user, session), item) read in clustering order (SRT-4)."""
    conv = _t(spark, sf_dir).conversations
    table = S.serving_table(conv, ["role", "conv_id", "turn"], ["text"], ["text"])
    return S.lookup(table, {"role": LOOKUP_ROLE, "conv_id": LOOKUP_CONV}, ["turn", "text"],
                    order_by=["turn"])


def _item_users(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_partkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    plays = li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        F.col("l_partkey").alias("item"), F.col("o_custkey").alias("user_id"))
    return S.distinct_pairs(plays, "item", "user_id")


_ITEM_USERS = """
item_users AS (
  SELECT DISTINCT l_partkey AS item, o_custkey AS user_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


@register("distinct_users_by_item", _with(_ITEM_USERS) + "SELECT * FROM item_users")
def distinct_users_by_item(spark, sf_dir):
    """PL-11 table: PK (item, user) keeps each listener once (AGG-10)."""
    return _item_users(spark, sf_dir)


@register("distinct_pair_count", _with(_ITEM_USERS) + "SELECT COUNT(*) AS n FROM item_users")
def distinct_pair_count(spark, sf_dir):
    """AGG-12: number of distinct (item, user) pairs."""
    return distinct_count(_item_users(spark, sf_dir), ["item", "user_id"])


@register("lookup_by_item", _with(_ITEM_USERS) + f"""
SELECT iu.user_id, c.c_name FROM item_users iu JOIN customer c ON iu.user_id = c.c_custkey
WHERE iu.item = {LOOKUP_PART}
""")
def lookup_by_item(spark, sf_dir):
    """PL-11 query: lookup on the partition key only (FLT-13)."""
    c = _t(spark, sf_dir).customer.select("c_custkey", "c_name")
    table = _item_users(spark, sf_dir).join(c, F.col("user_id") == F.col("c_custkey"))
    return S.lookup(table, {"item": LOOKUP_PART}, ["user_id", "c_name"])


# ============================================================================ analytics


def _region_plays(t: Tables) -> DataFrame:
    """Plays per (region, title, artist), counted first on the fact's join keys.

    Counting lineitem per (part, supplier) before the dimension joins shrinks
    what the joins shuffle (eager aggregation; Catalyst does not push an
    aggregate below a join by itself). The counts are summed afterwards.
    """
    li = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("plays"))
    p = t.part.select("p_partkey", "p_name", "p_brand")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = broadcast_if_small(t.nation.select("n_nationkey", "n_regionkey"), 10_000)
    r = broadcast_if_small(t.region.select("r_regionkey", "r_name"), 10_000)
    return (
        li.join(p, F.col("l_partkey") == F.col("p_partkey"))
        .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(n, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("r_name", F.col("p_name").alias("title"), F.col("p_brand").alias("artist"),
                "plays")
    )


@register("top3_per_group", """
SELECT * FROM (
  SELECT CAST(ROW_NUMBER() OVER (PARTITION BY r_name ORDER BY COUNT(*) DESC, p_name, p_brand)
              AS INTEGER) AS rank,
         r_name, p_name AS title, p_brand AS artist, COUNT(*) AS play_count
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  GROUP BY r_name, p_name, p_brand
) sub
WHERE rank <= 3
""")
def top3_per_group(spark, sf_dir):
    """PL-12 query 1: WIN-1 + WIN-2 (+ FLT-11), JN-3 over five tables."""
    return A.popular_per_group(_region_plays(_t(spark, sf_dir)), "r_name", ["title", "artist"], 3,
                               weight="plays")


@register("top10_filtered", """
SELECT p_brand AS name, COUNT(*) AS play_count
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
WHERE year(o_orderdate) = 1998
GROUP BY p_brand
ORDER BY play_count DESC, name
LIMIT 10
""")
def top10_filtered(spark, sf_dir):
    """PL-12 query 2: JN-3, FLT-1 on a dimension attribute, SRT-1, LIM-1."""
    t = _t(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_partkey")
    p = t.part.select("p_partkey", "p_brand")
    o = t.orders.filter(X.year("o_orderdate") == 1998).select("o_orderkey")
    plays = (li.join(p, F.col("l_partkey") == F.col("p_partkey"))
             .join(o, F.col("l_orderkey") == F.col("o_orderkey"))
             .select(F.col("p_brand").alias("name")))
    return A.top_by_count(plays, "name", 10)


@register("top3_users", """
SELECT c_name || ' ' || c_mktsegment AS name, COUNT(*) AS play_count
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY name
ORDER BY play_count DESC, name
LIMIT 3
""")
def top3_users(spark, sf_dir):
    """PL-12 query 3: FN-8 concatenation, AGG-9 group by alias, LIM-1."""
    t = _t(spark, sf_dir)
    o = t.orders.select("o_custkey")
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    plays = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        A.full_name("c_name", "c_mktsegment").alias("name"))
    return A.top_by_count(plays, "name", 3)


@register("count_by_two_keys", """
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS play_count
FROM orders GROUP BY o_orderstatus, o_orderpriority
ORDER BY o_orderstatus NULLS LAST
""")
def count_by_two_keys(spark, sf_dir):
    """PL-12 query 4: AGG-1 by two keys, SRT-2 (NULLs last, T-6)."""
    o = _t(spark, sf_dir).orders
    return A.count_by_sorted(o, ["o_orderstatus", "o_orderpriority"], "o_orderstatus")


# --- SSB (PL-13) --------------------------------------------------------------------

# SSB predicates. Fixed values from the benchmark queries: the year 1997, the quantity
# bound 24, the region 'AMERICA', the month 'Dec1997'. Stand-ins for the driver tables:
# the discount band as fractions, the category (a part type) and the two cities (nations).
SSB_YEAR = 1997
SSB_DISCOUNT = (0.01, 0.03)
SSB_MAX_QUANTITY = 24
SSB_CATEGORY = "PROMO"
SSB_REGION = "AMERICA"
SSB_CITIES = ("NATION_1", "NATION_5")
SSB_YEARMONTH = "Dec1997"


def ssb_tables(t: Tables) -> dict[str, DataFrame]:
    """SSB-shaped frames over the driver tables."""
    n = broadcast_if_small(t.nation.select("n_nationkey", "n_name", "n_regionkey"), 10_000)
    r = broadcast_if_small(t.region.select("r_regionkey", "r_name"), 10_000)
    geo = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name")
    supplier = t.supplier.select("s_suppkey", "s_nationkey").join(
        geo, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("s_city"), F.col("r_name").alias("s_region"))
    customer = t.customer.select("c_custkey", "c_nationkey").join(
        geo, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("c_city"), F.col("r_name").alias("c_region"))
    part = t.part.select("p_partkey", F.col("p_brand").alias("p_brand1"),
                         F.col("p_type").alias("p_category"))
    dwdate = A.date_dim(t.orders.select("o_orderdate"), "o_orderdate")
    return {"lineorder": C.lineorder(t), "dwdate": dwdate, "part": part,
            "supplier": supplier, "customer": customer}


_SSB_DIMS = """
dwdate AS (
  SELECT CAST(year(d_date) * 10000 + month(d_date) * 100 + day(d_date) AS INTEGER) AS d_datekey,
         d_date, CAST(year(d_date) AS INTEGER) AS d_year, strftime(d_date, '%b%Y') AS d_yearmonth
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d_date FROM orders) d
),
geo AS (
  SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
),
supplier_ssb AS (
  SELECT s_suppkey, n_name AS s_city, r_name AS s_region
  FROM supplier JOIN geo ON s_nationkey = n_nationkey
),
customer_ssb AS (
  SELECT c_custkey, n_name AS c_city, r_name AS c_region
  FROM customer JOIN geo ON c_nationkey = n_nationkey
),
part_ssb AS (SELECT p_partkey, p_brand AS p_brand1, p_type AS p_category FROM part)"""

_REV = "CAST(lo_extendedprice AS DECIMAL(12,2)) * CAST(lo_discount AS DECIMAL(4,2))"
_NET = "CAST(lo_extendedprice AS DECIMAL(12,2)) * (1 - CAST(lo_discount AS DECIMAL(4,2)))"


@register("ssb_one_dim", _with(_LO, _SSB_DIMS) + f"""
SELECT CAST(SUM({_REV}) AS DOUBLE) AS revenue
FROM lineorder, dwdate
WHERE lo_orderdate = d_datekey AND d_year = {SSB_YEAR}
  AND lo_discount BETWEEN {SSB_DISCOUNT[0]} AND {SSB_DISCOUNT[1]}
  AND lo_quantity < {SSB_MAX_QUANTITY}
""")
def ssb_one_dim(spark, sf_dir):
    """PL-13 oneDim: AGG-6, FLT-5, FLT-6, JN-8."""
    s = ssb_tables(_t(spark, sf_dir))
    return A.ssb_one_dim(s["lineorder"], s["dwdate"], SSB_YEAR, *SSB_DISCOUNT, SSB_MAX_QUANTITY)


@register("ssb_two_dim", _with(_LO, _SSB_DIMS) + f"""
SELECT d_year, p_brand1, CAST(SUM({_NET}) AS DOUBLE) AS revenue
FROM lineorder, dwdate, part_ssb, supplier_ssb
WHERE lo_orderdate = d_datekey AND lo_partkey = p_partkey AND lo_suppkey = s_suppkey
  AND p_category = '{SSB_CATEGORY}' AND s_region = '{SSB_REGION}'
GROUP BY d_year, p_brand1
""")
def ssb_two_dim(spark, sf_dir):
    """PL-13 twoDim: AGG-8, JN-9 (fact + three dimensions)."""
    s = ssb_tables(_t(spark, sf_dir))
    return A.ssb_two_dim(s["lineorder"], s["dwdate"], s["part"], s["supplier"],
                         SSB_CATEGORY, SSB_REGION)


@register("ssb_drill", _with(_LO, _SSB_DIMS) + f"""
SELECT c_city, s_city, d_year, CAST(SUM({_NET}) AS DOUBLE) AS revenue
FROM customer_ssb, lineorder, supplier_ssb, dwdate
WHERE lo_custkey = c_custkey AND lo_suppkey = s_suppkey AND lo_orderdate = d_datekey
  AND (c_city = '{SSB_CITIES[0]}' OR c_city = '{SSB_CITIES[1]}')
  AND (s_city = '{SSB_CITIES[0]}' OR s_city = '{SSB_CITIES[1]}')
  AND d_yearmonth = '{SSB_YEARMONTH}'
GROUP BY c_city, s_city, d_year
ORDER BY d_year ASC, revenue DESC
""")
def ssb_drill(spark, sf_dir):
    """PL-13 drill: FLT-7 (OR of equalities), SRT-3 (mixed order)."""
    s = ssb_tables(_t(spark, sf_dir))
    return A.ssb_drill(s["lineorder"], s["dwdate"], s["customer"], s["supplier"],
                       SSB_CITIES, SSB_YEARMONTH)


@register("ssb_same_dist", _with(_LO, _SSB_DIMS) + f"""
SELECT lo_orderdate, CAST(SUM({_REV}) AS DOUBLE) AS revenue
FROM lineorder, part_ssb
WHERE lo_partkey = p_partkey
GROUP BY lo_orderdate
ORDER BY lo_orderdate
""")
def ssb_same_dist(spark, sf_dir):
    """PL-13 oneDimSameDist: AGG-7, JN-8."""
    s = ssb_tables(_t(spark, sf_dir))
    return A.ssb_same_dist(s["lineorder"], s["part"])


@register("improvement_pct", """
WITH a AS (SELECT o_orderpriority AS query,
                  CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS time_a
           FROM orders GROUP BY o_orderpriority),
     b AS (SELECT o_orderpriority AS query,
                  CAST(SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS time_b
           FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderpriority)
SELECT a.query, a.time_a, b.time_b, 100.0 * (a.time_a - b.time_b) / a.time_a AS improvement
FROM a LEFT JOIN b ON a.query = b.query
""")
def improvement_pct(spark, sf_dir):
    """FN-14 + JN-10: two per-key result tables joined on the key, % change.

    Stand-in measures: the orders' totals and the prices of their lines."""
    t = _t(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    lines = t.lineitem.select("l_orderkey", "l_extendedprice").join(o, F.col("l_orderkey") == F.col("o_orderkey"))

    def per_key(df: DataFrame, column: str, name: str) -> DataFrame:
        return (df.groupBy(F.col("o_orderpriority").alias("query"))
                .agg(F.sum(F.col(column).cast("decimal(14,2)")).cast("double").alias(name)))

    a, b = per_key(o, "o_totalprice", "time_a"), per_key(lines, "l_extendedprice", "time_b")
    return a.join(b, "query", "left").select(
        "query", "time_a", "time_b", X.improvement_pct("time_a", "time_b").alias("improvement"))


# ========================================================================= data quality

DQ_SPECS = [
    Q.TableChecks("region", key="r_regionkey"),
    Q.TableChecks("nation", key="n_nationkey", not_null=("n_regionkey",)),
    Q.TableChecks("customer", key="c_custkey", not_null=("c_nationkey",)),
    Q.TableChecks("supplier", key="s_suppkey"),
    Q.TableChecks("part", key="p_partkey"),
    Q.TableChecks("orders", key="o_orderkey", not_null=("o_custkey",)),
    Q.TableChecks("lineitem", key=None, not_null=("l_orderkey", "l_partkey", "l_suppkey")),
    Q.TableChecks("events", key="event_id", not_null=("user_id", "ts")),
    Q.TableChecks("documents", key="doc_id"),
]


@register("dq_suite", _suite_sql(DQ_SPECS))
def dq_suite(spark, sf_dir):
    """DQ-1 … DQ-5: non-empty, key not NULL, key unique per table; one pass each."""
    t = _t(spark, sf_dir)
    tables = {s.table: getattr(t, s.table) for s in DQ_SPECS}
    return Q.run_suite(tables, DQ_SPECS)


DQ_SQL_CHECKS = [
    Q.SqlCheck("customers not empty", "SELECT COUNT(*) FROM customer", 0, ">"),
    Q.SqlCheck("no NULL part keys", "SELECT COUNT(*) FROM part WHERE p_partkey IS NULL", 0, "=="),
    Q.SqlCheck("orders without lines",
               "SELECT COUNT(*) FROM orders o WHERE NOT EXISTS "
               "(SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)", 0, "=="),
    Q.SqlCheck("quantity at most 50", "SELECT MAX(l_quantity) FROM lineitem", 50, "<="),
    Q.SqlCheck("some events", "SELECT COUNT(*) FROM events", 0, "!="),
    Q.SqlCheck("few suppliers", "SELECT COUNT(*) FROM supplier", 1000000, "<"),
    Q.SqlCheck("parts at least 1", "SELECT COUNT(*) FROM part", 1, ">="),
]


def _dq_compare_sql() -> str:
    parts = []
    for c in DQ_SQL_CHECKS:
        op = "=" if c.comparison == "==" else c.comparison
        parts.append(
            f"SELECT '{c.check_name}' AS check_name, CAST({c.expected_result} AS BIGINT) AS expected, "
            f"'{c.comparison}' AS comparison, CAST(({c.test_sql}) AS BIGINT) AS actual, "
            f"COALESCE(CAST(({c.test_sql}) AS BIGINT) {op} {c.expected_result}, FALSE) AS passed"
        )
    return "\nUNION ALL\n".join(parts)


@register("dq_compare", _dq_compare_sql())
def dq_compare(spark, sf_dir):
    """DQ-6: SQL checks with a comparison operator, as a report (the runner raises)."""
    _t(spark, sf_dir).register_views(("customer", "part", "orders", "lineitem", "events",
                                      "supplier"))
    return Q.sql_check_report(spark, DQ_SQL_CHECKS)


# lineitem's columns and their Spark type names, in file order (from the Parquet schema).
_LINEITEM_TYPES = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]


@register("dq_profile", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{ty}' AS data_type, COUNT({c}) AS non_null FROM lineitem"
    for c, ty in _LINEITEM_TYPES))
def dq_profile(spark, sf_dir):
    """DQ-11: non-NULL count and type of every column, one pass."""
    return Q.profile(_t(spark, sf_dir).lineitem)


# Stand-in parameters: the requested languages of the domain check (one is absent).
DQ_REQUESTED_LANGS = ("en", "fr", "de", "it")


@register("dq_domain", f"""
SELECT v AS missing
FROM (VALUES {', '.join(f"('{v}')" for v in DQ_REQUESTED_LANGS)}) t(v)
WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.lang = t.v)
""")
def dq_domain(spark, sf_dir):
    """DQ-9: requested values missing from the table (must be empty to pass)."""
    return Q.missing_values(_t(spark, sf_dir).documents, "lang", list(DQ_REQUESTED_LANGS))


# ================================================================ keys and sampling


@register("surrogate_key", """
SELECT p_partkey, p_name, CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS BIGINT) AS sk
FROM part
""")
def surrogate_key(spark, sf_dir):
    """SNK-8: dense IDENTITY(0,1)-style key in natural-key order, no single partition."""
    part = _t(spark, sf_dir).part.select("p_partkey", "p_name")
    return dense_ids(part, ["p_partkey"], col="sk")


# Stand-in parameters: the sampler's request (subjects ↔ languages, use ↔ source, n).
SAMPLE_SUBJECTS = ("en", "fr")
SAMPLE_USE = "src1"
SAMPLE_N = 5


@register("sample_n")
def sample_n(spark, sf_dir):
    """PL-16: DQ-10, DQ-9, FLT-9, SMP-1, FN-12 (random rows: rows-only check)."""
    docs = _t(spark, sf_dir).documents
    return Qs.get_questions(docs, SAMPLE_USE, SAMPLE_SUBJECTS, SAMPLE_N,
                            subject_col="lang", use_col="source", seed=7)


@register("append_rows", """
SELECT doc_id, text, lang, source, n_chars FROM documents
UNION ALL
SELECT -1, 'Which operator appends one record?', 'en', 'api', NULL
""")
def append_rows(spark, sf_dir):
    """SET-2 / SNK-12 / DQ-12: one validated record appended by column name."""
    docs = _t(spark, sf_dir).documents
    record = {"doc_id": -1, "text": "Which operator appends one record?", "lang": "en",
              "source": "api", "extra_field": "ignored"}
    return _append(docs, record)


def _append(docs: DataFrame, record: dict) -> DataFrame:
    schema = T.StructType([
        T.StructField("doc_id", T.LongType(), False),
        T.StructField("text", T.StringType(), False),
        T.StructField("lang", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("n_chars", T.LongType(), True),
    ])
    return append_record(docs, record, schema)


# ============================================================ sources, sinks, jobs
#
# These entries write the driver tables to the shared scratch folder (below
# ``spark.checkpoint.dir``) with one operator and read them back with another;
# the oracle is the source table itself, so a pass means the round trip is
# lossless. Every call uses a fresh folder.


def _parts(spark: SparkSession) -> int:
    """Output file / bucket count: follows the session's shuffle parallelism."""
    return max(4, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))


#: A bucket is sorted by one task: buckets grow in number with the rows, not in size.
BUCKET_ROWS = 500_000


def _buckets(spark: SparkSession, *tables: DataFrame) -> int:
    """Bucket count of tables that are bucketed alike, from the rows of the largest (a count; columns are not read)."""
    return max(_parts(spark), *[-(-df.count() // BUCKET_ROWS) for df in tables])


_NTZ_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


@register("csv_quoted_roundtrip", "SELECT * FROM part")
def csv_quoted_roundtrip(spark, sf_dir):
    """SNK-5 (all fields quoted, header) → SRC-11 (folder read, header skipped)."""
    part = _t(spark, sf_dir).part
    path = scratch_path(spark, "part_csv")
    quoted_csv(part, path)
    return read_csv_dir(spark, path, schema=part.schema)


_HARD_CSV_SQL = """
SELECT *, 'He said "' || lang || '", ok' AS quoted, 'a' || chr(10) || '"' || source AS two_lines,
       'C:\\dir\\' || doc_id AS backslash, '' AS empty, CAST(NULL AS VARCHAR) AS missing, '  ' || lang || ' ' AS padded
FROM documents"""


def _hard_csv(spark, sf_dir) -> tuple[DataFrame, str]:
    d = _t(spark, sf_dir).documents
    hard = d.select("*", F.format_string('He said "%s", ok', "lang").alias("quoted"),
                    F.concat(F.lit('a\n"'), "source").alias("two_lines"),
                    F.concat(F.lit("C:\\dir\\"), F.col("doc_id").cast("string")).alias("backslash"),
                    F.lit("").alias("empty"), F.lit(None).cast("string").alias("missing"),
                    F.concat(F.lit("  "), "lang", F.lit(" ")).alias("padded"))
    path = scratch_path(spark, "hard_csv")
    quoted_csv(hard, path)
    return hard, path


@register("csv_hard_roundtrip", _HARD_CSV_SQL)
def csv_hard_roundtrip(spark, sf_dir):
    """SNK-5 → SRC-11 with quotes, commas, line ends, backslashes, blanks, empty and NULL fields."""
    hard, path = _hard_csv(spark, sf_dir)
    return read_csv_dir(spark, path, schema=hard.schema)


@register("csv_row_count", "SELECT count(*) AS rows FROM documents")
def csv_row_count(spark, sf_dir):
    """DQ-13: rows of the written CSV; line ends inside fields are no rows."""
    _, path = _hard_csv(spark, sf_dir)
    return Q.csv_line_count(spark, path).select("rows")


@register("malformed_rows", "SELECT count(*) AS rows, count(*) FILTER (WHERE p_partkey % 9 = 0) AS malformed FROM part")
def malformed_rows(spark, sf_dir):
    """SRC-5 / SRC-7: rows that do not fit the schema are counted (and fail a plain read)."""
    part = _t(spark, sf_dir).part
    path = scratch_path(spark, "part_malformed")
    key = F.when(F.col("p_partkey") % 9 == 0, F.lit("x")).otherwise(F.col("p_partkey").cast("string"))
    part.select(F.concat_ws(";", key, "p_brand").alias("value")).write.text(path)
    return malformed(spark, path, "p_partkey bigint, p_brand string", options={"sep": ";"})


@register("csv_inferred", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_inferred(spark, sf_dir):
    """SRC-12: header and types inferred."""
    path = scratch_path(spark, "orders_csv")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    _t(spark, sf_dir).orders.select(*columns).write.option("header", True).csv(path)
    got = read_csv_inferred(spark, path)
    # Inferred whole numbers are int or bigint by their values.
    return got.select(*[F.col(c).cast("long") if c.endswith("key") else F.col(c) for c in columns])


@register("table_source", "SELECT item_id, text FROM benchmark")
def table_source(spark, sf_dir):
    """SRC-15: a question bank stored as a table of another format."""
    path = scratch_path(spark, "bank_orc")
    _t(spark, sf_dir).benchmark.write.orc(path)
    return read_table(spark, path, fmt="orc")


@register("drop_fields", "SELECT p_partkey, p_name FROM part")
def drop_fields_entry(spark, sf_dir):
    """PRJ-5: all columns but the named ones."""
    part = _t(spark, sf_dir).part
    return drop_fields(part, [c for c in part.columns if c not in ("p_partkey", "p_name")])


@register("count_and_first", "SELECT count(*) AS n, min(o_orderkey) AS first_key FROM orders")
def count_and_first(spark, sf_dir):
    """DQ-8, LIM-2: row count and first row of a sorted table."""
    n, first = Q.verify_table(_t(spark, sf_dir).orders.orderBy("o_orderkey"))
    return spark.createDataFrame([(n, first[0]["o_orderkey"])], "n long, first_key long")


@register("table_lifecycle", """
SELECT 'filled' AS step, count(*) AS n FROM supplier
UNION ALL SELECT 'truncated', 0 UNION ALL SELECT 'appended', count(*) FROM supplier
UNION ALL SELECT 'tables after drop', 0
""")
def table_lifecycle(spark, sf_dir):
    """SNK-9, SNK-10, SNK-11, SNK-7: namespace, table from a spec, truncate, append, drop."""
    before, space = spark.catalog.currentDatabase(), _table_name("space")
    supplier = _t(spark, sf_dir).supplier
    use_namespace(spark, space, scratch_path(spark, space))
    try:
        create_table(spark, "s", supplier.schema)
        steps = []
        supplier.write.insertInto("s")
        steps.append(("filled", spark.table("s").count()))
        truncate_table(spark, "s")
        steps.append(("truncated", spark.table("s").count()))
        supplier.write.insertInto("s")
        steps.append(("appended", spark.table("s").count()))
        drop_tables(spark, ["s"])
        steps.append(("tables after drop", spark.sql(f"SHOW TABLES IN {space}").filter("NOT isTemporary").count()))
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE IF EXISTS {space} CASCADE")
    return spark.createDataFrame(steps, "step string, n long")


@register("plain_append_twice", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def plain_append_twice(spark, sf_dir):
    """SNK-1: an append without a key doubles the rows when run twice."""
    path, o = scratch_path(spark, "orders_twice"), _t(spark, sf_dir).orders
    append(o, path)
    append(o, path)
    return spark.read.parquet(path)


@register("keyed_append_rules", """
WITH rows AS (SELECT event_id, event_type, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id // 4 END AS k FROM events),
     one AS (SELECT min(event_id) AS event_id FROM rows WHERE event_id % 4 IN (2, 3) AND k IS NOT NULL GROUP BY k),
     two AS (SELECT min(event_id) AS event_id FROM rows WHERE k IS NOT NULL GROUP BY k
             HAVING count(*) FILTER (WHERE event_id % 4 IN (2, 3)) = 0)
SELECT event_id, event_type, k FROM rows
WHERE k IS NULL OR event_id IN (SELECT event_id FROM one) OR event_id IN (SELECT event_id FROM two)
""")
def keyed_append_rules(spark, sf_dir):
    """SNK-1 with a key: repeats inside a batch and across batches, NULL keys, and a rerun."""
    ev, path = _t(spark, sf_dir).events, scratch_path(spark, "keyed")
    rows = ev.select("event_id", "event_type", F.when(F.col("event_id") % 11 != 0, F.expr("event_id div 4")).alias("k"))
    for batch in (rows.filter((F.col("event_id") % 4).isin(2, 3)), rows, rows):
        append_new(batch, path, key="k")
    return spark.read.parquet(path)


@register("dimension_loads", """
SELECT 'appended' AS mode, c_custkey, c_name FROM customer
UNION ALL SELECT 'appended', c_custkey, c_name FROM customer
UNION ALL SELECT 'truncated', c_custkey, c_name FROM customer
""")
def dimension_loads(spark, sf_dir):
    """SNK-2, SNK-3: a dimension loaded twice, without and with truncation."""
    dim, out = _t(spark, sf_dir).customer.select("c_custkey", "c_name"), []
    for mode, load in (("appended", append), ("truncated", overwrite)):
        path = scratch_path(spark, f"dim_{mode}")
        load(dim, path)
        load(dim, path)
        out.append(spark.read.parquet(path).select(F.lit(mode).alias("mode"), "*"))
    return out[0].unionAll(out[1])


@register("sample_facts", f"""
SELECT {SAMPLE_N} AS drawn, {SAMPLE_N} AS different, 0 AS outside_pool, 0 AS nulls_left,
       count(*) >= {SAMPLE_N} AS enough
FROM documents WHERE lang IN ('en', 'fr') AND source = '{SAMPLE_USE}'
""")
def sample_facts(spark, sf_dir):
    """SMP-1, FLT-9, FN-12, DQ-10, PL-16: what holds of any draw, by an unseeded one."""
    docs = _t(spark, sf_dir).documents.withColumn("lacking", F.lit(None).cast("string"))
    got = Qs.get_questions(docs, SAMPLE_USE, SAMPLE_SUBJECTS, SAMPLE_N, subject_col="lang", use_col="source")
    inside = F.col("lang").isin(*SAMPLE_SUBJECTS) & (F.col("source") == SAMPLE_USE)
    return got.agg(F.count(F.lit(1)).cast("int").alias("drawn"), F.count_distinct("doc_id").cast("int").alias("different"),
                   F.count_if(~inside).cast("int").alias("outside_pool"),
                   F.count_if(F.col("lacking").isNull()).cast("int").alias("nulls_left"),
                   (F.count(F.lit(1)) >= SAMPLE_N).alias("enough"))


@register("json_table_roundtrip", """
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality AS consent, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL
""")
def json_table_roundtrip(spark, sf_dir):
    """PL-3 published: DQ-7 rule + metrics, SNK-4 JSON table sink, SRC-9 catalog read."""
    trusted = L.customer_trusted(_landing(_t(spark, sf_dir)), consent_col="consent")
    table = _table_name("customer_trusted")
    L.publish(trusted, table, scratch_path(spark, table), mode="append")
    return read_catalog(spark, None, table)


@register("json_recursive_read", "SELECT * FROM events")
def json_recursive_read(spark, sf_dir):
    """SRC-8: inferred JSON lines from nested folders (``recurse=True``)."""
    ev = _t(spark, sf_dir).events
    base = scratch_path(spark, "events_json")
    split = F.col("event_type").isin("click", "view")
    for cond, sub in ((split, "a/b"), (~split, "c")):
        (ev.filter(cond).write.mode("overwrite").option("timestampNTZFormat", _NTZ_FMT)
         .json(f"{base}/{sub}"))
    got = read_json_recursive(spark, base)
    return got.select(
        "event_id", F.to_timestamp_ntz(F.col("ts"), F.lit(_NTZ_FMT)).alias("ts"), "user_id",
        "event_type", "value", "props",
    )


# Stand-in parameters: the positional JSON paths of the event staging load.
EVENT_JSONPATHS = [
    ("event_id", "$.eventId", "bigint"),
    ("ts", "$.eventTime", "timestamp_ntz"),
    ("user_id", "$.userId", "bigint"),
    ("event_type", "$.eventType", "string"),
    ("value", "$.value", "double"),
    ("props", "$.props", "string"),
]


@register("jsonpaths_stage", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def jsonpaths_stage(spark, sf_dir):
    """SRC-3 staging load from a date prefix (SRC-4) with a JSON path list (SRC-2)."""

    ev = _t(spark, sf_dir).events
    base = scratch_path(spark, "log_data")
    run_date = dt.date(2024, 1, 31)
    camel = ev.select(
        F.col("event_id").alias("eventId"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("eventTime"),
        F.col("user_id").alias("userId"), F.col("event_type").alias("eventType"),
        "value", "props",
    )
    camel.write.mode("overwrite").json(dated_prefix(base, run_date))
    return stage(spark, base, scratch_path(spark, "staging_events"),
                 json_paths=EVENT_JSONPATHS, run_date=run_date)


@register("gzip_split_roundtrip", "SELECT * FROM lineitem")
def gzip_split_roundtrip(spark, sf_dir):
    """SRC-5: ``;``-separated gzip parts read by name prefix, one task per file.

    The rows are dealt evenly to the parts, whatever the split of the source is."""
    li = _t(spark, sf_dir).lineitem
    path = scratch_path(spark, "lineitem_gz")
    (li.repartition(_parts(spark)).write.mode("overwrite").option("sep", ";").option("compression", "gzip")
     .option("timestampNTZFormat", _NTZ_FMT).csv(path))
    return read_delimited(spark, f"{path}/part*", li.schema, sep=";",
                          options={"timestampNTZFormat": _NTZ_FMT})


@register("pipe_load_tables", "SELECT * FROM part")
def pipe_load_tables(spark, sf_dir):
    """SRC-7: pipe rows with a trailing ``|``, gzip, loaded into a catalog table."""
    part = _t(spark, sf_dir).part
    path = scratch_path(spark, "part_pipe")
    line = F.concat(F.concat_ws("|", *[F.col(c).cast("string") for c in part.columns]), F.lit("|"))
    part.select(line.alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)
    table = _table_name("ssb_part")
    load_tables(spark, {table: (path, part.schema)}, sep="|", location=scratch_path(spark, table))
    return spark.table(table)


@register("csv_cleanup", _with(_SE) + """
SELECT artist, firstName, gender, CAST(itemInSession AS INTEGER) AS itemInSession, lastName,
       CAST(length AS FLOAT) AS length, level, location, CAST(sessionId AS INTEGER) AS sessionId,
       song, CAST(userId AS INTEGER) AS userId
FROM staging_events
WHERE artist IS NOT NULL AND artist <> ''
""")
def csv_cleanup(spark, sf_dir):
    """PL-8: CSV folder (SRC-11) → FLT-10 + PRJ-6 → quoted CSV (SNK-5) → FN-11 casts."""
    staged = C.staging_events(_t(spark, sf_dir))
    raw_dir = scratch_path(spark, "event_data")
    (staged.select(*[F.col(c).cast("string") for c in staged.columns])
     .write.mode("overwrite").option("header", True).csv(raw_dir))
    raw = read_csv_dir(spark, raw_dir, columns=staged.columns)
    clean_dir = scratch_path(spark, "event_datafile_new")
    S.write_clean_csv(raw, clean_dir)
    clean = read_csv_dir(spark, clean_dir, columns=list(S.CLEAN_COLUMNS))
    return S.typed_events(clean)


@register("union_files", "SELECT * FROM events")
def union_files(spark, sf_dir):
    """SET-1: UNION ALL of same-schema files — one folder read over every split."""
    ev = _t(spark, sf_dir).events
    path = scratch_path(spark, "events_by_type")
    ev.write.mode("overwrite").partitionBy("event_type").parquet(path)
    return spark.read.parquet(path).select(*ev.columns)


@register("bucketed_join", """
SELECT o_orderkey, o_orderstatus, COUNT(*) AS n_lines, SUM(l_quantity) AS total_qty
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY o_orderkey, o_orderstatus
""")
def bucketed_join(spark, sf_dir):
    """SNK-7: both sides bucketed on the join key → join and aggregate without Exchange."""
    t = _t(spark, sf_dir)
    n = _buckets(spark, t.lineitem, t.orders)
    li_t, o_t = _table_name("lineitem_b"), _table_name("orders_b")
    save_bucketed(t.lineitem.select("l_orderkey", "l_quantity"), li_t, ["l_orderkey"], n,
                  sort_by=["l_orderkey"], path=scratch_path(spark, li_t))
    save_bucketed(t.orders.select("o_orderkey", "o_orderstatus"), o_t, ["o_orderkey"], n,
                  sort_by=["o_orderkey"], path=scratch_path(spark, o_t))
    li, o = spark.table(li_t), spark.table(o_t)
    return (o.join(li, o["o_orderkey"] == li["l_orderkey"])
            .groupBy("o_orderkey", "o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("total_qty")))


@register("serving_bucketed_lookup", _with(_CONV_DEDUP) + f"""
SELECT role, text FROM conv WHERE conv_id = {LOOKUP_SESSION} AND turn = {LOOKUP_ITEM}
""")
def serving_bucketed_lookup(spark, sf_dir):
    """PL-9 stored: SNK-7 bucketed on the partition key + FLT-12 lookup (bucket pruning)."""
    table = _table_name("songs_by_session")
    S.save_serving_table(_songs_by_session(spark, sf_dir), table, ["conv_id"], ["turn"],
                         _buckets(spark, _t(spark, sf_dir).conversations), path=scratch_path(spark, table))
    return S.lookup(spark.table(table), {"conv_id": LOOKUP_SESSION, "turn": LOOKUP_ITEM},
                    ["role", "text"])


@register("file_listing")
def file_listing(spark, sf_dir):
    """SRC-13: ``(path, length)`` of the files of a written dataset (rows-only check)."""
    path = scratch_path(spark, "lineitem_files")
    _t(spark, sf_dir).lineitem.write.mode("overwrite").parquet(path)
    return list_files(spark, path, glob="*.parquet")


# The split point of the incremental runs: files before it arrive first.
INCREMENTAL_SPLIT = "2024-01-16 00:00:00"


@register("incremental_append", "SELECT * FROM events")
def incremental_append(spark, sf_dir):
    """STR-1: bookmark-style runs — new files only; a rerun with no new files adds 0."""
    ev = _t(spark, sf_dir).events
    landing, sink = scratch_path(spark, "landing"), scratch_path(spark, "trusted")
    ckpt = scratch_path(spark, "bookmark")
    early = F.col("ts") < F.lit(INCREMENTAL_SPLIT).cast("timestamp_ntz")
    ev.filter(early).write.mode("append").parquet(landing)
    run_incremental(spark, landing, ev.schema, sink, ckpt)
    run_incremental(spark, landing, ev.schema, sink, ckpt)  # nothing new: adds 0
    ev.filter(~early).write.mode("append").parquet(landing)
    run_incremental(spark, landing, ev.schema, sink, ckpt)
    return spark.read.schema(ev.schema).parquet(sink)


@register("incremental_keyed_replay", "SELECT * FROM events")
def incremental_keyed_replay(spark, sf_dir):
    """STR-2: micro-batches appended with a key anti-join; a replay adds nothing."""
    ev = _t(spark, sf_dir).events
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "fact")
    ev.write.mode("append").parquet(landing)
    run_keyed_append(spark, landing, ev.schema, target, "event_id", scratch_path(spark, "ck"))
    # A lost checkpoint replays every file; the key anti-join keeps the target whole.
    run_keyed_append(spark, landing, ev.schema, target, "event_id", scratch_path(spark, "ck"))
    return spark.read.parquet(target).select(*ev.columns)


_NULL_KEYED = """
rows AS (SELECT event_id, event_type, ts, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id END AS k FROM events)"""


@register("incremental_keyed_state", _with(_NULL_KEYED) + "SELECT event_id, event_type, ts, k FROM rows")
def incremental_keyed_state(spark, sf_dir):
    """STR-2: keys seen so far are the stream's state, so the target is not read.

    Early events arrive first, then all events (the early ones again, repeated
    rows, late rows among new ones), then a run without new files. NULL keys are
    known by their whole row."""
    ev = _t(spark, sf_dir).events
    rows = ev.select("event_id", "event_type", "ts", F.when(F.col("event_id") % 11 != 0, F.col("event_id")).alias("k"))
    landing, target, ck = (scratch_path(spark, n) for n in ("landing", "fact", "ck"))
    early = rows.filter(F.col("ts") < F.lit(INCREMENTAL_SPLIT).cast("timestamp_ntz"))
    for batch in (early, rows.unionAll(early), None):
        if batch is not None:
            batch.write.mode("append").parquet(landing)
        run_keyed_stream(spark, landing, rows.schema, target, "k", ck)
    return spark.read.schema(rows.schema).parquet(target)


_UPSERT_ORDER = ["arrival", *_LI_ORDER]
_LI_CHANGES = """
top AS (SELECT max(l_orderkey) AS k FROM lineitem),
writes AS (
  SELECT *, 1 AS arrival FROM lineitem
  UNION ALL SELECT lineitem.* REPLACE (l_quantity + 1 AS l_quantity), 2 AS arrival FROM lineitem, top WHERE l_orderkey * 4 > k * 3
  UNION ALL SELECT lineitem.* REPLACE (-1.0 AS l_quantity), 0 AS arrival FROM lineitem, top WHERE l_orderkey * 8 > k * 7
  UNION ALL SELECT lineitem.* REPLACE (l_orderkey + k AS l_orderkey), 2 AS arrival FROM lineitem, top WHERE l_orderkey * 16 <= k
)"""


@register("upsert_touched_files", _with(_LI_CHANGES) + f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {', '.join(c + ' DESC' for c in _UPSERT_ORDER)}) AS rn FROM writes) t
WHERE rn = 1
""")
def upsert_touched_files(spark, sf_dir):
    """SNK-6 on a stored table, PL-9 … PL-11: two batches; the second rewrites the files that hold its keys.

    First all lines; then changes of the orders with the highest keys, older
    writes that arrive late, and lines of new orders."""
    li = _t(spark, sf_dir).lineitem
    top = li.agg(F.max("l_orderkey")).first()[0] or 0
    first = li.withColumn("arrival", F.lit(1))
    key = F.col("l_orderkey")
    changed = li.filter(key * 4 > top * 3).withColumns({"l_quantity": F.col("l_quantity") + 1, "arrival": F.lit(2)})
    late = li.filter(key * 8 > top * 7).withColumns({"l_quantity": F.lit(-1.0), "arrival": F.lit(0)})
    added = li.filter(key * 16 <= top).withColumns({"l_orderkey": key + top, "arrival": F.lit(2)})
    # A table design of 16 key ranges, whatever the size; files of a range are split by size.
    table = KeyedTable(spark, scratch_path(spark, "lineitem_keyed"), ["l_orderkey", "l_linenumber"], first.schema,
                       Layout(slots=1, width=top // 16 + 1))
    table.upsert(first, _UPSERT_ORDER)
    table.upsert(changed.unionByName(late).unionByName(added), _UPSERT_ORDER)
    return table.read()


_FACT_COLUMNS = ["start_time", "userid", "level", "song_id", "artist_id", "sessionid", "location", "useragent"]
_PLAYS_ONCE = f"""
plays_once AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY songplay_id, CASE WHEN songplay_id IS NULL THEN row(COLUMNS(*)) END
                                 ORDER BY {', '.join(c + ' NULLS FIRST' for c in _FACT_COLUMNS)}) AS rn FROM songplays) t
  WHERE rn = 1
)""".replace("row(COLUMNS(*))", f"row({', '.join(_FACT_COLUMNS)})")


def _refreshed(spark, sf_dir) -> str:
    """Three runs of the v2 star, by time of the events; the second is repeated."""
    t = _t(spark, sf_dir)
    # As in run_v2, staging is written once and read again by every step.
    events = persist(C.staging_events(t), scratch_path(spark, "staging_events"))
    songs = persist(C.staging_songs(t), scratch_path(spark, "staging_songs"))
    out = scratch_path(spark, "star_refresh")
    hour = F.pmod(F.expr("ts div 3600000"), F.lit(3))
    for run in (0, 1, 1, 2):
        SR.refresh_v2(spark, events.filter(hour == run), songs, out, f"run-{run}", play_page=PLAY_PAGE)
    return out


@register("star_v2_refresh", _with(_SE, _SS, _songplays_v2_sql(), _PLAYS_ONCE) + "SELECT * FROM plays_once")
def star_v2_refresh(spark, sf_dir):
    """PL-2 by increment: the fact after three runs by hour equals one run's."""
    return SR.read_v2(spark, _refreshed(spark, sf_dir), "songplays")


@register("star_v2_refresh_tables", _with(_SE, _SS, _songplays_v2_sql(), _PLAYS_ONCE) + f"""
SELECT 'time' AS name, count(*) AS n, count(DISTINCT start_time) AS different FROM plays_once
UNION ALL SELECT 'users', count(*), count(DISTINCT userid) FROM (
  SELECT DISTINCT userId AS userid, firstName, lastName, gender, level FROM staging_events WHERE page = '{{PLAY_PAGE}}') u
UNION ALL SELECT 'songs', count(*), count(DISTINCT song_id) FROM (
  SELECT DISTINCT song_id, title, artist_id, year, duration FROM staging_songs) s
UNION ALL SELECT 'artists', count(*), count(DISTINCT artist_id) FROM (
  SELECT DISTINCT artist_id, artist_name, artist_location, artist_latitude, artist_longitude FROM staging_songs) a
""".replace("{PLAY_PAGE}", PLAY_PAGE))
def star_v2_refresh_tables(spark, sf_dir):
    """PL-2 by increment: `time` and the dimensions after three runs by hour."""
    out = _refreshed(spark, sf_dir)
    keys = {"time": "start_time", "users": "userid", "songs": "song_id", "artists": "artist_id"}
    parts = [SR.read_v2(spark, out, name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"),
                                              F.count_distinct(key).alias("different")) for name, key in keys.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


def _clustered(spark, sf_dir, **filters) -> tuple[dict[str, DataFrame], DataFrame]:
    """The SSB tables, and the lines of the clustered layout that may meet filters on dimensions."""
    s = ssb_tables(_t(spark, sf_dir))
    path, cols = scratch_path(spark, "lineorder_clustered"), ["lo_orderdate", "lo_partkey", "lo_suppkey"]
    write_clustered(s["lineorder"], path, cols, files=4 * _parts(spark))
    ranges = {fact_key: dimension_range(s[dim].filter(condition), key) for fact_key, (dim, key, condition) in filters.items()}
    return s, read_clustered(spark, path, cols, ranges).rows


@register("ssb_one_dim_clustered", ORACLE["ssb_one_dim"])
def ssb_one_dim_clustered(spark, sf_dir):
    """SNK-7, PL-14: oneDim on the clustered layout; the year becomes a range of order dates."""
    s, lines = _clustered(spark, sf_dir, lo_orderdate=("dwdate", "d_datekey", F.col("d_year") == SSB_YEAR))
    return A.ssb_one_dim(lines, s["dwdate"], SSB_YEAR, *SSB_DISCOUNT, SSB_MAX_QUANTITY)


@register("ssb_two_dim_clustered", ORACLE["ssb_two_dim"])
def ssb_two_dim_clustered(spark, sf_dir):
    """SNK-7, PL-14: twoDim on the clustered layout; category and region become ranges of keys."""
    s, lines = _clustered(spark, sf_dir, lo_partkey=("part", "p_partkey", F.col("p_category") == SSB_CATEGORY),
                          lo_suppkey=("supplier", "s_suppkey", F.col("s_region") == SSB_REGION))
    return A.ssb_two_dim(lines, s["dwdate"], s["part"], s["supplier"], SSB_CATEGORY, SSB_REGION)


@register("ssb_drill_clustered", ORACLE["ssb_drill"])
def ssb_drill_clustered(spark, sf_dir):
    """SNK-7, PL-14: drill on the clustered layout; the month and the cities become ranges."""
    s, lines = _clustered(spark, sf_dir, lo_orderdate=("dwdate", "d_datekey", F.col("d_yearmonth") == SSB_YEARMONTH),
                          lo_suppkey=("supplier", "s_suppkey", F.col("s_city").isin(*SSB_CITIES)))
    return A.ssb_drill(lines, s["dwdate"], s["customer"], s["supplier"], SSB_CITIES, SSB_YEARMONTH)


@register("ssb_same_dist_clustered", ORACLE["ssb_same_dist"])
def ssb_same_dist_clustered(spark, sf_dir):
    """SNK-7, PL-14: oneDimSameDist on the clustered layout, which has no filter."""
    s, lines = _clustered(spark, sf_dir)
    return A.ssb_same_dist(lines, s["part"])


@register("identity_loads", """
SELECT p_partkey, p_name, CAST(row_number() OVER (ORDER BY p_size % 3, p_partkey) - 1 AS BIGINT) AS sk FROM part
""")
def identity_loads(spark, sf_dir):
    """SNK-8 over loads: three appends, each numbered from where the last one ended; the second is repeated."""
    part, path = _t(spark, sf_dir).part.select("p_partkey", "p_name", "p_size"), scratch_path(spark, "parts_with_ids")
    ledger = IdentityLedger(spark, scratch_path(spark, "part_ids"))
    for load in (0, 1, 1, 2):
        append_with_ids(part.filter(F.col("p_size") % 3 == load), path, ledger, f"load-{load}", ["p_partkey"], col="sk")
    return read_with_ids(spark, path).drop("p_size")


@register("listing_ledger", """
WITH t AS (SELECT event_type, dense_rank() OVER (ORDER BY event_type) AS k FROM events),
     n AS (SELECT k, event_type, count(*) AS rows FROM t GROUP BY k, event_type)
SELECT event_type, CASE WHEN k = 1 THEN 'removed' WHEN k = 2 THEN 'changed' WHEN k = 3 THEN 'new' ELSE 'same' END AS status,
       CAST(CASE WHEN k = 2 THEN 2 * rows ELSE rows END AS BIGINT) AS rows
FROM n
""")
def listing_ledger(spark, sf_dir):
    """SRC-13, STR-1: the folders of a landing area, one removed, one replaced and one added between two listings."""
    ev, landing = _t(spark, sf_dir).events, scratch_path(spark, "landing_files")
    types = [r["event_type"] for r in ev.select("event_type").distinct().orderBy("event_type").collect()]
    ledger = FileLedger(spark, scratch_path(spark, "listings"), landing, glob="*.parquet")

    def put(kind: str, times: int = 1) -> None:
        """A delivery of numbered files, which a later one of the same kind replaces."""
        rows = ev.filter(F.col("event_type") == kind)
        folder = f"{landing}/{kind}/delivery"
        (rows if times == 1 else rows.unionAll(rows)).repartition(_parts(spark)).write.mode("overwrite").parquet(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path
        fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        parts = sorted(f.getPath().getName() for f in fs.listStatus(path(folder)) if f.getPath().getName().startswith("part-"))
        for i, part in enumerate(parts):
            fs.rename(path(folder, part), path(folder, f"rows-{i}.parquet"))

    for kind in types[:2] + types[3:]:
        put(kind)
    ledger.take(tag="first")
    put(types[1], times=2)
    put(types[2])
    gone = spark._jvm.org.apache.hadoop.fs.Path(f"{landing}/{types[0]}")
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    found = ledger.take(tag="second")
    kind = F.regexp_extract("path", "([^/]+)/delivery/rows-[0-9]+.parquet$", 1).alias("event_type")
    return found.groupBy(kind, "status").agg(F.sum("rows").alias("rows"))


@register("incremental_time_join", _LEFT_JOIN_TIME)
def incremental_time_join(spark, sf_dir):
    """PL-7 by increment (STR-1 × JN-7): three deliveries, a tenth of the rows one delivery late.

    The watermark allows for two deliveries; after the last one both landings are closed."""
    steps, readings = _steps_and_readings(spark, sf_dir)
    # Instants as epoch milliseconds.
    steps = steps.withColumn("sensor_reading_time", (F.col("sensor_reading_time") + 1) * 1000)
    readings = readings.withColumn("reading_time", (F.col("reading_time") + 1) * 1000)
    last = max(df.agg(F.max(c)).first()[0] or 0 for df, c in ((steps, "sensor_reading_time"), (readings, "reading_time")))
    span = last // 3 + 1
    sides = ((steps, "sensor_reading_time", "serial_number", scratch_path(spark, "steps")),
             (readings, "reading_time", "x_event", scratch_path(spark, "readings")))
    sink, ck = scratch_path(spark, "joined"), scratch_path(spark, "ck")
    for delivery in range(4):
        for df, time, key, path in sides:
            late = (F.col(key) % 10 == 0).cast("int")
            if delivery < 3:
                df.filter(F.least(F.lit(2), F.expr(f"{time} div {span}") + late) == delivery).write.mode("append").parquet(path)
            else:
                close_landing(spark, path, df.schema, time, last + 3 * span)
        run_time_join(spark, sides[0][3], steps.schema, sides[1][3], readings.schema, sink, ck,
                      step_time="sensor_reading_time", reading_time="reading_time",
                      step_cols=("serial_number", "sensor_reading_time", "distance"), reading_cols=("x_event", "x_value"),
                      delay=f"{2 * span // 1000 + 1} seconds")
    return spark.read.parquet(sink).withColumn("sensor_reading_time", F.expr("sensor_reading_time div 1000 - 1"))


# The loads of the checks by increment: each table's time column and the bounds of its three loads.
DQ_LOADS = {"orders": ("o_orderdate", "1994-05-01", "1996-09-01"), "lineitem": ("l_shipdate", "1994-05-01", "1996-09-01"),
            "events": ("ts", "2024-01-11", "2024-01-21")}
DQ_LOAD_SPECS = [s for s in DQ_SPECS if s.table in DQ_LOADS]


@register("dq_by_load", _suite_sql(DQ_LOAD_SPECS))
def dq_by_load(spark, sf_dir):
    """DQ-1 … DQ-5 by increment: after three loads (one repeated) the report is the suite's over all rows."""
    t, path = _t(spark, sf_dir), scratch_path(spark, "check_state")
    for load in (0, 1, 1, 2):
        rows = {}
        for name, (column, *bounds) in DQ_LOADS.items():
            at = sum((F.coalesce(F.col(column) >= F.lit(b).cast("timestamp_ntz"), F.lit(False))).cast("int") for b in bounds)
            rows[name] = getattr(t, name).filter(at == load)
        QS.add_load(spark, path, f"load-{load}", rows, DQ_LOAD_SPECS)
    return QS.report(spark, path, DQ_LOAD_SPECS)


@register("star_v2_job", _with(_SE, _SS, _songplays_v2_sql()) + "SELECT * FROM songplays")
def star_v2_job(spark, sf_dir):
    """PL-2 end to end: stage ×2 → fact → 4 dims → DQ-6 checks; the fact read back."""
    t = _t(spark, sf_dir)
    out = scratch_path(spark, "star_v2")
    paths = star.run_v2(C.staging_events(t), C.staging_songs(t), out, play_page=PLAY_PAGE)
    return star.read_songplays(spark, paths["songplays"])


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


_CHAIN_LANDING = """
customer_landing AS (
  SELECT c_name AS customerName, CAST(c_custkey AS VARCHAR) AS email,
         CAST(c_custkey AS VARCHAR) AS serialNumber,
         CASE WHEN c_acctbal >= 0 THEN c_custkey * 1000 END AS shareWithResearchAsOfDate
  FROM customer
),
accelerometer_landing AS (
  SELECT CAST(user_id AS VARCHAR) AS "user", epoch_us(ts) // 1000 AS "timestamp",
         value AS x, value / 2 AS y, -value AS z
  FROM events
),
step_trainer_landing AS (
  SELECT epoch_us(ts) // 1000 AS sensorReadingTime, CAST(user_id AS VARCHAR) AS serialNumber,
         CAST(floor(value) AS INTEGER) AS distanceFromObject
  FROM events
),
customer_trusted AS (
  SELECT * FROM customer_landing WHERE shareWithResearchAsOfDate IS NOT NULL
),
accelerometer_trusted AS (
  SELECT a."user", a."timestamp", a.x, a.y, a.z
  FROM accelerometer_landing a JOIN customer_trusted c ON a."user" = c.email
),
customer_curated AS (
  SELECT DISTINCT c.* FROM customer_trusted c JOIN accelerometer_trusted a ON c.email = a."user"
),
step_trainer_trusted AS (
  SELECT DISTINCT stl.serialNumber, stl.sensorReadingTime, stl.distanceFromObject
  FROM step_trainer_landing stl RIGHT JOIN customer_curated cc ON stl.serialNumber = cc.serialNumber
)"""


@register("lake_chain", _with(_CHAIN_LANDING) + """
SELECT stt.serialNumber, stt.sensorReadingTime, stt.distanceFromObject, act.x, act.y, act.z
FROM step_trainer_trusted stt
LEFT JOIN accelerometer_trusted act ON act."timestamp" = stt.sensorReadingTime
""")
def lake_chain(spark, sf_dir):
    """PL-3 → PL-7 chained through published JSON catalog tables (SNK-4, SRC-9, DQ-7).

    Landing stand-ins: customers (consent when the balance is not negative),
    every event as an accelerometer reading of its user and as a step
    reading; times are epoch milliseconds, as in the landing tables.
    """
    t = _t(spark, sf_dir)
    c, ev = t.customer, t.events
    customers = c.select(
        F.col("c_name").alias("customerName"),
        F.col("c_custkey").cast("string").alias("email"),
        F.col("c_custkey").cast("string").alias("serialNumber"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey") * 1000)
        .alias("shareWithResearchAsOfDate"),
    )
    accel = ev.select(
        F.col("user_id").cast("string").alias("user"), X.epoch_ms("ts").alias("timestamp"),
        F.col("value").alias("x"), (F.col("value") / 2).alias("y"), (-F.col("value")).alias("z"),
    )
    steps = ev.select(
        X.epoch_ms("ts").alias("sensorReadingTime"),
        F.col("user_id").cast("string").alias("serialNumber"),
        F.floor("value").cast("int").alias("distanceFromObject"),
    )
    result = L.run_chain(customers, accel, steps, scratch_path(spark, "lake"),
                         suffix=_table_name(""))
    return spark.table(result.tables["machine_learning_curated"])


@register("star_v1_job", _with(_SE, _SS) + f"""
SELECT {_START('se.ts')} AS start_time, se.userId AS user_id, se.level, ss.song_id,
       ss.artist_id, se.sessionId AS session_id, se.location, se.userAgent AS user_agent
FROM staging_events se JOIN staging_songs ss ON se.song = ss.title
WHERE se.page = '{PLAY_PAGE}' AND se.userId IS NOT NULL AND ss.song_id IS NOT NULL
""")
def star_v1_job(spark, sf_dir):
    """PL-1 end to end: balanced staging → five tables written → DQ-4; the fact read back."""
    t = _t(spark, sf_dir)
    paths = star.run_v1(C.staging_events(t), C.staging_songs(t), scratch_path(spark, "star_v1"),
                        play_page=PLAY_PAGE)
    # songplay_id is generated (unique, not dense); the comparison is on the content.
    return spark.read.parquet(paths["songplay"]).drop("songplay_id")


@register("external_json_table", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def external_json_table(spark, sf_dir):
    """SRC-10: ``CREATE TABLE … USING json LOCATION`` with declared columns, then read."""
    ev = _t(spark, sf_dir).events
    path = scratch_path(spark, "events_landing")
    ev.write.mode("overwrite").option("timestampNTZFormat", _NTZ_FMT).json(path)
    table = _table_name("events_landing")
    create_external_json_table(spark, table, ev.schema, path,
                               options={"timestampNTZFormat": _NTZ_FMT})
    return read_catalog(spark, None, table)


_V1_STAR_CTES = f"""
songplay AS (
  SELECT {_START('se.ts')} AS start_time, se.userId AS user_id, ss.song_id, ss.artist_id, se.location, se.level
  FROM staging_events se JOIN staging_songs ss ON se.song = ss.title
  WHERE se.page = '{PLAY_PAGE}' AND se.userId IS NOT NULL AND ss.song_id IS NOT NULL
),
songs AS (
  SELECT DISTINCT song_id, title FROM staging_songs WHERE song_id IS NOT NULL
),
artists AS (
  SELECT artist_id, MAX(artist_name) AS name FROM staging_songs WHERE song_id IS NOT NULL
  GROUP BY artist_id
),
users AS (
  SELECT userId AS user_id, MAX(gender) AS gender, MAX(firstName) || ' ' || MAX(lastName) AS name
  FROM staging_events WHERE {_EV_WHERE} GROUP BY userId
)"""
V1_YEAR = 2024


def _v1_query(name: str):
    return lambda spark, sf_dir: A.star_sample_queries(_v1(spark, sf_dir), year=V1_YEAR)[name]


# PL-12 on the v1 star itself: plays are counted by the fact's keys before the dimension joins.
register("v1_top_songs_by_gender", _with(_SE, _SS, _V1_STAR_CTES) + """
SELECT * FROM (
  SELECT CAST(ROW_NUMBER() OVER (PARTITION BY u.gender ORDER BY COUNT(*) DESC, s.title, a.name)
              AS INTEGER) AS rank,
         u.gender, s.title, a.name AS artist, COUNT(*) AS play_count
  FROM songplay sp
  JOIN songs s ON sp.song_id = s.song_id
  JOIN artists a ON sp.artist_id = a.artist_id
  JOIN users u ON sp.user_id = u.user_id
  GROUP BY u.gender, s.title, a.name
) sub
WHERE rank <= 3
""")(_v1_query("top_songs_by_gender"))
register("v1_top_artists_in_year", _with(_SE, _SS, _V1_STAR_CTES) + f"""
SELECT a.name, COUNT(*) AS play_count FROM songplay sp JOIN artists a ON sp.artist_id = a.artist_id
WHERE year(sp.start_time) = {V1_YEAR} GROUP BY a.name ORDER BY play_count DESC, a.name LIMIT 10
""")(_v1_query("top_artists_in_year"))
register("v1_top_users", _with(_SE, _SS, _V1_STAR_CTES) + """
SELECT u.name, COUNT(*) AS play_count FROM songplay sp JOIN users u ON sp.user_id = u.user_id
GROUP BY u.name ORDER BY play_count DESC, u.name LIMIT 3
""")(_v1_query("top_users"))
register("v1_plays_by_location_level", _with(_SE, _SS, _V1_STAR_CTES) + """
SELECT location, level, COUNT(*) AS play_count FROM songplay GROUP BY location, level
""")(_v1_query("plays_by_location_level"))


@register("json_roundtrip", "SELECT * FROM events")
def json_roundtrip(spark, sf_dir):
    """SNK-4 JSON table sink → SRC-1 load by key with the declared schema."""
    ev = _t(spark, sf_dir).events
    table = _table_name("events_json")
    path = scratch_path(spark, table)
    fmt = {"timestampNTZFormat": _NTZ_FMT}
    save_json_table(ev, table, path, mode="overwrite", options=fmt)
    return read_json(spark, path, ev.schema, options=fmt)
