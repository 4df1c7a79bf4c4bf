"""Conforming the driver tables to the reference's staging shapes.

The reference loads a song catalogue and an event log into two staging tables
and builds every star table from them. The driver supplies TPC-H-like tables
instead, so the staging shapes are derived here, once, with plain joins and
column expressions:

* ``staging_events`` (event log): ``events`` with its ``props.k`` part, its
  customer and the customer's nation. ``event_type = 'purchase'`` plays the
  role of ``page = 'NextSong'``.
* ``staging_songs`` (song catalogue): ``part`` (``p_brand`` is the artist,
  ``p_retailprice`` the duration). Two parts share a title, so a join on the
  title alone has a few real duplicates and grows with the plays; every tenth
  part is missing, so that some plays have no song.
* ``lineorder``: ``lineitem`` with its order's date, customer and priority,
  the fact table of the layout study.

Scale notes: ``events``/``lineitem`` are the big sides; ``part``, ``customer``
and ``orders`` grow with them and are joined by shuffle (AQE turns a join into
a broadcast at run time only when the measured side is small, and splits
skewed partitions). ``nation`` and ``region`` have a fixed size (25 and 5 rows
at every scale factor) and are broadcast behind a row-count check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharf.functions import exprs as X
from wharf.operators.joins import broadcast_if_small
from wharf.sources.tables import Tables

# The level of an event: events worth at least this value count as 'paid'.
PAID_VALUE_THRESHOLD = 50.0


# Parts whose key is a multiple of this are not in the song catalogue.
MISSING_SONG = 10


def song_title(key: str) -> F.Column:
    """The stand-in title of a part: shared by two parts."""
    return F.concat(F.lit("Song "), F.expr(f"{key} div 2").cast("string"))


def staging_events(t: Tables) -> DataFrame:
    """The event-log staging table (FIXTURES §1 columns, camelCase)."""
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    p = t.part.select("p_partkey", "p_brand", "p_retailprice")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = broadcast_if_small(t.nation.select("n_nationkey", "n_name"), max_rows=10_000)
    return (
        e.withColumn("_k", X.json_field("props", "$.k").cast("bigint"))
        .join(p, F.col("_k") == F.col("p_partkey"), "left")
        .join(c, F.col("user_id") == F.col("c_custkey"), "left")
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("p_brand").alias("artist"),
            F.col("c_name").alias("firstName"),
            F.col("c_mktsegment").alias("lastName"),
            F.substring("c_mktsegment", 1, 1).alias("gender"),
            F.pmod(F.col("event_id"), F.lit(10)).cast("int").alias("itemInSession"),
            F.col("p_retailprice").alias("length"),
            F.when(F.col("value") >= PAID_VALUE_THRESHOLD, F.lit("paid"))
            .otherwise(F.lit("free")).alias("level"),
            F.col("n_name").alias("location"),
            F.col("event_type").alias("page"),
            F.expr("event_id div 10").alias("sessionId"),
            song_title("p_partkey").alias("song"),
            X.epoch_ms("ts").alias("ts"),
            F.col("c_mktsegment").alias("userAgent"),
            F.col("user_id").alias("userId"),
        )
    )


def staging_songs(t: Tables) -> DataFrame:
    """The song-catalogue staging table (FIXTURES §2 columns)."""
    return t.part.filter(F.col("p_partkey") % MISSING_SONG != 0).select(
        F.lit(1).alias("num_songs"),
        F.col("p_brand").alias("artist_id"),
        F.col("p_size").cast("double").alias("artist_latitude"),
        F.col("p_retailprice").alias("artist_longitude"),
        F.col("p_type").alias("artist_location"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_partkey").cast("string").alias("song_id"),
        song_title("p_partkey").alias("title"),
        F.col("p_retailprice").alias("duration"),
        F.col("p_size").alias("year"),
    )


def date_key(ts: str) -> F.Column:
    """SSB date key: the calendar date as an INT ``yyyymmdd``."""
    d = F.col(ts)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def lineorder(t: Tables) -> DataFrame:
    """SSB ``lineorder``: one row per line item with its order's attributes."""
    li = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount",
    )
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner").select(
        F.col("l_orderkey").alias("lo_orderkey"),
        F.col("l_linenumber").alias("lo_linenumber"),
        F.col("o_custkey").alias("lo_custkey"),
        F.col("l_partkey").alias("lo_partkey"),
        F.col("l_suppkey").alias("lo_suppkey"),
        date_key("o_orderdate").alias("lo_orderdate"),
        F.col("l_quantity").alias("lo_quantity"),
        F.col("l_extendedprice").alias("lo_extendedprice"),
        F.col("l_discount").alias("lo_discount"),
    )


# --- the same derivations as SQL, for the DuckDB oracle ---------------------------

STAGING_EVENTS_SQL = f"""
staging_events AS (
  SELECT p.p_brand AS artist, c.c_name AS firstName, c.c_mktsegment AS lastName,
         substr(c.c_mktsegment, 1, 1) AS gender,
         CAST(e.event_id % 10 AS INTEGER) AS itemInSession,
         p.p_retailprice AS length,
         CASE WHEN e.value >= {PAID_VALUE_THRESHOLD} THEN 'paid' ELSE 'free' END AS level,
         n.n_name AS location, e.event_type AS page, e.event_id // 10 AS sessionId,
         'Song ' || CAST(p.p_partkey // 2 AS VARCHAR) AS song, epoch_us(e.ts) // 1000 AS ts, c.c_mktsegment AS userAgent,
         e.user_id AS userId
  FROM events e
  LEFT JOIN part p ON CAST(json_extract_string(e.props, '$.k') AS BIGINT) = p.p_partkey
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

STAGING_SONGS_SQL = f"""
staging_songs AS (
  SELECT 1 AS num_songs, p_brand AS artist_id, CAST(p_size AS DOUBLE) AS artist_latitude,
         p_retailprice AS artist_longitude, p_type AS artist_location, p_brand AS artist_name,
         CAST(p_partkey AS VARCHAR) AS song_id,
         'Song ' || CAST(p_partkey // 2 AS VARCHAR) AS title, p_retailprice AS duration,
         p_size AS year
  FROM part WHERE p_partkey % {MISSING_SONG} <> 0
)"""

LINEORDER_SQL = """
lineorder AS (
  SELECT l_orderkey AS lo_orderkey, l_linenumber AS lo_linenumber, o_custkey AS lo_custkey,
         l_partkey AS lo_partkey, l_suppkey AS lo_suppkey,
         CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER)
           AS lo_orderdate,
         l_quantity AS lo_quantity, l_extendedprice AS lo_extendedprice, l_discount AS lo_discount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def sql_epoch_ms_to_timestamp(ms: str) -> str:
    """DuckDB spelling of FN-1 (integer division, whole seconds)."""
    return f"(TIMESTAMP '1970-01-01 00:00:00' + to_seconds({ms} // 1000))"
