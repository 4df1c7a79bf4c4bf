"""Query-first serving tables (PL-8 … PL-11).

The reference builds one keyed table per question: a primary key made of a
partition key and optional clustering columns, filled by row-by-row upserts,
then read by key. Here a serving table is one bulk job:

1. reduce the input to one row per primary key, the last arrival winning
   (SNK-6, :func:`wharf.operators.upsert.last_write_wins`);
2. write it bucketed on the partition key and sorted on the clustering key
   (SNK-7), so a key lookup reads one bucket and skips row groups by min/max.

``clustered`` returns the same rows laid out that way without a catalog, for
callers that write plain files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharf.functions import exprs as X
from wharf.operators.projections import key_lookup, non_empty
from wharf.operators.upsert import last_write_wins
from wharf.operators.windows import clustered
from wharf.sinks.writers import quoted_csv, save_bucketed

# The 11 of 17 event-CSV columns kept by the clean-up, in file order.
CLEAN_COLUMNS = (
    "artist", "firstName", "gender", "itemInSession", "lastName", "length",
    "level", "location", "sessionId", "song", "userId",
)


def clean_event_csv(raw: DataFrame, artist_col: str = "artist",
                    columns: Sequence[str] = CLEAN_COLUMNS) -> DataFrame:
    """PL-8 transform: drop rows without an artist, keep 11 columns (FLT-10, PRJ-6)."""
    return raw.filter(non_empty(artist_col)).select(*columns)


def write_clean_csv(raw: DataFrame, path: str, files: int | None = None) -> None:
    """PL-8 sink: all fields quoted, with header (SNK-5)."""
    quoted_csv(clean_event_csv(raw), path, header=True, files=files)


def typed_events(clean: DataFrame) -> DataFrame:
    """Casts of the cleaned text columns before insert (FN-11, T-4); columns
    beyond the eleven (e.g. an arrival order) are passed through."""
    extra = [c for c in clean.columns if c not in CLEAN_COLUMNS]
    return clean.select(
        "artist", "firstName", "gender", X.to_int("itemInSession").alias("itemInSession"),
        "lastName", X.to_double("length").cast("float").alias("length"), "level", "location",
        X.to_int("sessionId").alias("sessionId"), "song", X.to_int("userId").alias("userId"),
        *extra,
    )


def serving_table(df: DataFrame, key_cols: Sequence[str], value_cols: Sequence[str],
                  order_cols: Sequence[str]) -> DataFrame:
    """One row per primary key with the last-arriving values (SNK-6, T-17)."""
    order_only = [c for c in order_cols if c not in key_cols and c not in value_cols]
    reduced = last_write_wins(df.select(*key_cols, *value_cols, *order_only), key_cols,
                              order_cols)
    return reduced.select(*key_cols, *value_cols)


def lookup(table: DataFrame, key: Mapping[str, object], columns: Sequence[str],
           order_by: Sequence[str] = ()) -> DataFrame:
    """FLT-12 / FLT-13 (+ SRT-4): key lookup, optionally ordered by clustering key."""
    out = key_lookup(table, key).select(*columns, *[c for c in order_by if c not in columns])
    if order_by:
        out = out.orderBy(*order_by)
    return out


def save_serving_table(df: DataFrame, table: str, partition_key: Sequence[str],
                       clustering: Sequence[str], buckets: int, path: str | None = None) -> None:
    """SNK-7 for a serving table: bucket on the partition key, sort by the clustering key."""
    save_bucketed(df, table, bucket_by=list(partition_key), buckets=buckets,
                  sort_by=[*partition_key, *clustering], path=path)


def clustered_layout(df: DataFrame, partition_key: Sequence[str],
                     clustering: Sequence[str]) -> DataFrame:
    """The serving layout for plain-file sinks (SRT-4)."""
    return clustered(df, partition_key, clustering)


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """PL-11: a (song, user) primary key keeps each listener once."""
    return df.select(F.col(a), F.col(b)).distinct()


# The three questions the tables answer (key values of the lookups).
LOOKUP_SESSION_ITEM = {"sessionId": 338, "itemInSession": 4}
LOOKUP_USER_SESSION = {"userId": 10, "sessionId": 182}
LOOKUP_SONG = {"song": "All Hands Against His Own"}


def build_query_tables(events: DataFrame, base: str, buckets: int,
                       order_cols: Sequence[str] = ("ts",), suffix: str = "") -> dict[str, str]:
    """PL-9 … PL-11: the three query-first tables from typed events.

    ``events`` has the cleaned, typed columns (:func:`typed_events`) plus the
    arrival-order columns; each table keeps the last arrival per primary key
    (SNK-6) and is bucketed on its partition key, sorted by its clustering
    key (SNK-7). Returns ``{table: catalog name}``.
    """
    specs = {
        "songs_by_session": (["sessionId", "itemInSession"], ["artist", "song", "length"],
                             ["sessionId"], ["itemInSession"]),
        "song_by_session_and_user": (["userId", "sessionId", "itemInSession"],
                                     ["artist", "song", "firstName", "lastName"],
                                     ["userId", "sessionId"], ["itemInSession"]),
        "user_by_song": (["song", "userId"], ["firstName", "lastName"], ["song"], ["userId"]),
    }
    names = {}
    for table, (key, values, part_key, clustering) in specs.items():
        name = f"{table}{suffix}"
        save_serving_table(serving_table(events, key, values, list(order_cols)), name,
                           part_key, clustering, buckets, path=f"{base.rstrip('/')}/{table}")
        names[table] = name
    return names


def answer_queries(spark, names: Mapping[str, str]) -> dict[str, DataFrame]:
    """The three lookups (FLT-12, FLT-12 + SRT-4, FLT-13) on the built tables."""
    t = {k: spark.table(v) for k, v in names.items()}
    return {
        "songs_by_session": lookup(t["songs_by_session"], LOOKUP_SESSION_ITEM,
                                   ["artist", "song", "length"]),
        "song_by_session_and_user": lookup(t["song_by_session_and_user"], LOOKUP_USER_SESSION,
                                           ["artist", "song", "firstName", "lastName"],
                                           order_by=["itemInSession"]),
        "user_by_song": lookup(t["user_by_song"], LOOKUP_SONG, ["firstName", "lastName"]),
    }
