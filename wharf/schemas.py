"""Declared schemas of the inputs and outputs (FIXTURES §1 … §9).

Fixed values: the column names and types below must equal the reference's
tables for loads and outputs to line up. Keys of the JSON inputs are in the
files' case (T-3). Warehouse FLOAT is 8 bytes (double); the serving tables'
float is 4 bytes (T-18).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- staging inputs (FIXTURES §1, §2) --------------------------------------------------

STAGING_EVENTS = (
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, "
    "page string, registration bigint, sessionId int, song string, status int, "
    "ts bigint, userAgent string, userId int"
)

STAGING_SONGS = (
    "num_songs int, artist_id string, artist_latitude double, artist_longitude double, "
    "artist_location string, artist_name string, song_id string, title string, "
    "duration double, year int"
)

# --- event CSV (FIXTURES §3): every value read as text, then cast -------------------------

EVENT_CSV_COLUMNS = (
    "artist", "auth", "firstName", "gender", "itemInSession", "lastName", "length",
    "level", "location", "method", "page", "registration", "sessionId", "song",
    "status", "ts", "userId",
)

# --- lake landing tables (FIXTURES §4) ---------------------------------------------------

ACCELEROMETER_LANDING = "user string, timestamp bigint, x double, y double, z double"

CUSTOMER_LANDING = (
    "customerName string, email string, phone string, birthDay string, serialNumber string, "
    "registrationDate bigint, lastUpdateDate bigint, shareWithResearchAsOfDate bigint, "
    "shareWithPublicAsOfDate bigint, shareWithFriendsAsOfDate bigint"
)

STEP_TRAINER_LANDING = "sensorReadingTime bigint, serialNumber string, distanceFromObject int"

# --- star outputs (FIXTURES §5) ------------------------------------------------------------

SONGPLAY_V1 = (
    "songplay_id bigint, start_time timestamp, user_id int, level string, song_id string, "
    "artist_id string, session_id int, location string, user_agent string"
)
SONGPLAYS_V2 = (
    "songplay_id string, start_time timestamp, userid int, level string, song_id string, "
    "artist_id string, sessionid int, location string, useragent string"
)
USERS_V1 = "user_id int, first_name string, last_name string, gender string, level string"
USERS_V2 = "userid int, firstname string, lastname string, gender string, level string"
SONGS = "song_id string, title string, artist_id string, year int, duration double"
ARTISTS_V1 = "artist_id string, name string, location string, latitude double, longitude double"
ARTISTS_V2 = ("artist_id string, artist_name string, artist_location string, "
              "artist_latitude double, artist_longitude double")
TIME_V1 = ("start_time timestamp, hour int, day int, week int, month int, year int, "
           "weekday boolean")
TIME_V2 = "start_time timestamp, hour int, day int, week int, month int, year int, weekday int"

# --- query-first tables (FIXTURES §6): (columns, partition key, clustering key) -----------

SONGS_BY_SESSION = ("sessionId int, itemInSession int, artist string, song string, length float",
                    ("sessionId", "itemInSession"), ())
SONG_BY_SESSION_AND_USER = ("userId int, sessionId int, itemInSession int, artist string, "
                            "song string, firstName string, lastName string",
                            ("userId", "sessionId"), ("itemInSession",))
USER_BY_SONG = ("song string, userId int, firstName string, lastName string",
                ("song",), ("userId",))

# --- SSB star (FIXTURES §7), pipe-delimited gzip -------------------------------------------

SSB_LINEORDER = (
    "lo_orderkey int, lo_linenumber int, lo_custkey int, lo_partkey int, lo_suppkey int, "
    "lo_orderdate int, lo_orderpriority string, lo_shippriority string, lo_quantity int, "
    "lo_extendedprice int, lo_ordertotalprice int, lo_discount int, lo_revenue int, "
    "lo_supplycost int, lo_tax int, lo_commitdate int, lo_shipmode string"
)
SSB_PART = ("p_partkey int, p_name string, p_mfgr string, p_category string, p_brand1 string, "
            "p_color string, p_type string, p_size int, p_container string")
SSB_SUPPLIER = ("s_suppkey int, s_name string, s_address string, s_city string, s_nation string, "
                "s_region string, s_phone string")
SSB_CUSTOMER = ("c_custkey int, c_name string, c_address string, c_city string, c_nation string, "
                "c_region string, c_phone string, c_mktsegment string")
SSB_DWDATE = (
    "d_datekey int, d_date string, d_dayofweek string, d_month string, d_year int, "
    "d_yearmonthnum int, d_yearmonth string, d_daynuminweek int, d_daynuminmonth int, "
    "d_daynuminyear int, d_monthnuminyear int, d_weeknuminyear int, d_sellingseason string, "
    "d_lastdayinweekfl string, d_lastdayinmonthfl string, d_holidayfl string, d_weekdayfl string"
)
SSB_TABLES = {
    "lineorder": SSB_LINEORDER, "part": SSB_PART, "supplier": SSB_SUPPLIER,
    "customer": SSB_CUSTOMER, "dwdate": SSB_DWDATE,
}

# --- tickets (FIXTURES §8), `;`-separated gzip ----------------------------------------------

TICKETS = (
    "id double, sporting_event_id double, sport_location_id double, seat_level decimal(1,0), "
    "seat_section string, seat_row string, seat string, ticketholder_id double, "
    "ticket_price decimal(8,2)"
)

# --- question bank (FIXTURES §9): required fields are not nullable ---------------------------

QUESTION = T.StructType([
    T.StructField("question", T.StringType(), False),
    T.StructField("subject", T.StringType(), False),
    T.StructField("correct", T.StringType(), False),
    T.StructField("use", T.StringType(), False),
    T.StructField("responseA", T.StringType(), False),
    T.StructField("responseB", T.StringType(), False),
    T.StructField("responseC", T.StringType(), True),
    T.StructField("responseD", T.StringType(), True),
])


def struct(ddl: str) -> T.StructType:
    """A DDL column list as a ``StructType`` (needs an active session)."""
    return T.StructType.fromDDL(ddl)
