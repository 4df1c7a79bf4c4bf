"""Star-schema analytics: the sample query set (PL-12) and the SSB queries (PL-13).

Each query is a function over DataFrames in the star's column names, so it
runs unchanged on a star built by :mod:`wharf.plans.star`, on SSB tables, or
on the conformed driver tables. Joins are plain equi-joins; Catalyst turns
the comma-join form into equi-joins and AQE broadcasts a dimension only when
its measured size is under the threshold. Money sums are exact decimals cast
to double at the end (T-21), so results do not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharf.functions import exprs as X
from wharf.operators.aggregates import count_by, exact_sum
from wharf.operators.windows import order_spec, top_k, top_n_per_group

# --- PL-12: sample queries ------------------------------------------------------------


def popular_per_group(plays: DataFrame, group_col: str, item_cols: Sequence[str],
                      n: int = 3, count_col: str = "play_count",
                      weight: str | None = None) -> DataFrame:
    """Query 1: the n most played items per group (WIN-1, WIN-2, FLT-11).

    ``ROW_NUMBER() OVER (PARTITION BY group ORDER BY COUNT(*) DESC)`` over the
    aggregate; the item columns break ties (T-7). ``weight`` names a column of
    pre-aggregated play counts (rows of ``plays`` then stand for that many
    plays), so callers can count the fact on its join keys before joining the
    dimensions.
    """
    keys = [group_col, *item_cols]
    counts = (count_by(plays, keys, alias=count_col) if weight is None else
              plays.groupBy(*keys).agg(F.sum(weight).cast("bigint").alias(count_col)))
    ranked = top_n_per_group(counts, [group_col], order_spec(desc=[count_col], asc=item_cols), n)
    return ranked.select("rank", group_col, *item_cols, count_col)


def top_by_count(plays: DataFrame, key: str, k: int, count_col: str = "play_count",
                 weight: str | None = None) -> DataFrame:
    """Queries 2 and 3: ``GROUP BY key ORDER BY COUNT(*) DESC LIMIT k`` (LIM-1, SRT-1).

    ``weight`` as in :func:`popular_per_group`."""
    counts = (count_by(plays, [key], alias=count_col) if weight is None else
              plays.groupBy(key).agg(F.sum(weight).cast("bigint").alias(count_col)))
    return top_k(counts, order_spec(desc=[count_col], asc=[key]), k)


def count_by_sorted(plays: DataFrame, keys: Sequence[str], sort_key: str,
                    count_col: str = "play_count") -> DataFrame:
    """Query 4: ``GROUP BY keys ORDER BY sort_key`` (AGG-1, SRT-2; NULLs last, T-6)."""
    return count_by(plays, keys, alias=count_col).orderBy(F.col(sort_key).asc_nulls_last(), *keys)


def full_name(first: str, last: str) -> F.Column:
    """``first_name || ' ' || last_name`` — NULL if either part is NULL (FN-8)."""
    return X.concat_sql(F.col(first), F.lit(" "), F.col(last))


# --- PL-13: Star Schema Benchmark queries ------------------------------------------------


def date_dim(dates: DataFrame, date_col: str) -> DataFrame:
    """``dwdate`` from the distinct calendar dates of ``date_col``.

    ``d_datekey`` is the INT ``yyyymmdd`` key the fact joins on. The table's
    size is bounded by the calendar (one row per day in the range), not by
    the fact's volume.
    """
    d = F.to_date(F.col(date_col))
    return dates.select(d.alias("d_date")).distinct().select(
        (F.year("d_date") * 10000 + F.month("d_date") * 100 + F.dayofmonth("d_date"))
        .cast("int").alias("d_datekey"),
        "d_date",
        F.year("d_date").alias("d_year"),
        F.date_format("d_date", "MMMyyyy").alias("d_yearmonth"),
    )


def revenue_expr() -> F.Column:
    """``lo_extendedprice * lo_discount`` as an exact decimal product."""
    return X.exact_product("lo_extendedprice", "lo_discount")


def net_revenue_expr() -> F.Column:
    """``lo_revenue``: extended price after discount, exact."""
    return F.col("lo_extendedprice").cast("decimal(12,2)") * (
        F.lit(1) - F.col("lo_discount").cast("decimal(4,2)")
    )


def ssb_one_dim(lineorder: DataFrame, dwdate: DataFrame, year: int, discount_lo: float,
                discount_hi: float, max_quantity: float) -> DataFrame:
    """oneDim: ``sum(lo_extendedprice*lo_discount)`` for one year, a discount
    band (BETWEEN, inclusive) and a quantity bound (AGG-6, FLT-5, FLT-6, JN-8)."""
    lo = lineorder.filter(
        F.col("lo_discount").between(discount_lo, discount_hi)
        & (F.col("lo_quantity") < max_quantity)
    )
    d = dwdate.filter(F.col("d_year") == year)
    return lo.join(d, lo["lo_orderdate"] == d["d_datekey"]).agg(
        exact_sum(revenue_expr()).alias("revenue")
    )


def ssb_two_dim(lineorder: DataFrame, dwdate: DataFrame, part: DataFrame, supplier: DataFrame,
                category: str, region: str, revenue: F.Column | None = None) -> DataFrame:
    """twoDim: revenue by (year, brand) for one category and one supplier region
    (AGG-8, JN-9). ``revenue`` defaults to :func:`net_revenue_expr`; pass
    ``F.col("lo_revenue")`` on SSB data, which stores it."""
    p = part.filter(F.col("p_category") == category).select("p_partkey", "p_brand1")
    s = supplier.filter(F.col("s_region") == region).select("s_suppkey")
    return (
        lineorder.join(dwdate, lineorder["lo_orderdate"] == dwdate["d_datekey"])
        .join(p, F.col("lo_partkey") == F.col("p_partkey"))
        .join(s, F.col("lo_suppkey") == F.col("s_suppkey"))
        .groupBy("d_year", "p_brand1")
        .agg(exact_sum(net_revenue_expr() if revenue is None else revenue).alias("revenue"))
    )


def ssb_drill(lineorder: DataFrame, dwdate: DataFrame, customer: DataFrame, supplier: DataFrame,
              cities: Sequence[str], yearmonth: str, revenue: F.Column | None = None) -> DataFrame:
    """drill: revenue by (customer city, supplier city, year) for two cities on
    each side and one month, ``ORDER BY d_year ASC, revenue DESC`` (FLT-7, SRT-3).
    ``revenue`` as in :func:`ssb_two_dim`."""
    c = customer.filter(F.col("c_city").isin(list(cities))).select("c_custkey", "c_city")
    s = supplier.filter(F.col("s_city").isin(list(cities))).select("s_suppkey", "s_city")
    d = dwdate.filter(F.col("d_yearmonth") == yearmonth)
    return (
        lineorder.join(d, lineorder["lo_orderdate"] == d["d_datekey"])
        .join(c, F.col("lo_custkey") == F.col("c_custkey"))
        .join(s, F.col("lo_suppkey") == F.col("s_suppkey"))
        .groupBy("c_city", "s_city", "d_year")
        .agg(exact_sum(net_revenue_expr() if revenue is None else revenue).alias("revenue"))
        .orderBy(F.col("d_year").asc_nulls_last(), F.col("revenue").desc_nulls_last(),
                 "c_city", "s_city")
    )


def ssb_same_dist(lineorder: DataFrame, part: DataFrame) -> DataFrame:
    """oneDimSameDist: revenue by order date over the part join (AGG-7, JN-8)."""
    p = part.select("p_partkey")
    return (
        lineorder.join(p, lineorder["lo_partkey"] == p["p_partkey"])
        .groupBy("lo_orderdate")
        .agg(exact_sum(revenue_expr()).alias("revenue"))
        .orderBy(F.col("lo_orderdate").asc_nulls_last())
    )


# --- PL-12 on a built v1 star ---------------------------------------------------------------


def star_sample_queries(tables: dict[str, DataFrame], year: int) -> dict[str, DataFrame]:
    """The four sample queries over a v1 star (``songplay``, ``songs``, ``artists``,
    ``users``, ``time_dim`` as built by :func:`wharf.plans.star.build_v1`).

    1. the 3 most played songs per gender; 2. the 10 most played artists in
    ``year``; 3. the 3 users with the most plays; 4. plays per location and
    level, ordered by location. Ties are broken by the output columns (T-7).
    """
    sp, songs, artists = tables["songplay"], tables["songs"], tables["artists"]
    users, time_dim = tables["users"], tables["time_dim"]

    def plays(fact: DataFrame, *keys: str) -> DataFrame:
        """Plays counted by the fact's keys, before the joins with the dimensions."""
        return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("plays"))

    by_gender = (
        plays(sp, "song_id", "artist_id", "user_id").join(songs.select("song_id", "title"), "song_id")
        .join(artists.select("artist_id", F.col("name").alias("artist")), "artist_id")
        .join(users.select("user_id", "gender"), "user_id")
    )
    in_year = sp.join(time_dim.filter(F.col("year") == year).select("start_time"), "start_time")
    by_artist = plays(in_year, "artist_id").join(artists.select("artist_id", "name"), "artist_id")
    by_user = plays(sp, "user_id").join(users.select("user_id", full_name("first_name", "last_name").alias("name")),
                      "user_id")
    return {
        "top_songs_by_gender": popular_per_group(by_gender, "gender", ["title", "artist"], 3, weight="plays"),
        "top_artists_in_year": top_by_count(by_artist, "name", 10, weight="plays"),
        "top_users": top_by_count(by_user, "name", 3, weight="plays"),
        "plays_by_location_level": count_by_sorted(sp, ["location", "level"], "location"),
    }
