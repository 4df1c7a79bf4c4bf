"""Join operators (JN-1 … JN-10).

Strategy is left to Catalyst and AQE: equi-joins plan as sort-merge joins,
and adaptive execution turns one into a broadcast hash join at run time only
when the *measured* size of a side is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, and splits skewed
partitions (``spark.sql.adaptive.skewJoin.enabled``). An explicit broadcast is
only issued by :func:`broadcast_if_small`, which proves the row bound first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Verdicts of broadcast_if_small per (logical plan, input files, bound).
_SMALL: dict[tuple[int, tuple[str, ...], int], bool] = {}


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast only if it provably has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows. Above the bound the frame is
    returned unchanged and the planner picks a shuffle join. The verdict is
    remembered for the same logical plan over the same input files (a table
    rewritten at its path has new file names and is checked again).

    Meant for tables whose size is bounded by what they describe (nations,
    regions, calendars). Large fact or dimension tables should not be passed
    here: their joins are left to the planner and AQE, which decide from
    measured sizes.
    """
    key = (df.semanticHash(), tuple(sorted(df.inputFiles())), max_rows)
    small = _SMALL.get(key)
    if small is None:
        small = _SMALL[key] = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def key_condition(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                  right_keys: Sequence[str]) -> Column:
    """Conjunction of ``left[l] == right[r]`` over the key pairs."""
    if len(left_keys) != len(right_keys) or not left_keys:
        raise ValueError("key lists must be non-empty and of equal length")
    conds = [left[lk] == right[rk] for lk, rk in zip(left_keys, right_keys)]
    return reduce(lambda a, b: a & b, conds)


def join_keys(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
              right_keys: Sequence[str], how: str = "inner") -> DataFrame:
    """JN-4: join on differently named keys; both key columns are kept."""
    return left.join(right, key_condition(left, right, left_keys, right_keys), how)


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]],
              how: str = "inner") -> DataFrame:
    """JN-3 / JN-9: a fact joined to several dimensions on (fact_key, dim_key).

    Join order follows the list; with ``spark.sql.cbo.enabled`` and table
    statistics Catalyst reorders it.
    """
    out = fact
    for dim, fact_key, dim_key in dims:
        out = out.join(dim, out[fact_key] == dim[dim_key], how)
    return out


def existence_join(left: DataFrame, probe: DataFrame, left_keys: Sequence[str],
                   probe_keys: Sequence[str], dedupe: bool = True) -> DataFrame:
    """JN-5: rows of ``left`` that have a match in ``probe``, probe columns dropped.

    The reference writes an inner join, drops the probe columns and
    deduplicates. That equals a left semi join followed by a whole-row
    deduplication; the semi join never multiplies rows. The probe side is first
    reduced to its distinct keys, which aggregates map-side, so a key that
    holds a large share of the probe rows is collapsed before the shuffle.
    """
    keys = probe.select([F.col(k) for k in probe_keys]).distinct()
    out = left.join(keys, key_condition(left, keys, left_keys, probe_keys), "left_semi")
    return out.dropDuplicates() if dedupe else out


def right_join_distinct(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                        right_keys: Sequence[str], left_cols: Sequence[str],
                        keep_null_row: bool = True) -> DataFrame:
    """JN-6: ``SELECT DISTINCT <left cols> FROM left RIGHT JOIN right ON …``.

    Only left columns are kept, so the result is the distinct left rows that
    match some right row, plus one all-NULL row when some right row has no
    match (T-13; ``keep_null_row=False`` drops it). Written that way it needs a
    semi join over map-side-deduplicated left rows and an anti join that stops
    at the first unmatched right key; neither multiplies rows by the fan-out
    of a hot key, which the literal right join would do before the DISTINCT.
    """
    matched = (
        left.select(*left_cols, *[k for k in left_keys if k not in left_cols])
        .distinct()
    )
    rkeys = right.select(*right_keys).distinct()
    matched = matched.join(
        rkeys, key_condition(matched, rkeys, left_keys, right_keys), "left_semi"
    ).select(*left_cols).distinct()
    if not keep_null_row:
        return matched
    lkeys = left.select(*left_keys).distinct()  # a hot key collapses map-side
    unmatched = rkeys.join(
        lkeys, key_condition(rkeys, lkeys, right_keys, left_keys), "left_anti"
    ).limit(1)
    null_row = unmatched.select(
        [F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left_cols]
    )
    out = matched.unionByName(null_row)
    # With the key among the kept columns a matched row is never all NULL, so
    # the union is already distinct; otherwise a matched all-NULL row could
    # repeat the synthetic one.
    return out if set(left_keys) <= set(left_cols) else out.distinct()


def salted_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                right_keys: Sequence[str], how: str = "left", buckets: int = 16,
                hot_rows: int = 1_000_000, hot: Sequence[str] | None = None) -> DataFrame:
    """Equi-join that spreads hot keys of the *right* side over ``buckets`` tasks.

    AQE splits skewed partitions only on the side that may be split for the
    join type — for a left outer join, the left side. A key holding a third of
    the right side's rows would still be built in one task. Here the right
    keys with more than ``hot_rows`` rows are found with a map-side count; the
    right rows of those keys get a salt in ``[0, buckets)`` from a hash of the
    row, and the matching left rows are replicated once per salt, so each
    (left, right) pair meets in exactly one bucket. Other keys use salt 0.

    For ``how="left"`` a replicated left row whose bucket happens to be empty
    would come out NULL-padded; a hot key always has right rows, so those
    copies are dropped and the result equals the plain join exactly. The hot
    key list is at most ``right rows / hot_rows`` long; how it is joined is left
    to the planner. No job runs while the plan is built. Supports ``inner`` and
    ``left``.

    With ``hot``, a short list of the values (as text) of a single key that are
    hot, nothing is counted and each side is shuffled once; whether a listed key
    is really hot, or in the right side at all, does not change the result.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    if hot is not None:
        return _salted_by_list(left, right, left_keys, right_keys, how, buckets, list(hot))
    hot = (right.groupBy(*right_keys).agg(F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") > hot_rows)
           .select(*[F.col(k).alias(f"_hot{i}") for i, k in enumerate(right_keys)])
           .withColumn("_is_hot", F.lit(True)))

    def tag(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        cond = reduce(lambda a, b: a & b,
                      [df[k] == hot[f"_hot{i}"] for i, k in enumerate(keys)])
        tagged = df.join(hot, cond, "left")
        return tagged.drop(*[f"_hot{i}" for i in range(len(keys))]).withColumn(
            "_is_hot", F.coalesce(F.col("_is_hot"), F.lit(False)))

    r = tag(right, right_keys)
    r = r.withColumn("_salt", F.when(
        F.col("_is_hot"), F.pmod(F.xxhash64(*[F.col(c) for c in right.columns]), F.lit(buckets))
    ).otherwise(F.lit(0))).withColumn("_matched", F.lit(True)).drop("_is_hot")
    lt = tag(left, left_keys)
    lt = lt.withColumn("_salt", F.explode(F.when(
        F.col("_is_hot"), F.sequence(F.lit(0), F.lit(buckets - 1))
    ).otherwise(F.array(F.lit(0)))))
    r = r.withColumnRenamed("_salt", "_rsalt")
    cond = key_condition(lt, r, list(left_keys), list(right_keys)) & (lt["_salt"] == r["_rsalt"])
    out = lt.join(r, cond, how)
    if how == "left":
        out = out.filter(~(F.col("_is_hot") & F.col("_matched").isNull()))
    return out.drop("_is_hot", "_salt", "_rsalt", "_matched")


def _salted_by_list(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], how: str,
                    buckets: int, hot: list[str]) -> DataFrame:
    if len(left_keys) != 1:
        raise ValueError("a list of hot keys is for a single key")

    def is_hot(df: DataFrame, key: str) -> Column:
        return F.coalesce(df[key].cast("string").isin(hot), F.lit(False))

    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in right.columns]), F.lit(buckets))
    # Every row has a salt; rows of other keys have 0 on both sides.
    r = right.withColumn("_rsalt", F.when(is_hot(right, right_keys[0]), salt).otherwise(F.lit(0))).withColumn("_matched", F.lit(True))
    copies = F.when(is_hot(left, left_keys[0]), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    lt = left.withColumn("_salt", F.explode(copies))
    out = lt.join(r, key_condition(lt, r, list(left_keys), list(right_keys)) & (lt["_salt"] == r["_rsalt"]), how)
    out = out.drop("_salt", "_rsalt")
    if how == "left":
        # Copies of a hot row without a partner go; where the right side has no row of a listed key, the row
        # itself comes back. The keys found are at most as many as are listed.
        found = F.broadcast(right.filter(is_hot(right, right_keys[0])).select(F.col(right_keys[0]).alias("_found")).distinct())
        alone = left.filter(is_hot(left, left_keys[0])).join(found, left[left_keys[0]] == found["_found"], "left_anti")
        out = out.filter(F.col("_matched").isNotNull() | ~is_hot(out, left_keys[0])).drop("_matched")
        return out.unionByName(alone, allowMissingColumns=True)
    return out.drop("_matched")
