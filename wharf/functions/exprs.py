"""Scalar expressions of the warehouse SQL, as Column functions (FN-1 … FN-15).

All of them are built-in Catalyst expressions, so they stay inside whole-stage
code generation; none is a Python UDF.

Warehouse semantics kept here:
* BIGINT ``/ 1000`` is integer division (``div``), so timestamps have whole
  seconds (T-1).
* Day of week counts from 0 = Sunday; Spark's ``dayofweek`` counts from
  1 = Sunday (T-2).
* ``||`` propagates NULL, so ``concat`` is used, never ``concat_ws`` (FN-8).
* Text to number uses ``try_cast`` (ANSI ``cast`` raises on '') and parses
  scientific notation through double first (T-4).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time (FN-1 … FN-6) -------------------------------------------------------


def epoch_ms(ts: ColumnOrName) -> Column:
    """Epoch milliseconds of a timestamp (zone-less values are read as UTC)."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def _whole_seconds(ms: ColumnOrName) -> Column:
    return F.call_function("div", _col(ms).cast("bigint"), F.lit(1000).cast("bigint"))


def epoch_ms_to_timestamp(ms: ColumnOrName) -> Column:
    """FN-1: epoch milliseconds as a timestamp of whole seconds.

    The fraction is cut off towards 1970, as integer division does (T-1)."""
    return F.timestamp_seconds(_whole_seconds(ms))


def epoch_ms_to_timestamp_v2(ms: ColumnOrName) -> Column:
    """FN-2: the value of FN-1, by interval arithmetic on the epoch."""
    seconds = _whole_seconds(ms)
    return F.lit("1970-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(
        secs=seconds.cast("decimal(18,6)")
    )


def hour(ts: ColumnOrName) -> Column:
    return F.hour(_col(ts))


def day(ts: ColumnOrName) -> Column:
    return F.dayofmonth(_col(ts))


def iso_week(ts: ColumnOrName) -> Column:
    """FN-4: ISO week number (31 December may belong to week 1)."""
    return F.weekofyear(_col(ts))


def month(ts: ColumnOrName) -> Column:
    return F.month(_col(ts))


def year(ts: ColumnOrName) -> Column:
    return F.year(_col(ts))


def dow_sunday0(ts: ColumnOrName) -> Column:
    """FN-5: ``EXTRACT(dow …)``, 0 = Sunday … 6 = Saturday."""
    return F.dayofweek(_col(ts)) - F.lit(1)


def is_weekday(ts: ColumnOrName) -> Column:
    """FN-6: ``CASE WHEN dow IN (0, 6) THEN FALSE ELSE TRUE END``."""
    return F.when(dow_sunday0(ts).isin(0, 6), F.lit(False)).otherwise(F.lit(True))


# --- strings, hashing, casts (FN-7 … FN-13) ----------------------------------


def paid_or_free(level: ColumnOrName) -> Column:
    """FN-7 inside AGG-5: ``CASE WHEN level = 'paid' THEN 'paid' ELSE 'free' END``."""
    return F.when(_col(level) == F.lit("paid"), F.lit("paid")).otherwise(F.lit("free"))


def concat_sql(*parts: ColumnOrName) -> Column:
    """FN-8: SQL ``a || b``; any NULL part makes the result NULL."""
    return F.concat(*[_col(p).cast("string") for p in parts])


def md5_key(*parts: ColumnOrName) -> Column:
    """FN-9: ``md5(a || b)`` with the implicit casts to text made explicit (T-23)."""
    return F.md5(concat_sql(*parts))


def to_int(text: ColumnOrName) -> Column:
    """FN-11: text → int; '' and junk give NULL instead of an ANSI error."""
    return _col(text).try_cast("int")


def to_double(text: ColumnOrName) -> Column:
    return _col(text).try_cast("double")


def to_bigint_via_double(text: ColumnOrName) -> Column:
    """T-4: '1.54111E+12' is not a BIGINT literal; parse as double first."""
    return _col(text).try_cast("double").cast("bigint")


def null_to_empty(c: ColumnOrName) -> Column:
    """FN-12: NULL → '' on output."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def json_field(doc: ColumnOrName, path: str) -> Column:
    """FN-13: one field of a JSON text column by JSON path (``$.k``)."""
    return F.get_json_object(_col(doc), path)


# --- arithmetic (FN-10, FN-14, FN-15) ------------------------------------------


def exact_product(a: ColumnOrName, b: ColumnOrName, a_type: str = "decimal(12,2)",
                  b_type: str = "decimal(4,2)") -> Column:
    """FN-10 on money columns held as doubles: multiply as exact decimals (T-21).

    Summing the exact products and casting to double at the end makes the
    result independent of summation order, so it equals any other engine's.
    """
    return _col(a).cast(a_type) * _col(b).cast(b_type)


def improvement_pct(before: ColumnOrName, after: ColumnOrName) -> Column:
    """FN-14: ``100 * (before - after) / before``."""
    return F.lit(100.0) * (_col(before) - _col(after)) / _col(before)


def sign_label(score: ColumnOrName) -> Column:
    """FN-15: score ≥ 0 → 'positive', else 'negative' (NULL stays NULL)."""
    s = _col(score)
    return F.when(s >= 0, F.lit("positive")).when(s < 0, F.lit("negative"))
