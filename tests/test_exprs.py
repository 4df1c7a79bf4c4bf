"""FN-1 … FN-15 and the traps T-1, T-2, T-4, T-22, T-23."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from wharf.functions import exprs as X


def one(spark, col, sql_value):
    return spark.sql(f"SELECT {sql_value} AS v").select(col.alias("r")).first()["r"]


def test_epoch_ms_is_integer_division(spark):
    # T-1: 1541121934796 ms → 1541121934 s, not .796
    got = one(spark, X.epoch_ms_to_timestamp(F.col("v")), "1541121934796L")
    assert got == dt.datetime(2018, 11, 2, 1, 25, 34)
    got2 = one(spark, X.epoch_ms_to_timestamp_v2(F.col("v")), "1541121934796L")
    assert got2 == got


def test_epoch_ms_of_zone_less_timestamp_truncates(spark):
    # T-22: zone-less values read as UTC; sub-millisecond digits truncated.
    got = one(spark, X.epoch_ms(F.col("v")), "timestamp_ntz'2024-01-01 00:00:07.999700'")
    assert got == 1704067207999


def test_day_of_week_counts_from_sunday_zero(spark):
    # T-2: 2018-11-03 is a Saturday, 2018-11-04 a Sunday.
    sat = "timestamp'2018-11-03 10:00:00'"
    sun = "timestamp'2018-11-04 10:00:00'"
    mon = "timestamp'2018-11-05 10:00:00'"
    assert one(spark, X.dow_sunday0(F.col("v")), sat) == 6
    assert one(spark, X.dow_sunday0(F.col("v")), sun) == 0
    assert one(spark, X.is_weekday(F.col("v")), sat) is False
    assert one(spark, X.is_weekday(F.col("v")), sun) is False
    assert one(spark, X.is_weekday(F.col("v")), mon) is True


def test_iso_week_of_31_december(spark):
    # FN-4: 2018-12-31 is in ISO week 1 of 2019.
    assert one(spark, X.iso_week(F.col("v")), "timestamp'2018-12-31 12:00:00'") == 1


def test_concat_propagates_null(spark):
    # FN-8: first || ' ' || last is NULL when a part is NULL.
    df = spark.createDataFrame([("Ann", None), ("Bo", "Lee")], "f string, l string")
    got = [r[0] for r in df.select(X.concat_sql("f", F.lit(" "), "l")).collect()]
    assert got == [None, "Bo Lee"]


def test_md5_key_matches_text_concatenation(spark):
    # FN-9 / T-23: md5(sessionid || start_time) with implicit casts.
    df = spark.sql("SELECT 182 AS s, timestamp'2018-11-02 01:25:34' AS t")
    got = df.select(X.md5_key("s", "t")).first()[0]
    assert got == hashlib.md5(b"1822018-11-02 01:25:34").hexdigest()


def test_text_to_number_casts(spark):
    # T-4: '' is NULL, not an ANSI error; scientific notation parses via double.
    df = spark.createDataFrame([("",), ("1.54111E+12",), ("42",)], "v string")
    got = df.select(X.to_int("v"), X.to_bigint_via_double("v")).collect()
    assert got[0][0] is None and got[0][1] is None
    assert got[1][1] == 1541110000000
    assert got[2][0] == 42


def test_null_to_empty_and_sign_label(spark):
    df = spark.createDataFrame([(None, -0.5), ("x", 0.0), ("y", None)], "s string, score double")
    got = df.select(X.null_to_empty("s"), X.sign_label("score")).collect()
    assert [tuple(r) for r in got] == [("", "negative"), ("x", "positive"), ("y", None)]


def test_json_field_and_improvement(spark):
    df = spark.createDataFrame([('{"k": 69, "n": {"a": 1}}', 10.0, 7.5)], "j string, a double, b double")
    r = df.select(X.json_field("j", "$.k"), X.json_field("j", "$.n.a"),
                  X.improvement_pct("a", "b")).first()
    assert r[0] == "69" and r[1] == "1" and r[2] == 25.0


def test_exact_product_sum_is_order_independent(spark):
    vals = [(0.1, 0.07), (0.2, 0.03), (1e6 + 0.01, 0.05)] * 50
    df = spark.createDataFrame(vals, "p double, d double")
    a = df.agg(F.sum(X.exact_product("p", "d")).cast("double")).first()[0]
    b = df.orderBy(F.desc("p")).repartition(7).agg(
        F.sum(X.exact_product("p", "d")).cast("double")).first()[0]
    assert a == b
