"""Ledgers, summaries, the clustered layout and the stream-stream join."""

import os
import random

import pytest
from pyspark.sql import functions as F

from wharf.operators.hot_keys import HotKeys, join_with_hot_keys
from wharf.operators.identity import IdentityLedger, IdRange, append_with_ids, read_with_ids
from wharf.operators.quality import DataQualityError
from wharf.plans import clustered
from wharf.sinks.commits import CommitConflict, CommitLog
from wharf.sources.listing import FileLedger
from wharf.streaming.joins import close_landing, run_time_join


def as_set(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- commits and identity --------------------------------------------------------------


def test_commit_log_has_one_entry_per_number(spark, tmp):
    log = CommitLog(spark, tmp + "/log")
    assert log.last() is None and log.named("a") is None
    log.add(0, {"v": 1}, name="a")
    with pytest.raises(CommitConflict):
        log.add(0, {"v": 2}, name="b")
    # The pointer of the loser names an entry that is not its own.
    assert log.named("a")["v"] == 1 and log.named("b") is None and log.last() == (0, {"v": 1, "name": "a"})


def test_ids_go_on_over_loads(spark, tmp):
    ledger = IdentityLedger(spark, tmp + "/ids")
    loads = {"a": range(5), "b": [], "c": range(100, 107)}
    for _ in range(2):  # all loads are repeated
        for load, keys in loads.items():
            df = spark.createDataFrame([(k, "x") for k in keys], "k long, v string").repartition(3)
            append_with_ids(df, tmp + "/t", ledger, load, ["k"])
        got = as_set(read_with_ids(spark, tmp + "/t").select("id", "k"))
        assert got == sorted([*enumerate(range(5)), *enumerate(range(100, 107), 5)], key=str)
    assert ledger.ranges() == [IdRange(0, 5), IdRange(5, 0), IdRange(5, 7)]
    with pytest.raises(ValueError, match="has 5 ids"):
        ledger.reserve("a", 6)


def test_two_loads_that_reserve_at_once_get_two_ranges(spark, tmp):
    ledger = IdentityLedger(spark, tmp + "/ids", start=1)
    ledger.reserve("a", 10)
    real, calls = ledger.log.last, []

    def behind():
        calls.append(1)
        return real() if len(calls) > 1 else (0, {"first": 1, "count": 10})

    IdentityLedger(spark, tmp + "/ids").reserve("b", 3)
    ledger.log.last = behind  # as if it had looked before b
    assert ledger.reserve("c", 2) == IdRange(14, 2) and len(calls) == 2


# --- listings ---------------------------------------------------------------------------


def test_file_ledger_tells_new_changed_and_removed(spark, tmp):
    folder = tmp + "/land with space+"

    def put(name, rows):
        spark.createDataFrame(rows, "a long, b string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")

    ledger = FileLedger(spark, tmp + "/ledger", folder, glob="*.parquet")
    assert ledger.take().count() == 0  # no folder yet

    def status():
        return {(r["path"].split("/")[-2], r["status"], r["rows"]) for r in ledger.take().collect()}

    put("one", [(1, "x"), (2, "y")])
    put("two", [(3, "z")])
    put("three", [])
    assert status() == {("one", "new", 2), ("two", "new", 1), ("three", "new", 0)}
    assert status() == {("one", "same", 2), ("two", "same", 1), ("three", "same", 0)}
    part = next(os.path.join(folder, "one", f) for f in os.listdir(folder + "/one") if f.endswith(".parquet"))
    os.utime(part, (1, 1))  # touched, not changed
    with open(part, "rb") as f:
        held = f.read()
    two = next(os.path.join(folder, "two", f) for f in os.listdir(folder + "/two") if f.endswith(".parquet"))
    with open(two, "wb") as f:
        f.write(held)  # other rows under the old name
    for f in os.listdir(folder + "/two"):
        if f.endswith(".crc"):
            os.remove(os.path.join(folder, "two", f))
    put("four", [(9, None)])
    assert status() == {("one", "same", 2), ("two", "changed", 2), ("three", "same", 0), ("four", "new", 1)}
    os.remove(two)
    first = ledger.take(tag="run 5")
    assert {(r["path"].split("/")[-2], r["status"]) for r in first.collect()} == {
        ("one", "same"), ("two", "removed"), ("three", "same"), ("four", "same")}
    put("five", [(1, "a")])
    assert as_set(ledger.take(tag="run 5")) == as_set(first)
    assert ("five", "new", 1) in status()


# --- hot keys ----------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["left", "inner"])
def test_joins_with_listed_hot_keys_equal_the_plain_join(spark, tmp, how):
    rng = random.Random(3)
    left = spark.createDataFrame([(rng.choice([1, 1, 2, 3, 4, None]), i) for i in range(60)], "k long, x long")
    right = spark.createDataFrame([(rng.choice([1, 1, 1, 2, 5, None]), i) for i in range(80)], "rk long, y long")
    plain = as_set(left.join(right, F.col("k") == F.col("rk"), how))
    state = HotKeys(spark, tmp + "/hot")
    for load in ("a", "b", "b"):
        state.add(load, right.filter(F.col("y") % 2 == int(load == "b")), "rk")
    hot = state.hot(more_than=20)
    assert hot == ["1"] and state.hot(more_than=10_000) == []
    # 4 is not in the right side, 9 in neither.
    for keys in (hot, ["1", "2", "4", "9"], []):
        assert as_set(join_with_hot_keys(left, right, "k", "rk", keys, how=how, buckets=5)) == plain


def test_join_with_listed_hot_keys_shuffles_each_side_once(spark):
    left = spark.range(1000).withColumnRenamed("id", "k")
    right = spark.range(1000).select((F.col("id") % 3).alias("rk"), F.col("id").alias("y"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = join_with_hot_keys(left, right, "k", "rk", ["0"], how="inner")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        plan = join_with_hot_keys(left, right, "k", "rk", [])._jdf.queryExecution().executedPlan().toString()
        assert "salt" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# --- clustered layout ------------------------------------------------------------------------


def test_clustered_layout_skips_files_and_row_groups(spark, tmp):
    import pyarrow.parquet as pq

    n = 40_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(20240101)).otherwise(20230101 + F.col("id") % 300).cast("int").alias("day"),
        (F.col("id") * 7919 % 1000).alias("part"), (F.col("id") * 104729 % 97).alias("supp"),
        F.when(F.col("id") % 50 != 0, F.col("id")).alias("v"))
    cols = ["day", "part", "supp"]
    clustered.write_clustered(df, tmp + "/t", cols, files=32, bits=4, row_group_bytes=8 << 10)
    everything = clustered.read_clustered(spark, tmp + "/t", cols, {})
    assert everything.all_files == len(everything.files) and as_set(everything.rows) == as_set(df)
    for ranges in ({"part": (10, 60)}, {"supp": (0, 5), "part": (0, 200)}, {"day": (20230101, 20230120)}, {"day": (20240101, 20240101), "supp": (1, 9)}):
        got = clustered.read_clustered(spark, tmp + "/t", cols, ranges)
        condition = F.lit(True)
        for c, (low, high) in ranges.items():
            condition &= F.col(c).between(low, high)
        assert as_set(got.rows) == as_set(df.filter(condition))
        assert 0 < len(got.files) < 0.75 * got.all_files, ranges
    # The hot day has a third of all rows and is spread over files.
    hot = clustered.read_clustered(spark, tmp + "/t", cols, {"day": (20240101, 20240101)})
    assert max(r["n"] for r in hot.rows.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()) < n / 8
    assert clustered.read_clustered(spark, tmp + "/t", cols, {"day": None}).rows.count() == 0
    # Row groups of a file: their ranges of the leading column are narrower than the table's.
    got = clustered.read_clustered(spark, tmp + "/t", cols, {"part": (10, 60)})
    groups = [pq.ParquetFile(f.removeprefix("file://").removeprefix("file:")).metadata for f in got.files]
    stats = [g.row_group(i).column(1).statistics for g in groups for i in range(g.num_row_groups)]
    assert sum(s.min <= 60 and s.max >= 10 for s in stats) <= len(stats)
    assert "PushedFilters: [IsNotNull(part), GreaterThanOrEqual(part,10), LessThanOrEqual(part,60)]" in (
        got.rows._jdf.queryExecution().executedPlan().toString())


def test_range_numbers_and_z_values(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (1.0,), (1.5,), (9.0,)], "a double")
    assert [r[0] for r in df.select(clustered.range_number(F.col("a"), [1.0, 2.0, 3.0])).collect()] == [0, 0, 1, 1, 3]
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a long, b long")
    bounds = {"a": [1, 2, 3], "b": [1, 2, 3]}
    got = {(r["a"], r["b"]): r["z"] for r in df.withColumn("z", clustered.z_value(["a", "b"], bounds, 2)).collect()}
    spread = lambda x: (x & 1) | (x & 2) << 1
    assert got == {(a, b): spread(a) << 1 | spread(b) for a in range(4) for b in range(4)}


def test_clustered_layout_of_few_and_null_rows(spark, tmp):
    for name, rows in (("none", []), ("nulls", [(None, None), (1, None), (1, 2)])):
        df = spark.createDataFrame(rows, "a long, b long")
        clustered.write_clustered(df, f"{tmp}/{name}", ["a", "b"], files=3, bits=3)
        assert as_set(clustered.read_clustered(spark, f"{tmp}/{name}", ["a", "b"], {}).rows) == sorted(rows, key=str)
        assert as_set(clustered.read_clustered(spark, f"{tmp}/{name}", ["a", "b"], {"b": (2, 2)}).rows) == [r for r in rows if r[1] == 2]


# --- stream-stream join --------------------------------------------------------------------------


def test_time_join_by_increment_equals_the_batch_join(spark, tmp):
    rng = random.Random(5)
    steps = [(i, rng.randrange(1, 300) * 1000) for i in range(200)] + [(900, None)]
    readings = [(rng.randrange(1, 300) * 1000, i) for i in range(200)] + [(None, 901), (steps[0][1], 902), (steps[0][1], 903)]
    s, r = spark.createDataFrame(steps, "sn long, t long"), spark.createDataFrame(readings, "t long, x long")
    expected = as_set(s.join(r.withColumnRenamed("t", "rt"), F.col("t") == F.col("rt"), "left").select("sn", "t", "x"))
    # Three chunks by time; a tenth of the rows comes a chunk late.
    chunk = lambda df, key: F.least(F.lit(2), F.coalesce(F.expr("t div 100000"), F.lit(0)) + (F.col(key) % 10 == 0).cast("int"))
    args = dict(step_time="t", reading_time="t", step_cols=["sn", "t"], reading_cols=["x"], delay="250 seconds")
    run = lambda: run_time_join(spark, tmp + "/s", s.schema, tmp + "/r", r.schema, tmp + "/out", tmp + "/ck", **args)
    for c in range(3):
        s.filter(chunk(s, "sn") == c).write.mode("append").parquet(tmp + "/s")
        r.filter(chunk(r, "x") == c).write.mode("append").parquet(tmp + "/r")
        run()
        assert spark.read.parquet(tmp + "/out").filter("x is null and sn <> 900").count() <= len(expected)
    run()  # nothing new
    for path, schema in ((tmp + "/s", s.schema), (tmp + "/r", r.schema)):
        close_landing(spark, path, schema, "t", 10_000_000)
    last = run()
    assert as_set(spark.read.parquet(tmp + "/out").select("sn", "t", "x")) == expected
    assert last[-1]["state_rows"] <= 4  # only the closing rows are left
    spark.createDataFrame([(1, 5000)], s.schema).write.mode("append").parquet(tmp + "/s")
    with pytest.raises(DataQualityError, match="later than the delay"):
        run()


def test_a_run_computes_its_fact_once(spark, tmp, monkeypatch):
    from wharf.plans import star_refresh
    from wharf.sinks.keyed_table import KeyedTable

    read, insert = {}, KeyedTable.insert_new

    def watched(self, batch, tag=None):
        read[self.path.rsplit("/", 1)[-1]] = batch.inputFiles()
        return insert(self, batch, tag)

    monkeypatch.setattr(KeyedTable, "insert_new", watched)
    events = spark.createDataFrame([("purchase", 1, 5, "S", "A", 1.0, "f", "l", "g", "free", "x", "ua")],
                                   "page string, ts long, userId long, song string, artist string, length double, firstName string,"
                                   " lastName string, gender string, level string, location string, userAgent string")
    songs = spark.createDataFrame([("s1", "S", "ar", "A", 1.0, 2000, "loc", 0.0, 0.0)],
                                  "song_id string, title string, artist_id string, artist_name string, duration double, year int,"
                                  " artist_location string, artist_latitude double, artist_longitude double")
    star_refresh.refresh_v2(spark, events.withColumn("sessionId", events["userId"]), songs, tmp + "/star", "one", play_page="purchase")
    # Both tables are filled from the written fact; a plan over the staging rows would have no input files here.
    assert read["songplays"] and read["songplays"] == read["time"]
    assert [r["song_id"] for r in star_refresh.read_v2(spark, tmp + "/star", "songplays").collect()] == ["s1"]
