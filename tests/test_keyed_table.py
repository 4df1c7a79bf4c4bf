"""Keyed tables by increment: upserts that touch few files, keyed streams, the star by runs, checks by loads."""

import os
import random

import pytest
from pyspark.sql import functions as F

from wharf.operators import quality_state
from wharf.operators.quality import DataQualityError, TableChecks, run_suite
from wharf.operators.upsert import last_write_wins
from wharf.sinks.commits import CommitConflict
from wharf.sinks.keyed_table import KeyedTable, Layout
from wharf.streaming.keyed import keyed_append_writer, run_keyed_stream

SCHEMA = "a long, b string, at long, v string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def files_of(table):
    """{file: time of change} of the live files."""
    out = {}
    for r in table.files().collect():
        p = r["file"].removeprefix("file://").removeprefix("file:")
        out[r["file"]] = os.stat(p).st_mtime_ns
    return out


def as_set(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def table(spark, tmp):
    return KeyedTable(spark, tmp + "/t", ["a", "b"], frame(spark, []).schema, Layout(slots=8, bitmaps=1))


def test_upserts_equal_last_write_wins_and_touch_few_files(spark, table):
    rng = random.Random(1)
    first = [(k, f"b{k % 3}", 1, "x") for k in range(400)] + [(None, "n", 1, "null key"), (None, None, 1, "nulls")]
    # Repeats in the batch, an older write, new keys, a NULL key.
    second = [(7, "b1", 5, "new"), (7, "b1", 4, "older"), (8, "b2", 0, "late"), (9001, "b", 1, "added"), (None, "n", 2, "again")]
    third = [(rng.randrange(500), f"b{rng.randrange(3)}", rng.randrange(3, 9), f"v{i}") for i in range(60)]
    seen = []
    for n, batch in enumerate((first, second, third)):
        before = files_of(table)
        done = table.upsert(frame(spark, batch), ["at", "v"])
        seen += batch
        expected = last_write_wins(frame(spark, seen), ["a", "b"], ["at", "v"]).select("a", "b", "at", "v")
        assert as_set(table.read()) == as_set(expected)
        after = files_of(table)
        kept = before.keys() & after.keys()
        assert all(before[f] == after[f] for f in kept)
        assert len(before) - len(kept) == done.files_replaced == done.files_read
        if n == 1:
            assert 0 < done.files_replaced < len(before) and done.rows_new == 1 and done.rows_in == 4
    assert table.row_count() == table.read().count()


def test_new_keys_alone_replace_no_file(spark, table):
    table.upsert(frame(spark, [(k, "b", 1, "x") for k in range(200)]), ["at"])
    before = files_of(table)
    done = table.upsert(frame(spark, [(10_000, "b", 1, "y")]), ["at"])
    # With 4 hashes and 32,768 bits for 25 keys a file the filter says no.
    assert done.files_replaced == 0 and before.items() <= files_of(table).items()


def test_a_tagged_batch_is_applied_once(spark, table):
    rows = [(1, "b", 1, "x"), (2, "b", 1, "x")]
    first = table.upsert(frame(spark, rows), ["at"], tag="2024-01-01")
    assert table.upsert(frame(spark, [(1, "b", 9, "z")]), ["at"], tag="2024-01-01") == first
    assert as_set(table.read()) == rows and table.versions() == [0]


def test_old_versions_stay_and_a_second_writer_fails(spark, table, tmp):
    table.upsert(frame(spark, [(1, "b", 1, "x")]), ["at"])
    other = KeyedTable.open(spark, table.path)
    assert other.keys == ["a", "b"] and other.layout == table.layout
    table.upsert(frame(spark, [(1, "b", 2, "y")]), ["at"])
    assert as_set(table.read(0)) == [(1, "b", 1, "x")] and as_set(other.read()) == [(1, "b", 2, "y")]
    late = other.versions()
    other.versions = lambda: late[:-1]  # as a writer that began before version 1
    with pytest.raises(CommitConflict):
        other.upsert(frame(spark, [(1, "b", 3, "z")]), ["at"])
    assert as_set(table.read()) == [(1, "b", 2, "y")]


def test_insert_new_keeps_stored_rows(spark, table):
    table.insert_new(frame(spark, [(k, "b", 1, "x") for k in range(50)]))
    done = table.insert_new(frame(spark, [(3, "b", 2, "y"), (77, "b", 2, "z"), (77, "b", 1, "a"), (None, "b", 1, "n")]))
    assert done.rows_new == 2 and done.files_replaced == 0
    got = as_set(table.read())
    assert (3, "b", 1, "x") in got and (77, "b", 1, "a") in got and (None, "b", 1, "n") in got and len(got) == 52
    assert table.insert_new(frame(spark, [(None, "b", 5, "n")])).rows_new == 0


def test_full_slots_are_merged(spark, tmp):
    t = KeyedTable(spark, tmp + "/t", ["a"], frame(spark, []).schema, Layout(slots=2, bitmaps=1, max_files=3))
    for k in range(8):
        t.insert_new(frame(spark, [(100 * k + j, "b", k, "x") for j in range(20)]))
    assert t.row_count() == 160 and t.read().select("a").distinct().count() == 160
    assert t.files().groupBy("slot").count().agg(F.max("count")).first()[0] <= 4


def test_the_index_is_that_of_all_rows_without_sorting_them(spark, tmp):
    t = KeyedTable(spark, tmp + "/t", ["b", "a"], frame(spark, []).schema, Layout(slots=2, bitmaps=2, hashes=3))
    keys = [(k, f"b{k % 7}") for k in range(-3000, 3000)] + [(None, "n"), (5, None), (None, None)]
    t.upsert(frame(spark, [(*k, 1, "x") for k in keys]), ["at"])
    generation = t.files().first()["generation"]
    data = (spark.read.schema(t.schema).option("basePath", t.path + "/data").parquet(f"{t.path}/data/_g={generation}"))
    at = F.col("_metadata.file_path").alias("file")
    key = F.struct(F.col("b").alias("k0"), F.col("a").alias("k1"))
    ranges = data.groupBy(at).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("rows"),
                                  F.first("_slot").cast("long").alias("slot"))
    bits = (data.select(at, F.explode(t._places()).alias("place")).groupBy("file", F.bitmap_bucket_number("place").alias("bitmap"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")))
    shown = ["file", "bitmap", F.hex("bits"), "lo", "hi", "rows", "slot"]
    assert as_set(t._index_of(data).select(*shown)) == as_set(bits.join(ranges, "file").select(*shown))
    # An aggregate with a binary buffer would sort a row for each bit of each key.
    assert "bitmap_construct_agg" not in t._index_of(data)._jdf.queryExecution().toString()
    live = t._live()
    for k in random.Random(3).sample(keys, 5) + [(None, "n"), (5, None), (None, None)]:
        assert as_set(t.lookup(a=k[0], b=k[1]))[0][:2] == k
    assert t._candidates(frame(spark, [(9, "b3", 0, "")]), live) == []


def test_empty_batches_and_empty_tables(spark, table):
    done = table.upsert(frame(spark, []), ["at"])
    assert done.files_written == 0 and table.read().count() == 0 and table.row_count() == 0
    assert table.insert_new(frame(spark, [(1, "b", 1, "x")])).rows_new == 1
    assert table.insert_new(frame(spark, [])).rows_new == 0 and table.read().count() == 1


def test_slots_by_key_range_keep_a_batch_of_neighbours_together(spark, tmp):
    t = KeyedTable(spark, tmp + "/t", ["a", "b"], frame(spark, []).schema, Layout(slots=1, width=100))
    t.upsert(frame(spark, [(k, "b", 1, "x") for k in range(-50, 1000)]), ["at"])
    before = files_of(t)
    done = t.upsert(frame(spark, [(k, "b", 2, "y") for k in range(930, 1020)]), ["at"])
    assert done.files_before == len(before) == 11 and done.files_replaced == 1 and done.rows_new == 20
    assert len(before.items() & files_of(t).items()) == 10
    assert t.read().filter("v = 'y'").count() == 90 and t.row_count() == 1070


def test_lookup_reads_the_files_of_the_key(spark, table):
    table.upsert(frame(spark, [(k, "b", 1, "x") for k in range(200)]), ["at"])
    assert as_set(table.lookup(a=5, b="b")) == [(5, "b", 1, "x")]
    assert table.lookup(a=5, b="c").count() == 0
    assert len(table.lookup(a=5, b="b").inputFiles()) == 1


# --- keyed streams -------------------------------------------------------------------


def test_keyed_stream_does_not_read_its_target(spark, tmp):
    land, target, ck = tmp + "/land", tmp + "/fact", tmp + "/ck"
    schema = "k long, at timestamp, v string"
    rows = spark.createDataFrame([(i, None, "x") for i in range(20)] + [(None, None, "p"), (None, None, "p"), (None, None, "q")], schema)
    rows.write.mode("append").parquet(land)
    first = run_keyed_stream(spark, land, rows.schema, target, "k", ck)
    assert sorted(spark.read.parquet(target).select("k").toPandas()["k"].dropna()) == list(range(20))
    assert spark.read.parquet(target).filter("k is null").count() == 2
    assert first[-1]["known_keys"] == 22
    # The target's files are taken away: a run that looked at them could not go on.
    parts = [os.path.join(target, f) for f in os.listdir(target) if f.startswith("part-")]
    held = {p: open(p, "rb").read() for p in parts}
    for p in parts:
        open(p, "wb").close()
    rows.write.mode("append").parquet(land)  # everything again
    spark.createDataFrame([(3, None, "other"), (50, None, "new"), (50, None, "new")], schema).write.mode("append").parquet(land)
    second = run_keyed_stream(spark, land, rows.schema, target, "k", ck)
    for p, content in held.items():
        with open(p, "wb") as f:
            f.write(content)
    got = spark.read.parquet(target)
    assert got.count() == 23 and got.filter("k = 3").first()["v"] == "x" and got.filter("k = 50").count() == 1
    assert second[-1]["known_keys"] == 23
    # Nothing new: nothing is added.
    run_keyed_stream(spark, land, rows.schema, target, "k", ck)
    assert spark.read.parquet(target).count() == 23


def test_keyed_stream_survives_a_batch_that_failed(spark, tmp):
    land, target, ck = tmp + "/land", tmp + "/fact", tmp + "/ck"
    schema = spark.createDataFrame([], "k long, v string").schema
    spark.createDataFrame([(i, "x") for i in range(9)], schema).write.parquet(land)
    broken = lambda df: df.withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        run_keyed_stream(spark, land, schema, target, "k", ck, transform=broken)
    run_keyed_stream(spark, land, schema, target, "k", ck)
    assert spark.read.parquet(target).count() == 9


def test_keyed_stream_with_a_horizon(spark, tmp):
    land, target, ck = tmp + "/land", tmp + "/fact", tmp + "/ck"
    df = spark.sql("SELECT id AS k, timestamp'2024-01-10 00:00:00' + make_interval(0,0,0,0,id,0,0) AS at FROM range(5)")
    df.write.mode("append").parquet(land)
    options = {"event_time": "at", "horizon": "1 day"}
    run_keyed_stream(spark, land, df.schema, target, "k", ck, **options)
    df.write.mode("append").parquet(land)
    run_keyed_stream(spark, land, df.schema, target, "k", ck, **options)
    assert spark.read.parquet(target).count() == 5
    spark.sql("SELECT 99L AS k, timestamp'2023-01-01 00:00:00' AS at").write.mode("append").parquet(land)
    with pytest.raises(DataQualityError, match="older than the horizon"):
        run_keyed_stream(spark, land, df.schema, target, "k", ck, **options)


def test_plan_of_the_keyed_stream_has_state_and_no_join(spark, tmp):
    land = tmp + "/land"
    df = spark.createDataFrame([(1, "x")], "k long, v string")
    df.write.parquet(land)
    query = keyed_append_writer(spark, land, df.schema, "k", tmp + "/ck").start(tmp + "/fact")
    query.awaitTermination()
    plan = query._jsq.explainInternal(True)
    assert "StreamingDeduplicate" in plan and "Join" not in plan


# --- checks by load --------------------------------------------------------------------


def test_checks_by_load_equal_the_suite(spark, tmp):
    spec = TableChecks("t", key="k", not_null=("v",))
    loads = {"d1": [(i, "x") for i in range(30)] + [(None, None)], "d2": [(5, "x"), (5, None), (100, "x")],
             "d3": [(100, "y"), (101, "y")], "d4": []}
    seen = []
    for load, rows in loads.items():
        df = spark.createDataFrame(rows, "k long, v string")
        quality_state.add_load(spark, tmp + "/s", load, {"t": df}, [spec])
        quality_state.add_load(spark, tmp + "/s", load, {"t": df}, [spec])  # repeated
        seen += rows
        expected = run_suite({"t": spark.createDataFrame(seen, "k long, v string")}, [spec])
        assert as_set(quality_state.report(spark, tmp + "/s", [spec])) == as_set(expected)
    assert ("t: repeats of k", 3, False) in as_set(quality_state.report(spark, tmp + "/s", [spec]))
