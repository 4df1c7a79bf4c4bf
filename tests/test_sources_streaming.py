"""Sources (SRC-*), sinks (SNK-*) and incremental runs (STR-*)."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from wharf.sinks import writers
from wharf.sources import files
from wharf.streaming.incremental import run_incremental, run_keyed_append


def test_dated_prefix_month_not_padded():
    assert files.dated_prefix("log_data", dt.date(2018, 11, 5)) == "log_data/2018/11/"
    assert files.dated_prefix("log_data/", dt.date(2019, 3, 1)) == "log_data/2019/3/"


def test_json_paths_positional_and_nested(spark, tmp):
    os.makedirs(tmp + "/j")
    with open(tmp + "/j/a.json", "w") as f:
        f.write('{"artist": "A", "song": {"title": "T"}, "length": 1.5}\n')
        f.write('{"artist": null, "length": 2}\n')
    flat = files.read_json_paths(spark, tmp + "/j", [("a", "$.artist", "string"),
                                                     ("l", "$.length", "double")])
    assert [tuple(r) for r in flat.collect()] == [("A", 1.5), (None, 2.0)]
    nested = files.read_json_paths(spark, tmp + "/j", [("t", "$.song.title", "string")])
    assert [r[0] for r in nested.collect()] == ["T", None]


def test_json_schema_is_case_sensitive_then_renamed(spark, tmp):
    # T-3: give the schema in the file's case, rename afterwards.
    os.makedirs(tmp + "/s")
    with open(tmp + "/s/a.json", "w") as f:
        f.write('{"serialNumber": "x1", "sensorReadingTime": 5}\n')
    df = files.read_json(spark, tmp + "/s", "serialNumber string, sensorReadingTime bigint",
                         rename={"serialNumber": "serialnumber"})
    assert df.columns == ["serialnumber", "sensorReadingTime"]
    assert df.first()[0] == "x1"


def test_pipe_rows_with_trailing_delimiter(spark, tmp):
    # SRC-7: SSB rows end with '|'; gzip, default delimiter pipe.
    os.makedirs(tmp + "/ssb")
    with gzip.open(tmp + "/ssb/part.tbl.gz", "wt") as f:
        f.write("1|lace spring|MFGR#1|\n2|blush thistle|MFGR#4|\n")
    df = files.read_delimited(spark, tmp + "/ssb", "p_partkey int, p_name string, p_mfgr string",
                              sep="|", trailing_sep=files.ends_with_separator(spark, tmp + "/ssb", "|"))
    assert [tuple(r) for r in df.orderBy("p_partkey").collect()] == [
        (1, "lace spring", "MFGR#1"), (2, "blush thistle", "MFGR#4")]
    report = files.load_tables(spark, {"ssb_part_t": (tmp + "/ssb", df.schema)}, sep="|")
    assert report.count() == 1 and spark.table("ssb_part_t").count() == 2


def test_malformed_rows_fail_or_are_counted(spark, tmp):
    os.makedirs(tmp + "/bad")
    with open(tmp + "/bad/a.csv", "w") as f:
        f.write("1,x\nnone,y\n3\n")
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_delimited(spark, tmp + "/bad", "k int, v string").collect()
    assert tuple(files.malformed(spark, tmp + "/bad", "k int, v string").first()) == (3, 2)


def test_keyed_append_rule(spark, tmp):
    # The smallest row of a key wins inside a batch; the target's row wins later; NULL keys go by the whole row.
    schema = "k int, v string"
    first = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n"), (None, "n"), (None, None)], schema)
    second = spark.createDataFrame([(1, "0"), (2, "c"), (None, "n"), (None, "m")], schema)
    for batch in (first, second, second):
        writers.append_new(batch, tmp + "/t", key="k")
    got = sorted((tuple(r) for r in spark.read.parquet(tmp + "/t").collect()), key=repr)
    assert got == sorted([(1, "a"), (2, "c"), (None, "n"), (None, "m"), (None, None)], key=repr)


def test_gzip_parts_read_one_task_per_file(spark, tmp):
    # SRC-5 / SRC-6: gzip is not splittable; 4 parts → 4 partitions, 1 file → 1.
    df = spark.range(4000).select(F.col("id"), (F.col("id") * 2).alias("v"))
    df.repartition(4).write.option("sep", ";").option("compression", "gzip").csv(tmp + "/split")
    df.coalesce(1).write.option("sep", ";").option("compression", "gzip").csv(tmp + "/single")
    split = files.read_delimited(spark, tmp + "/split/part*", "id long, v long", sep=";")
    single = files.read_delimited(spark, tmp + "/single/part*", "id long, v long", sep=";")
    assert split.rdd.getNumPartitions() == 4
    assert single.rdd.getNumPartitions() == 1
    assert files.read_delimited(spark, tmp + "/single/part*", "id long, v long", sep=";",
                                repartition=4).rdd.getNumPartitions() == 4
    assert split.count() == single.count() == 4000


def test_file_listing_and_sql_over(spark, tmp):
    spark.range(10).write.parquet(tmp + "/p")
    listing = files.list_files(spark, tmp + "/p", glob="*.parquet")
    assert listing.count() >= 1 and set(listing.columns) == {"path", "length"}
    got = files.sql_over(spark, "SELECT COUNT(*) AS n FROM myDataSource",
                         {"myDataSource": spark.range(7)})
    assert got.first()["n"] == 7


def test_ddl_namespace_truncate_drop(spark, tmp):
    writers.use_namespace(spark, "wh_test_db")
    writers.create_table(spark, "t_b", "k int, v string", bucket_by=["k"], buckets=4,
                         sort_by=["k"], path=tmp + "/tb")
    spark.sql("INSERT INTO t_b VALUES (1, 'a'), (2, 'b')")
    assert spark.table("t_b").count() == 2
    writers.truncate_table(spark, "t_b")
    assert spark.table("t_b").count() == 0
    writers.drop_tables(spark, ["t_b", "never_existed"])
    spark.sql("USE default")
    assert not spark.catalog.tableExists("wh_test_db.t_b")


def test_incremental_run_reads_only_new_files(spark, tmp):
    # STR-1: first run loads batch 1, a rerun adds nothing, batch 2 adds its rows.
    schema = "id long, v string"
    b1 = spark.createDataFrame([(i, "a") for i in range(5)], schema)
    b2 = spark.createDataFrame([(i, "b") for i in range(5, 8)], schema)
    land, sink, ck = tmp + "/land", tmp + "/sink", tmp + "/ck"
    b1.write.mode("append").parquet(land)
    run_incremental(spark, land, b1.schema, sink, ck)
    assert spark.read.parquet(sink).count() == 5
    run_incremental(spark, land, b1.schema, sink, ck)
    assert spark.read.parquet(sink).count() == 5
    b2.write.mode("append").parquet(land)
    run_incremental(spark, land, b1.schema, sink, ck)
    assert spark.read.parquet(sink).count() == 8


def test_keyed_append_survives_a_replay(spark, tmp):
    # STR-2: a lost checkpoint replays every file; the key anti-join keeps the target whole.
    df = spark.createDataFrame([(i, "x") for i in range(6)], "k long, v string")
    df.write.parquet(tmp + "/land")
    run_keyed_append(spark, tmp + "/land", df.schema, tmp + "/fact", "k", tmp + "/ck1")
    run_keyed_append(spark, tmp + "/land", df.schema, tmp + "/fact", "k", tmp + "/ck2")
    assert spark.read.parquet(tmp + "/fact").count() == 6


def test_append_new_partitioned_probes_touched_partitions(spark, tmp):
    # T-11 at scale: the rerun check reads only the partitions the batch touches.
    first = spark.createDataFrame([("a", "2018-11-01"), ("b", "2018-11-02")], "id string, day string")
    writers.append_new(first, tmp + "/fact", key="id", partition_by=["day"])
    batch = spark.createDataFrame([("b", "2018-11-02"), ("c", "2018-11-02")], "id string, day string")
    writers.append_new(batch, tmp + "/fact", key="id", partition_by=["day"])
    got = sorted((r["id"], str(r["day"])) for r in spark.read.parquet(tmp + "/fact").collect())
    assert got == [("a", "2018-11-01"), ("b", "2018-11-02"), ("c", "2018-11-02")]


def test_month_layout_prunes_partitions(spark, tmp):
    df = spark.createDataFrame([(1, 1541121934796), (2, 1543622400000), (3, 1546300800000)],
                               "id int, ts long")  # 2018-11-02, 2018-12-01, 2019-01-01
    writers.write_by_month(df, tmp + "/staging")
    got = files.read_month(spark, tmp + "/staging", dt.date(2018, 12, 5))
    assert [r["id"] for r in got.collect()] == [2]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(month" in plan


def test_analyze_tables_enables_cbo(spark, tmp):
    from wharf.session import analyze_tables
    spark.range(100).write.mode("overwrite").option("path", tmp + "/a").saveAsTable("cbo_a")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.cbo.enabled",
                                                 "spark.sql.cbo.joinReorder.enabled")}
    try:
        analyze_tables(spark, ["cbo_a"])
        stats = spark.sql("DESCRIBE TABLE EXTENDED cbo_a").filter("col_name = 'Statistics'").first()
        assert "100 rows" in stats["data_type"]
        assert spark.conf.get("spark.sql.cbo.enabled") == "true"
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_incremental_run_on_json_landing(spark, tmp):
    # STR-1 on JSON lines with the declared landing schema (camelCase keys).
    from wharf import schemas
    land, sink, ck = tmp + "/landing", tmp + "/trusted", tmp + "/ck"
    os.makedirs(land)
    with open(land + "/a.json", "w") as f:
        f.write('{"sensorReadingTime": 1, "serialNumber": "s1", "distanceFromObject": 3}\n')
    schema = schemas.struct(schemas.STEP_TRAINER_LANDING)
    run_incremental(spark, land, schema, sink, ck, fmt="json")
    run_incremental(spark, land, schema, sink, ck, fmt="json")
    assert spark.read.parquet(sink).count() == 1
    with open(land + "/b.json", "w") as f:
        f.write('{"sensorReadingTime": 2, "serialNumber": "s2", "distanceFromObject": 4}\n')
    run_incremental(spark, land, schema, sink, ck, fmt="json")
    got = sorted(r["serialNumber"] for r in spark.read.parquet(sink).collect())
    assert got == ["s1", "s2"]


def test_stage_into_a_catalog_table(spark, tmp):
    # SRC-3: create, truncate, copy — a rerun replaces the table's rows.
    os.makedirs(tmp + "/log/2018/11")
    with open(tmp + "/log/2018/11/a.json", "w") as f:
        f.write('{"page": "NextSong", "ts": 1}\n{"page": "Home", "ts": 2}\n')
    for _ in range(2):
        got = files.stage(spark, tmp + "/log", tmp + "/staging_events", schema="page string, ts bigint",
                          run_date=dt.date(2018, 11, 5), table="staging_events_t")
    assert got.count() == 2 and spark.table("staging_events_t").count() == 2
