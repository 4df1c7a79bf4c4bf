"""Remaining inventory items: SRC-10/12/15, PRJ-1, DQ-13, PL-14, PL-15."""

import os

from pyspark.sql import functions as F

from wharf.operators.projections import project_map, with_derived_first
from wharf.operators.quality import csv_line_count
from wharf.plans import layout
from wharf.sinks.writers import quoted_csv
from wharf.sources import files


def test_external_json_table_and_generic_reader(spark, tmp):
    os.makedirs(tmp + "/acc")
    with open(tmp + "/acc/a.json", "w") as f:
        f.write('{"user": "a@x", "timestamp": 5, "x": 1.5, "y": 0.0, "z": -1.0}\n')
    schema = spark.createDataFrame([], "user string, timestamp bigint, x double, y double, z double").schema
    files.create_external_json_table(spark, "accelerometer_landing_t", schema, tmp + "/acc")
    got = files.read_catalog(spark, None, "accelerometer_landing_t")
    assert [tuple(r) for r in got.collect()] == [("a@x", 5, 1.5, 0.0, -1.0)]
    assert files.read_table(spark, tmp + "/acc", "json").count() == 1


def test_inferred_csv_and_line_count(spark, tmp):
    df = spark.createDataFrame([(1, "a, b", 2.5), (2, None, 3.0)], "id int, s string, v double")
    quoted_csv(df, tmp + "/q", files=1)
    inferred = files.read_csv_inferred(spark, tmp + "/q")
    assert dict(inferred.dtypes) == {"id": "int", "s": "string", "v": "double"}
    counts = csv_line_count(spark, tmp + "/q").first()
    assert (counts["lines"], counts["rows"], counts["files"]) == (3, 2, 1)


def test_project_map_and_derived_first(spark):
    df = spark.createDataFrame([(1541121934796, 3)], "ts bigint, n int")
    out = project_map(df, {"start_time": "timestamp_seconds(ts div 1000)", "twice": F.col("n") * 2})
    assert out.columns == ["start_time", "twice"] and out.first()["twice"] == 6
    assert with_derived_first(df, "k", F.lit(1)).columns == ["k", "ts", "n"]


def test_layout_comparison_reports_every_query(spark, tmp):
    fact = spark.range(0, 20000).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    dim = spark.range(0, 100).select(F.col("id").alias("k"), (F.col("id") % 5).alias("g"))
    plain_paths = layout.write_plain({"fact": fact, "dim": dim}, tmp)
    plain = {n: spark.read.parquet(p) for n, p in plain_paths.items()}
    names = layout.write_bucketed({"fact": fact, "dim": dim}, {"fact": "k", "dim": "k"}, 4, tmp,
                                  "lay")
    bucketed = {n: spark.table(t) for n, t in names.items()}

    def q(t):
        return t["fact"].join(t["dim"], "k").groupBy("g").agg(F.sum("v").alias("s"))

    report = layout.compare_layouts(spark, {"join_agg": q}, plain, bucketed, repeats=1, warmup=0)
    row = report.first()
    assert row["query"] == "join_agg" and row["time_plain"] > 0 and row["time_bucketed"] > 0
    joined = q(bucketed)
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == 0


def test_split_against_single_file_load(spark, tmp):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 7).alias("v"))
    report = {r["layout"]: r for r in
              layout.split_vs_single(spark, df, tmp, "id long, v long", parts=4).collect()}
    assert report["split"]["input_partitions"] == 4
    assert report["single"]["input_partitions"] == 1


def test_verify_table_and_clustered_layout(spark):
    from wharf.operators.quality import verify_table
    from wharf.plans.serving import clustered_layout
    df = spark.createDataFrame([(2, 3, "c"), (1, 2, "b"), (2, 1, "a"), (1, 1, "z")],
                               "user int, item int, song string")
    n, first = verify_table(df)
    assert n == 4 and len(first) == 1
    laid = clustered_layout(df, ["user"], ["item"])
    parts = laid.rdd.glom().map(lambda rows: [(r.user, r.item) for r in rows]).collect()
    for p in parts:  # each partition holds whole users, in clustering order
        assert p == sorted(p)
    users = [{u for u, _ in p} for p in parts if p]
    assert sum(len(u) for u in users) == len(set().union(*users)) == 2
