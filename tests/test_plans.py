"""Plan assertions: pushdown, pruning, group limits, semi joins, bucketed joins."""

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    q = E.queries()["ssb_one_dim"](spark, SF_SMALL)
    plan = physical(q)
    assert "PushedFilters: [IsNotNull(l_discount), IsNotNull(l_quantity), GreaterThanOrEqual(l_discount,0.01)" in plan
    # Only the columns the query needs are read from lineitem.
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double,l_discount:double>" in plan


def test_comma_join_becomes_equi_join(spark):
    q = E.queries()["ssb_two_dim"](spark, SF_SMALL)
    plan = physical(q)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_top_n_per_group_uses_window_group_limit(spark):
    q = E.queries()["top3_per_group"](spark, SF_SMALL)
    plan = executed(q)
    assert "WindowGroupLimit" in plan


def test_top_k_is_take_ordered(spark):
    q = E.queries()["top10_filtered"](spark, SF_SMALL)
    assert "TakeOrderedAndProject" in physical(q)


def test_existence_join_is_semi(spark):
    q = E.queries()["existence_curated"](spark, SF_SMALL)
    assert "LeftSemi" in optimized(q)


def test_bucketed_join_has_no_shuffle(spark):
    q = E.queries()["bucketed_join"](spark, SF_SMALL)
    plan = executed(q)
    assert "SortMergeJoin" in plan or "BroadcastHashJoin" in plan
    if "SortMergeJoin" in plan:
        assert "Exchange hashpartitioning" not in plan


def test_upsert_aggregates_map_side(spark):
    q = E.queries()["upsert_last_wins"](spark, SF_SMALL)
    assert "partial_max" in physical(q)


def test_no_python_udf_in_registered_plans(spark):
    for name in ("songplay_v2", "time_dim_v1", "dq_suite", "ssb_drill", "left_join_time"):
        plan = physical(E.queries()[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_hot_key_join_is_split_by_aqe(spark):
    # One key holds a third of the rows: AQE splits that partition of the
    # sort-merge join instead of running it in one task.
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 300_000
        fact = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).alias("k"),
            F.col("id").alias("v"))
        dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"))
        out = fact.join(dim, "k").groupBy("g").agg(F.count(F.lit(1)).alias("n"))
        assert sum(r["n"] for r in out.collect()) == n
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_no_registered_query_has_nested_loops_or_python(spark):
    bad = {}
    for name, fn in E.queries().items():
        if name in E.LLM_QUERIES:
            continue
        plan = physical(fn(spark, SF_SMALL))
        hits = [p for p in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
                            "ArrowEvalPython") if p in plan]
        if hits:
            bad[name] = hits
    assert bad == {}


def test_plays_are_counted_before_the_dimension_joins(spark):
    plan = optimized(E.queries()["v1_top_songs_by_gender"](spark, SF_SMALL))
    # From the root down: the sum of counts, the joins with the dimensions, the count by the fact's keys.
    first_join, count = plan.index("Join"), plan.index("count(1) AS plays")
    assert plan.index("sum(plays") < first_join < count


def test_v1_star_stays_linear(spark):
    small, large = (E.queries()["songplay_v1"](spark, d).count() for d in (SF_SMALL, "/root/testdata/sf0.01"))
    assert large < 15 * small


def test_buckets_grow_in_number_with_the_rows(spark, monkeypatch):
    from wharf import registry

    monkeypatch.setattr(registry, "BUCKET_ROWS", 1000)
    fixed = registry._parts(spark)
    assert registry._buckets(spark, spark.range(10), spark.range(0)) == fixed
    assert registry._buckets(spark, spark.range(50_001), spark.range(7)) == 51 > fixed
