"""Joins, aggregates, windows, upsert, surrogate keys, sampling and checks."""

import pytest
from pyspark.sql import functions as F

from wharf.operators import quality as Q
from wharf.operators.joins import broadcast_if_small, existence_join, right_join_distinct
from wharf.operators.sampling import SampleError, check_allowed, sample_exact
from wharf.operators.surrogate import dense_ids, unique_ids
from wharf.operators.upsert import last_write_wins, merge_last_write_wins
from wharf.operators.windows import order_spec, top_n_per_group
from wharf.sinks.writers import append_record


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_broadcast_only_under_the_bound(spark):
    small = spark.range(10)
    big = spark.range(1000)
    j1 = spark.range(100).join(broadcast_if_small(small, 50), "id")
    j2 = spark.range(100).join(broadcast_if_small(big, 50), "id")
    assert "ResolvedHint (strategy=broadcast)" in j1._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in j2._jdf.queryExecution().analyzed().toString()


def test_existence_join_equals_inner_drop_dedupe_with_hot_key(spark):
    # JN-5: one customer holds most readings; a customer listed twice.
    cust = spark.createDataFrame(
        [("a@x", "Ann"), ("a@x", "Ann"), ("b@x", "Bo"), ("c@x", "Cy")], "email string, name string")
    reads = spark.createDataFrame([("a@x", i) for i in range(300)] + [("b@x", 1), ("z@x", 2)],
                                  "user string, ts long")
    got = existence_join(cust, reads, ["email"], ["user"])
    ref = cust.join(reads, cust.email == reads.user).drop("user", "ts").dropDuplicates()
    assert rows(got) == rows(ref) == [("a@x", "Ann"), ("b@x", "Bo")]
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()


def test_right_join_distinct_keeps_one_null_row(spark):
    # JN-6 / T-13: curated customers without readings collapse into one NULL row.
    land = spark.createDataFrame([("s1", 1, 5), ("s1", 1, 5), ("s2", 2, 7), ("s9", 3, 1)],
                                 "serialNumber string, t long, d int")
    cur = spark.createDataFrame([("s1",), ("s2",), ("s3",), ("s4",)], "serialNumber string")
    got = right_join_distinct(land, cur, ["serialNumber"], ["serialNumber"],
                              ["serialNumber", "t", "d"])
    land.createOrReplaceTempView("stl")
    cur.createOrReplaceTempView("cc")
    ref = spark.sql("SELECT DISTINCT stl.serialNumber, t, d FROM stl "
                    "RIGHT JOIN cc ON stl.serialNumber = cc.serialNumber")
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, ref.collect()), key=key)
    assert (None, None, None) in [tuple(r) for r in got.collect()]
    no_null = right_join_distinct(land, cur, ["serialNumber"], ["serialNumber"],
                                  ["serialNumber", "t", "d"], keep_null_row=False)
    assert rows(no_null) == [("s1", 1, 5), ("s2", 2, 7)]


def test_last_write_wins_one_row_per_key_latest_order(spark):
    # SNK-6 / T-17: a hot key with many versions; the greatest order wins.
    data = [(1, i, f"v{i}") for i in range(500)] + [(2, 5, "old"), (2, 9, "new"), (3, 1, "only")]
    df = spark.createDataFrame(data, "k int, seq int, val string").repartition(5)
    got = last_write_wins(df, ["k"], ["seq"])
    assert rows(got, "k", "seq", "val") == [(1, 499, "v499"), (2, 9, "new"), (3, 1, "only")]
    merged = merge_last_write_wins(got, spark.createDataFrame([(3, 2, "upd")], df.schema),
                                   ["k"], ["seq"])
    assert rows(merged, "k", "val") == [(1, "v499"), (2, "new"), (3, "upd")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan  # reduced map-side before the shuffle


def test_dense_ids_match_row_number(spark):
    df = spark.range(0, 3000, 3).withColumnRenamed("id", "nk").repartition(7)
    got = dense_ids(df, ["nk"], "sk")
    assert rows(got, "nk", "sk") == [(i * 3, i) for i in range(1000)]
    u = unique_ids(df, "uid").select("uid").distinct().count()
    assert u == 1000


def test_top_n_per_group_ties_and_group_limit(spark):
    df = spark.createDataFrame(
        [("F", "b", 3), ("F", "a", 3), ("F", "c", 1), ("M", "z", 9), ("M", "y", 2)],
        "g string, item string, n long")
    got = top_n_per_group(df, ["g"], order_spec(desc=["n"], asc=["item"]), 2)
    assert rows(got, "g", "item", "rank") == [("F", "a", 1), ("F", "b", 2), ("M", "y", 2),
                                             ("M", "z", 1)]
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_sample_exact(spark):
    df = spark.range(100)
    s = sample_exact(df, 10, seed=3)
    ids = [r[0] for r in s.collect()]
    assert len(ids) == 10 == len(set(ids))
    with pytest.raises(SampleError):
        sample_exact(spark.range(3), 5)
    with pytest.raises(SampleError):
        check_allowed(7, (5, 10, 20))


def test_quality_suite_and_comparisons(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    report = Q.run_suite({"t": t}, [Q.TableChecks("t", key="k")])
    got = {r["check"]: (r["actual"], r["passed"]) for r in report.collect()}
    assert got == {"t: rows": (3, True), "t: NULLs in k": (1, False), "t: repeats of k": (1, False)}
    t.createOrReplaceTempView("dq_t")
    ok = Q.sql_check_report(spark, [Q.SqlCheck("n", "SELECT COUNT(*) FROM dq_t", 0, ">")])
    Q.raise_on_failure(ok)
    bad = Q.sql_check_report(spark, [Q.SqlCheck("nulls", "SELECT COUNT(*) FROM dq_t WHERE k IS NULL",
                                                0, "==")])
    with pytest.raises(Q.DataQualityError, match="Result was 1"):
        Q.raise_on_failure(bad)
    empty = Q.sql_check_report(spark, [Q.SqlCheck("e", "SELECT k FROM dq_t WHERE k > 5", 0, "==")])
    with pytest.raises(Q.DataQualityError, match="no records"):
        Q.raise_on_failure(empty)
    with pytest.raises(Q.DataQualityError, match="Unsupported"):
        Q.sql_check_report(spark, [Q.SqlCheck("x", "SELECT 1", 0, "=~")])
    assert Q.compare(3, 2, ">=") and not Q.compare(3, 2, "<")


def test_profile_and_missing_values(spark):
    df = spark.createDataFrame([("a", None), ("b", 2)], "s string, n int")
    prof = {r["column_name"]: (r["data_type"], r["non_null"]) for r in Q.profile(df).collect()}
    assert prof == {"s": ("string", 2), "n": ("int", 1)}
    assert rows(Q.missing_values(df, "s", ["a", "q", "q"])) == [("q",)]
    with pytest.raises(Q.DataQualityError):
        Q.require_values(df, "s", ["zz"])


def test_append_record_schema_and_lists(spark):
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("question", T.StringType(), False),
        T.StructField("subject", T.StringType(), False),
        T.StructField("use", T.StringType(), False),
        T.StructField("responseC", T.StringType(), True),
    ])
    bank = spark.createDataFrame([("q1", "math", "test", None)], schema)
    out = append_record(bank, {"question": "q2", "subject": ["math", "art"], "use": "exam",
                               "extra": 1}, explode_lists=["subject"])
    assert rows(out, "question", "subject") == [("q1", "math"), ("q2", "art"), ("q2", "math")]
    with pytest.raises(Q.DataQualityError, match="required"):
        append_record(bank, {"question": "q3", "use": "exam"})
    with pytest.raises(Q.DataQualityError, match="empty"):
        append_record(bank, {"question": "q3", "subject": [], "use": "x"}, explode_lists=["subject"])


def test_column_count_rule_and_observation(spark, tmp):
    df = spark.range(5)
    Q.column_count_rule(df)
    with pytest.raises(Q.DataQualityError):
        Q.column_count_rule(df.select())
    obs_df, obs = Q.observed(df)
    obs_df.write.mode("overwrite").parquet(tmp + "/o")
    assert obs.get["rows"] == 5


def test_report_lines_one_status_per_check(spark):
    t = spark.createDataFrame([(1,), (1,)], "k int")
    lines = Q.report_lines(Q.run_suite({"t": t}, [Q.TableChecks("t", key="k")]))
    assert lines == ["PASSED: t: rows (value: 2)", "PASSED: t: NULLs in k (value: 0)",
                     "FAILED: t: repeats of k (value: 1)"]


def test_size_for_input_only_fills_unset_keys(spark, tmp):
    from wharf.session import input_bytes, size_for_input
    spark.range(1000).write.parquet(tmp + "/p")
    assert input_bytes(spark, [tmp + "/p"]) > 0
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        # One rule at every size: 128 MiB of input for each partition, no cap.
        assert size_for_input(spark, 100 * 1024 ** 4) == {key: "819200"}
        assert size_for_input(spark, 100 * 1024 ** 4) == {}  # already set: left alone
    finally:
        spark.conf.unset(key)


def test_preset_settings_are_kept(spark):
    from wharf.session import apply_runtime_defaults
    preset = {"spark.sql.session.timeZone": "Asia/Tokyo", "spark.sql.adaptive.skewJoin.enabled": "false"}
    old = {k: spark.conf.get(k) for k in preset}
    try:
        for k, v in preset.items():
            spark.conf.set(k, v)
        apply_runtime_defaults(spark)
        assert {k: spark.conf.get(k) for k in preset} == preset
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_scratch_folder_must_be_shared_off_a_local_master():
    from types import SimpleNamespace

    from wharf.session import checkpoint_dir
    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: {}, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=context))


def test_unseeded_draws_differ(spark):
    df = spark.range(1000)
    draws = {tuple(sorted(r[0] for r in sample_exact(df, 10).collect())) for _ in range(4)}
    assert len(draws) > 1
    assert (sorted(sample_exact(df, 10, seed=3).collect()) == sorted(sample_exact(df, 10, seed=3).collect()))


def test_negative_epoch_is_cut_towards_1970(spark):
    from pyspark.sql import functions as F

    from wharf.functions import exprs as X
    row = spark.range(1).select(*[f(F.lit(-1500)).cast("string") for f in (X.epoch_ms_to_timestamp, X.epoch_ms_to_timestamp_v2)]).first()
    assert set(row) == {"1969-12-31 23:59:59"}


def test_small_library_operators(spark):
    from wharf.operators.aggregates import count_all, distinct_rows, paid_wins
    from wharf.operators.joins import join_keys, star_join
    from wharf.operators.projections import drop_fields
    plays = spark.createDataFrame([(1, "S1", "free"), (1, "S1", "paid"), (2, "S2", "free")],
                                  "user_id int, song_id string, level string")
    users = spark.createDataFrame([(1, "Ann"), (2, "Bo")], "uid int, name string")
    songs = spark.createDataFrame([("S1", "T1"), ("S2", "T2")], "sid string, title string")
    assert count_all(plays).first()["count"] == 3                      # AGG-2
    assert distinct_rows(plays, ["user_id", "song_id"]).count() == 2   # AGG-10
    levels = {r["user_id"]: r["level"] for r in
              plays.groupBy("user_id").agg(paid_wins("level").alias("level")).collect()}
    assert levels == {1: "paid", 2: "free"}                             # AGG-5
    joined = join_keys(plays, users, ["user_id"], ["uid"])               # JN-4: both keys kept
    assert {"user_id", "uid"} <= set(joined.columns)
    wide = star_join(plays, [(users, "user_id", "uid"), (songs, "song_id", "sid")])  # JN-3
    assert sorted((r["name"], r["title"]) for r in wide.collect()) == [
        ("Ann", "T1"), ("Ann", "T1"), ("Bo", "T2")]
    assert drop_fields(wide, ["uid", "sid"]).columns == ["user_id", "song_id", "level", "name",
                                                         "title"]  # PRJ-5


def test_question_bank_post_and_draw(spark):
    from wharf import schemas
    from wharf.plans.questions import get_questions, post_question
    rows = [(f"q{i}", "math" if i % 2 else "art", "A", "test", "a", "b", None, None)
            for i in range(30)]
    bank = spark.createDataFrame(rows, schemas.QUESTION)
    bank = post_question(bank, {"question": "new", "subject": ["math", "art"], "correct": "A",
                                "use": "exam", "responseA": "a", "responseB": "b"})
    assert bank.filter("use = 'exam'").count() == 2
    got = get_questions(bank, "test", ["math"], 10, seed=1).collect()
    assert len(got) == 10 and {r["subject"] for r in got} == {"math"}
    assert {r["responseC"] for r in got} == {""}  # NULL shown as empty (FN-12)
    with pytest.raises(SampleError):
        get_questions(bank, "test", ["math"], 7)          # not an allowed size
    with pytest.raises(Q.DataQualityError):
        get_questions(bank, "test", ["history"], 5)       # unknown subject
    with pytest.raises(SampleError):
        get_questions(bank, "exam", ["math"], 5)          # fewer than n
