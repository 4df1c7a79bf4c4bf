"""Command line: run the jobs on input folders.

    python -m wharf star-v1 --log-data DIR --song-data DIR --out DIR [--year 2018]
    python -m wharf star-v2 --log-data DIR --song-data DIR --out DIR [--run-date 2018-11-05]
    python -m wharf lake-chain --customer DIR --accelerometer DIR --step-trainer DIR --out DIR
    python -m wharf ssb --data DIR --out DIR [--buckets N]
    python -m wharf load-study --split DIR --single FILE [--sep ';']
    python -m wharf serving --event-data DIR --out DIR [--buckets N]

Inputs are read with the declared schemas of :mod:`wharf.schemas`; outputs
are written below ``--out`` (a shared folder on a cluster). Results shown on
the console are the small reports (checks, top-N lists, timings).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F

from wharf import schemas
from wharf.functions import exprs as X
from wharf.operators import quality
from wharf.operators.quality import report_lines
from wharf.plans import analytics, lake, layout, serving, star
from wharf.session import analyze_tables, get_session
from wharf.sinks.writers import overwrite
from wharf.sources import files


def _result(df, out: str, name: str, preview: int = 20) -> None:
    """Write a whole result below ``out`` and show its first rows, marked as such."""
    path = f"{out.rstrip('/')}/results/{name}"
    overwrite(df, path)
    written = df.sparkSession.read.parquet(path)
    print(f"-- {name}: {written.count()} rows in {path}; first rows:")
    written.show(preview, truncate=False)


def _star_v1(spark, a) -> int:
    events = files.read_json(spark, a.log_data, schemas.STAGING_EVENTS)
    songs = files.read_json(spark, a.song_data, schemas.STAGING_SONGS)
    paths = star.run_v1(events, songs, a.out)
    tables = {n: spark.read.parquet(p) for n, p in paths.items()}
    for line in report_lines(tables.pop("dq_report")):
        print(line)
    for name, df in analytics.star_sample_queries(tables, a.year).items():
        _result(df, a.out, name)
    return 0


def _star_v2(spark, a) -> int:
    log = a.log_data
    if a.run_date:
        log = files.dated_prefix(log, dt.date.fromisoformat(a.run_date))
    events = files.read_json(spark, log, schemas.STAGING_EVENTS)
    songs = files.read_json(spark, a.song_data, schemas.STAGING_SONGS)
    paths = star.run_v2(events, songs, a.out)
    print("\n".join(f"{k}: {v}" for k, v in paths.items()))
    return 0


def _lake_chain(spark, a) -> int:
    result = lake.run_chain(
        files.read_json(spark, a.customer, schemas.CUSTOMER_LANDING),
        files.read_json(spark, a.accelerometer, schemas.ACCELEROMETER_LANDING),
        files.read_json(spark, a.step_trainer, schemas.STEP_TRAINER_LANDING),
        a.out,
    )
    for job, table in result.tables.items():
        print(f"{job}: {table} ({result.rows[job]} rows)")
    return 0


def _ssb(spark, a) -> int:
    sep = "|"
    plain = {}
    for n, ddl in schemas.SSB_TABLES.items():
        path = f"{a.data.rstrip('/')}/{n}"
        plain[n] = files.read_delimited(spark, path, ddl, sep=sep,
                                        trailing_sep=files.ends_with_separator(spark, path, sep))
    paths = layout.write_plain(plain, a.out)
    plain = {n: spark.read.parquet(p) for n, p in paths.items()}
    keys = {"lineorder": a.bucket_key, "part": "p_partkey", "supplier": "s_suppkey",
            "customer": "c_custkey", "dwdate": "d_datekey"}
    names = layout.write_bucketed(plain, keys, a.buckets, a.out, "ssb")
    analyze_tables(spark, list(names.values()))  # statistics for join reordering
    bucketed = {n: spark.table(t) for n, t in names.items()}

    def q(fn):
        return lambda t: fn(t)

    queries = {
        "oneDim": q(lambda t: analytics.ssb_one_dim(t["lineorder"], t["dwdate"], 1997, 1, 3, 24)),
        "twoDim": q(lambda t: analytics.ssb_two_dim(t["lineorder"], t["dwdate"], t["part"],
                                                    t["supplier"], "MFGR#12", "AMERICA",
                                                    revenue=F.col("lo_revenue"))),
        "drill": q(lambda t: analytics.ssb_drill(t["lineorder"], t["dwdate"], t["customer"],
                                                 t["supplier"], ["UNITED KI1", "UNITED KI5"],
                                                 "Dec1997", revenue=F.col("lo_revenue"))),
        "oneDimSameDist": q(lambda t: analytics.ssb_same_dist(t["lineorder"], t["part"])),
    }
    layout.compare_layouts(spark, queries, plain, bucketed).show(truncate=False)
    return 0


def _serving(spark, a) -> int:
    raw = files.read_csv_dir(spark, a.event_data, schemas.EVENT_CSV_COLUMNS)
    clean_dir = f"{a.out.rstrip('/')}/event_datafile_new"
    serving.write_clean_csv(raw, clean_dir)
    print("clean CSV:", quality.csv_line_count(spark, clean_dir).first().asDict())
    # The tables keep the event time as the arrival order (T-17), parsed via double (T-4).
    rows = serving.clean_event_csv(raw, columns=(*serving.CLEAN_COLUMNS, "ts"))
    events = serving.typed_events(rows).withColumn("ts", X.to_bigint_via_double("ts"))
    names = serving.build_query_tables(events, a.out, a.buckets)
    for name, df in serving.answer_queries(spark, names).items():
        _result(df, a.out, name)
    return 0


def _load_study(spark, a) -> int:
    layout.compare_loads(spark, {"split": a.split, "single": a.single}, schemas.TICKETS,
                         sep=a.sep).show(truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="wharf")
    p.add_argument("--master", default=None, help="e.g. local[8]; leave unset on a cluster")
    sub = p.add_subparsers(dest="cmd", required=True)
    s1 = sub.add_parser("star-v1", help="spec-driven star build from JSON song and log data")
    s1.add_argument("--log-data", required=True)
    s1.add_argument("--song-data", required=True)
    s1.add_argument("--out", required=True)
    s1.add_argument("--year", type=int, default=2018)
    s2 = sub.add_parser("star-v2", help="staged star build with checks (optionally one run date)")
    s2.add_argument("--log-data", required=True)
    s2.add_argument("--song-data", required=True)
    s2.add_argument("--out", required=True)
    s2.add_argument("--run-date", default=None)
    lc = sub.add_parser("lake-chain", help="landing → trusted → curated lake jobs")
    lc.add_argument("--customer", required=True)
    lc.add_argument("--accelerometer", required=True)
    lc.add_argument("--step-trainer", required=True)
    lc.add_argument("--out", required=True)
    ss = sub.add_parser("ssb", help="SSB queries on plain against bucketed layouts")
    ss.add_argument("--data", required=True, help="folder with lineorder/ part/ supplier/ customer/ dwdate/")
    ss.add_argument("--out", required=True)
    ss.add_argument("--buckets", type=int, default=64)
    ss.add_argument("--bucket-key", default="lo_orderdate",
                    help="lineorder bucket column (the join key; T-19)")
    sv = sub.add_parser("serving", help="query-first tables from an event CSV folder")
    sv.add_argument("--event-data", required=True)
    sv.add_argument("--out", required=True)
    sv.add_argument("--buckets", type=int, default=64)
    ls = sub.add_parser("load-study", help="split-file against single-file gzip load (tickets)")
    ls.add_argument("--split", required=True, help="folder or glob of the split gzip parts")
    ls.add_argument("--single", required=True, help="the single gzip file")
    ls.add_argument("--sep", default=";")
    a = p.parse_args(argv)
    spark = get_session(a.master, app_name=f"wharf-{a.cmd}")
    run = {"star-v1": _star_v1, "star-v2": _star_v2, "lake-chain": _lake_chain, "ssb": _ssb,
           "load-study": _load_study, "serving": _serving}
    return run[a.cmd](spark, a)


if __name__ == "__main__":
    sys.exit(main())
