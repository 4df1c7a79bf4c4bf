"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints ONE JSON line:
``{"metric": "headline_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``

(no collect, no cache); one warm-up, then the median of ``$BENCH_REPEATS``
(default 3) runs for the headline queries and one timed run for the rest.

Headline: the four SSB queries on the plain layout and on the layout
bucketed on the order key (PL-13, PL-14), the v1 and v2 star builds
(PL-1, PL-2), and the split-file against single-file gzip load (PL-15).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import types

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402

from wharf.plans import analytics as A  # noqa: E402
from wharf.plans import star  # noqa: E402
from wharf.plans.layout import run_noop  # noqa: E402
from wharf.registry import (  # noqa: E402
    PLAY_PAGE, QUERIES, SSB_CATEGORY, SSB_CITIES, SSB_DISCOUNT, SSB_MAX_QUANTITY, SSB_REGION,
    SSB_YEAR, SSB_YEARMONTH, ssb_tables,
)
from wharf.session import get_session, input_bytes, scratch_path, size_for_input  # noqa: E402
from wharf.sinks.writers import save_bucketed  # noqa: E402
from wharf.sources import conform as C  # noqa: E402
from wharf.sources.tables import TABLES, Tables, load  # noqa: E402

def timed(fn, repeats: int, warmup: int = 1) -> float:
    for _ in range(warmup):
        fn()
    runs = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    return statistics.median(runs)


def ssb_queries(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "ssb_one_dim": A.ssb_one_dim(s["lineorder"], s["dwdate"], SSB_YEAR, *SSB_DISCOUNT,
                                     SSB_MAX_QUANTITY),
        "ssb_two_dim": A.ssb_two_dim(s["lineorder"], s["dwdate"], s["part"], s["supplier"],
                                     SSB_CATEGORY, SSB_REGION),
        "ssb_drill": A.ssb_drill(s["lineorder"], s["dwdate"], s["customer"], s["supplier"],
                                 SSB_CITIES, SSB_YEARMONTH),
        "ssb_same_dist": A.ssb_same_dist(s["lineorder"], s["part"]),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = get_session(f"local[{cpus}]", app_name="wharf-bench", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "8g")})
    # Shuffle and split sizes from the input volume (only keys left unset).
    size_for_input(spark, input_bytes(spark, [sf_dir]))
    t = Tables(spark, sf_dir)
    out: dict[str, float] = {}
    headline: list[str] = []

    # PL-13 on the plain layout (the driver's Parquet files).
    for name, df in ssb_queries(ssb_tables(t)).items():
        out[name] = timed(lambda df=df: run_noop(df), repeats)
        headline.append(name)

    # PL-14: lineitem and orders bucketed + sorted on the order key, so the
    # lineorder join reads both sides without an Exchange.
    n = cpus * 2
    tables = {name: load(spark, sf_dir, name) for name in TABLES}
    t0 = time.perf_counter()
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        tname = f"bench_{name}_b{n}"
        save_bucketed(tables[name], tname, [key], n, sort_by=[key],
                      path=scratch_path(spark, tname))
        tables[name] = spark.table(tname)
    out["load_bucketed_lineitem_orders"] = time.perf_counter() - t0
    bucketed = types.SimpleNamespace(**tables)
    for name, df in ssb_queries(ssb_tables(bucketed)).items():
        out[f"{name}_bucketed"] = timed(lambda df=df: run_noop(df), repeats)
        headline.append(f"{name}_bucketed")

    # PL-1 / PL-2: the whole star job — staging persisted once, every table
    # written as Parquet, checks run — into a fresh folder each time.
    def star_v1():
        star.run_v1(C.staging_events(t), C.staging_songs(t), scratch_path(spark, "v1"),
                    PLAY_PAGE)

    def star_v2():
        star.run_v2(C.staging_events(t), C.staging_songs(t), scratch_path(spark, "v2"),
                    PLAY_PAGE)

    out["star_v1_build"] = timed(star_v1, repeats)
    out["star_v2_build"] = timed(star_v2, repeats)
    headline += ["star_v1_build", "star_v2_build"]

    # PL-15: lineitem as 2·cpus gzip parts against one gzip file.
    li = t.lineitem
    base = scratch_path(spark, "bench_gzip")
    for label, df in (("split", li.repartition(n)), ("single", li.coalesce(1))):
        (df.write.mode("overwrite").option("sep", ";").option("compression", "gzip")
         .csv(f"{base}/{label}"))
        reader = (spark.read.option("sep", ";").schema(li.schema).csv(f"{base}/{label}/part*"))
        out[f"load_gzip_{label}"] = timed(
            lambda r=reader, lab=label: run_noop(r.repartition(n) if lab == "single" else r),
            repeats)
    headline.append("load_gzip_split")  # the single file is one task by nature

    # Every other registered query once, after a warm-up. A failure is
    # reported on stderr and recorded as null, so the JSON line still prints.
    failed: dict[str, None] = {}
    for name, fn in QUERIES.items():
        if name in out:
            continue
        try:
            out[name] = timed(lambda fn=fn: run_noop(fn(spark, sf_dir)), 1)
        except Exception as exc:  # noqa: BLE001
            print(f"bench: {name} failed: {exc}", file=sys.stderr)
            failed[name] = None

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(out[k] for k in headline), 3),
        "unit": "sec",
        "queries": {**{k: round(v, 3) for k, v in out.items()}, **failed},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
