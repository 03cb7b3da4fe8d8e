"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Two groups of timings:
* ``q:<name>`` — a registered query end to end from the ``events`` table
  (feed -> models -> query), executed with the no-op sink (full execution,
  nothing collected);
* ``mat:<step>`` — the materialized daily pipeline (land raw table, parse once,
  write the model tables) and dashboard queries over the written fact.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "raw_events", "stg_events", "stg_event_snapshots", "dim_artists", "dim_venues", "fct_events",
    "fct_events_by_city", "kpis", "events_by_city", "top_genres", "events_over_time",
    "price_distribution", "venue_map", "upcoming_events", "price_changes", "fct_incremental", "fct_extend",
    "dq_report",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    from evhist.constants import FIXTURE_AS_OF
    from evhist.plans import catalog
    from evhist.plans import insights as K
    from evhist.plans.models import read_fct
    from evhist.plans.pipeline import run_checks, run_pipeline
    from evhist.session import build_session, scratch_path, shared_dir
    from evhist.fixture.feed import raw_feed
    from evhist.sources.landing import append_raw, read_raw

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "16g"})
    # a fresh folder per run below the shared checkpoint folder (a local temp
    # folder only when the session names none)
    shared_dir(spark, tempfile.mkdtemp(prefix="evhist-bench-", dir="/tmp"))
    scratch = scratch_path(spark, "bench")

    timings: dict[str, float] = {}
    # warm-up (JIT, class loading) on the smallest fixture; not timed
    _run(catalog.REGISTRY["fct_events_by_city"](spark, "/root/testdata/sf0.001"))

    for name in HEADLINE:
        t0 = time.perf_counter()
        _run(catalog.REGISTRY[name](spark, sf_dir))
        timings[f"q:{name}"] = round(time.perf_counter() - t0, 3)

    raw_path = f"{scratch}/raw_events"
    t0 = time.perf_counter()
    append_raw(raw_feed(spark, sf_dir), raw_path)
    timings["mat:land_raw"] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    res = run_pipeline(spark, read_raw(spark, raw_path), f"{scratch}/warehouse", FIXTURE_AS_OF)
    timings["mat:models"] = round(time.perf_counter() - t0, 3)

    fct = read_fct(spark, res.tables["fct_events"])
    venues = spark.read.parquet(res.tables["dim_venues"])
    daily = spark.read.parquet(res.tables["fct_events_by_city"])
    filt = K.dashboard_filter(fct.where("is_current"))
    dash = {
        "kpis": K.kpis(filt), "events_by_city": K.events_by_city(filt), "top_genres": K.top_genres(filt),
        "events_over_time": K.events_over_time(K.dashboard_filter(daily), FIXTURE_AS_OF),
        "price_distribution": K.price_distribution(filt), "venue_map": K.venue_map(venues, filt),
        "upcoming_events": K.upcoming_events(filt),
    }
    t0 = time.perf_counter()
    for df in dash.values():
        df.collect()
    timings["mat:dashboard_all"] = round(time.perf_counter() - t0, 3)

    raw_rows = read_raw(spark, raw_path).count()
    pipe_secs = timings["mat:land_raw"] + timings["mat:models"]
    t0 = time.perf_counter()
    run_checks(spark, res, read_raw(spark, raw_path)).collect()
    timings["mat:dq_report"] = round(time.perf_counter() - t0, 3)

    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus,
                      "raw_rows": raw_rows,
                      "materialized_rows_per_sec": round(raw_rows / pipe_secs, 1),
                      "tables": sorted(res.tables)}))
    spark.stop()


if __name__ == "__main__":
    main()
