"""Materialized pipeline: written tables equal the lazy models, with a plain or a
segmented history; the daily run equals a rebuild, repeated or not."""

import pytest
from fixtures import R1, R2, R3, doc, raw_df
from pyspark.sql import functions as F

from conftest import SF001
from evhist.fixture.feed import raw_feed
from evhist.operators.merge import State
from evhist.plans.models import Models, fct_from_files
from evhist.plans.pipeline import MODEL_TABLES, daily_paths, read_observations, run_daily, run_pipeline
from evhist.sources.landing import append_raw, read_raw


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("segment", [None, "month"])
def test_pipeline_tables_equal_models(spark, scratch, segment):
    append_raw(raw_feed(spark, SF001), f"{scratch}/raw")
    part = segment and F.date_trunc(segment, F.col("ingested_at"))
    res = run_pipeline(spark, read_raw(spark, f"{scratch}/raw"), f"{scratch}/wh", "2024-01-30", segment=part)
    assert set(res.tables) == set(MODEL_TABLES)
    m = Models(raw_feed(spark, SF001), as_of="2024-01-30")
    for name, df in [("stg_event_snapshots", m.snapshots), ("fct_events", m.fct_events),
                     ("fct_events_by_city", m.fct_events_by_city), ("dim_venues", m.dim_venues)]:
        got = spark.read.parquet(res.tables[name])
        got = fct_from_files(got) if name == "fct_events" else got
        assert rows(got.select(*df.columns)) == rows(df), name


def test_current_fact_reads_one_partition(spark, scratch):
    append_raw(raw_feed(spark, SF001), f"{scratch}/raw")
    res = run_pipeline(spark, read_raw(spark, f"{scratch}/raw"), f"{scratch}/wh", "2024-01-30")
    from evhist.plans import insights as K
    from evhist.plans.models import read_fct
    q = K.kpis(K.dashboard_filter(read_fct(spark, res.tables["fct_events"]).where("is_current")))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_current" in plan and "(is_current#" in plan
    assert q.first().total_events > 0


def test_checks_on_written_tables(spark, scratch):
    from evhist.plans.pipeline import run_checks
    append_raw(raw_feed(spark, SF001), f"{scratch}/raw")
    raw = read_raw(spark, f"{scratch}/raw")
    res = run_pipeline(spark, raw, f"{scratch}/wh", "2024-01-30")
    rep = {(r.model, r.test, r.column_name): (r.status, r.failing_rows) for r in run_checks(spark, res, raw).collect()}
    assert len(rep) == 25
    assert rep[("fct_events", "accepted_values", "event_status")] == ("warn", 1)
    assert all(v[0] == "pass" for k, v in rep.items() if k[1] != "accepted_values")


def _daily_equals_rebuild(spark, root, raw):
    m = Models(raw, as_of="2024-01-30")
    st = State(spark, daily_paths(root)["state"])
    for name, df in [("fct_events", m.fct_events), ("dim_artists", m.dim_artists), ("dim_venues", m.dim_venues)]:
        assert rows(getattr(st, name).read().select(*df.columns)) == rows(df), name


def test_run_daily_equals_rebuild_and_can_be_repeated(spark, scratch):
    raw = raw_feed(spark, SF001)
    split = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    first, second = raw.where(F.col("ingested_at") < split), raw.where(F.col("ingested_at") >= split)
    modes = [run_daily(spark, b, scratch, "2024-01-30") for b in (first, second, raw.limit(0), second)]
    assert modes == ["full", "extend", "empty", "replay"]
    _daily_equals_rebuild(spark, scratch, raw)
    stored = read_observations(spark, daily_paths(scratch)["observations"])
    assert stored.count() == 602 == stored.select("event_id", "fetched_city", "ingested_at").distinct().count()


def test_a_run_in_two_batches_gives_one_observation(spark, scratch):
    a = [("E1", "0412", R1, doc(pmin=20)), ("", "0412", R1, doc(""))]
    b = [("E1", "0412", R1, doc(pmin=99)), ("E2", "0412", R1, doc("E2")), ("E1", "0412", R2, doc(pmin=20))]
    run_daily(spark, raw_df(spark, a), scratch, "2024-01-30")
    run_daily(spark, raw_df(spark, b), scratch, "2024-01-30")
    _daily_equals_rebuild(spark, scratch, raw_df(spark, [a[0], *b[1:]]))
    fct = State(spark, daily_paths(scratch)["state"]).fct_events.read()
    assert fct.where("valid_from = valid_to").count() == 0
    assert {r.fetched_city for r in fct.collect()} == {"0412"}


def test_empty_raw_and_empty_first_run(spark, scratch):
    none = raw_feed(spark, SF001).limit(0)
    res = run_pipeline(spark, none, f"{scratch}/wh", "2024-01-30")
    assert fct_from_files(spark.read.schema(Models(none).fct_events.schema).parquet(res.tables["fct_events"])).count() == 0
    assert run_daily(spark, none, scratch, "2024-01-30") == "empty"
    assert run_daily(spark, raw_df(spark, [("E1", "X", R1, doc())]), scratch, "2024-01-30") == "full"


def test_payload_is_parsed_once_per_row(spark, scratch):
    raw = raw_feed(spark, SF001)
    run_daily(spark, raw, scratch, "2024-01-30")
    stored = read_observations(spark, daily_paths(scratch)["observations"])
    plan = Models(stored, as_of="2024-01-30").fct_events._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan


def test_a_daily_run_opens_the_folder_of_its_day_only(spark, scratch):
    """The other days' observation files are spoiled before the run, and the plan names the day filter."""
    import glob

    r = [(f"E{i}", "X", when, doc(f"E{i}", pmin=20 + k)) for i in range(5) for k, when in enumerate((R1, R2))]
    today = [(f"E{i}", "X", R3, doc(f"E{i}", pmin=30)) for i in range(4)]
    for when in (R1, R2):
        run_daily(spark, raw_df(spark, [x for x in r if x[2] == when]), scratch, "2024-01-30")
    path = daily_paths(scratch)["observations"]
    held = {}
    for file in glob.glob(f"{path}/ingest_date=*/*/*.parquet"):
        with open(file, "rb") as f:
            held[file] = f.read()
        with open(file, "wb") as f:
            f.write(b"spoiled")
    assert run_daily(spark, raw_df(spark, today[:2]), scratch, "2024-01-30") == "extend"
    assert run_daily(spark, raw_df(spark, today), scratch, "2024-01-30") == "replay"  # two are stored by now
    for file, data in held.items():
        with open(file, "wb") as f:
            f.write(data)
    stored = read_observations(spark, path)
    assert stored.count() == 14 == stored.select("event_id", "ingested_at").distinct().count()
    _daily_equals_rebuild(spark, scratch, raw_df(spark, r + today))
    plan = read_observations(spark, path, days_of=raw_df(spark, today))._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_append_new_adds_each_observation_once(spark, scratch):
    from evhist.sources.landing import append_new

    r = [(f"E{i}", c, when, doc(f"E{i}")) for i in range(3) for c in ("X", None) for when in (R1, R2)]
    for part in (r[:7], r[:7], r):
        append_new(raw_df(spark, part), scratch)
    assert rows(read_raw(spark, scratch).select("event_id", "fetched_city", "ingested_at").fillna("-")) == sorted((e, c or "-", w) for e, c, w, _ in r)
