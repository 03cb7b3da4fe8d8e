"""Hot keys: a third of all events re-assigned to one user (one hot event key,
one hot artist, one hot venue).  Results still equal the DuckDB oracle, on the
lazy path and on the pipeline and the daily run."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF01

sys.path.insert(0, os.path.join(ROOT, "tools"))

from oracle_check import frame_hash  # noqa: E402

from evhist.operators.merge import State  # noqa: E402
from evhist.plans.models import Models, read_fct  # noqa: E402
from evhist.plans.oracle import oracle_sql  # noqa: E402
from evhist.plans.pipeline import daily_paths, run_daily, run_pipeline  # noqa: E402
from evhist.fixture.feed import raw_from_events, read_table  # noqa: E402
from evhist.sources.landing import append_raw, read_raw  # noqa: E402


@pytest.fixture(scope="module")
def skewed(spark):
    ev = read_table(spark, SF01, "events")
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("long"))
                         .otherwise(F.col("user_id")))


@pytest.fixture(scope="module")
def duck_skewed():
    import duckdb
    con = duckdb.connect()
    con.execute(f"""CREATE VIEW events AS SELECT event_id, ts,
                    CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, event_type, value, props
                    FROM read_parquet('{SF01}/events.parquet')""")
    return con


def test_skew_is_real(skewed):
    raw = raw_from_events(skewed)
    top = raw.groupBy("event_id").count().orderBy(F.desc("count")).first()
    assert top.event_id == "E000000" and top["count"] >= 50


@pytest.mark.parametrize("name", ["fct_events", "dim_artists", "dim_venues", "fct_events_by_city"])
def test_lazy_models_equal_oracle_under_skew(spark, skewed, duck_skewed, name):
    m = Models(raw_from_events(skewed), as_of="2024-01-30")
    got = {"fct_events": m.fct_events, "dim_artists": m.dim_artists, "dim_venues": m.dim_venues,
           "fct_events_by_city": m.fct_events_by_city}[name].toPandas()
    want = duck_skewed.execute(oracle_sql()[name]).fetchdf()
    assert len(got) == len(want) and frame_hash(got) == frame_hash(want)


@pytest.mark.parametrize("how", ["pipeline", "segmented", "daily"])
def test_stored_fact_equals_oracle_under_skew(spark, skewed, duck_skewed, scratch, how):
    raw = raw_from_events(skewed)
    if how == "daily":
        split = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
        run_daily(spark, raw.where(F.col("ingested_at") < split), scratch, "2024-01-30")
        run_daily(spark, raw.where(F.col("ingested_at") >= split), scratch, "2024-01-30")
        got = State(spark, daily_paths(scratch)["state"]).fct_events.read().toPandas()
    else:
        append_raw(raw, f"{scratch}/raw")
        segment = F.date_trunc("week", F.col("ingested_at")) if how == "segmented" else None
        res = run_pipeline(spark, read_raw(spark, f"{scratch}/raw"), f"{scratch}/wh", "2024-01-30", segment=segment)
        got = read_fct(spark, res.tables["fct_events"]).toPandas()
    want = duck_skewed.execute(oracle_sql()["fct_events"]).fetchdf()
    assert len(got) == len(want) and frame_hash(got) == frame_hash(want)
