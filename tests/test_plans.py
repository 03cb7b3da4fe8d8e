"""Plan shape: one shuffle + one sort per history, partial aggregation before
shuffles, WindowGroupLimit for latest-per-key, pushed-down scans."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from evhist.functions.paths import ALL_FIELDS
from evhist.operators.history import latest_per_key
from evhist.plans.models import EVENT_CARRIED, EVENT_TRACKED, KEYS, stg_event_snapshots
from evhist.plans.pipeline import typed_events
from evhist.fixture.feed import raw_feed
from evhist.sources.landing import dedup_run


@pytest.fixture(scope="module")
def typed_path(spark, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("typed") / "t")
    typed_events(raw_feed(spark, SF001)).write.parquet(p)
    return p


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")


def restore(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_history_is_one_exchange_one_sort(spark, typed_path):
    no_broadcast(spark)
    try:
        plan = physical(stg_event_snapshots(spark.read.parquet(typed_path)))
    finally:
        restore(spark)
    assert plan.count("Exchange hashpartitioning") == 1
    assert len(re.findall(r"\bSort \[", plan)) == 1
    assert plan.count("Window [") >= 2


def test_history_scan_is_pruned(spark, typed_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")   # print the whole ReadSchema
    plan = physical(stg_event_snapshots(spark.read.parquet(typed_path)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    cols = {c.split(":")[0] for c in schema.split(",")}
    assert cols == set(KEYS + ["ingested_at"] + EVENT_TRACKED + EVENT_CARRIED)
    assert "payload" not in cols


def test_dedup_aggregates_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"), (F.col("id") * 2).alias("v"))
    plan = physical(dedup_run(df, ["k"], "o"))
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "partial_min(struct(o" in below and plan.count("Exchange") == 1   # combined per map task, carried once


def test_latest_per_key_limits_before_shuffle(spark, typed_path):
    no_broadcast(spark)
    try:
        plan = physical(latest_per_key(spark.read.parquet(typed_path), KEYS, "ingested_at"))
    finally:
        restore(spark)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_current_fact_filter_pushed_to_scan(spark, tmp_path):
    from evhist.plans.models import Models
    p = str(tmp_path / "fct")
    Models(raw_feed(spark, SF001), as_of="2024-01-30").fct_events.write.parquet(p)
    q = spark.read.parquet(p).where("is_current").select("fetched_city", "genre")
    plan = physical(q)
    assert "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)]" in plan
    assert "ReadSchema: struct<fetched_city:string,genre:string>" in plan or \
        "ReadSchema: struct<fetched_city:string,is_current:boolean,genre:string>" in plan


def test_typed_table_has_all_fields(spark, typed_path):
    assert spark.read.parquet(typed_path).columns == ["event_id", "fetched_city", "ingested_at", *ALL_FIELDS, "payload"]
