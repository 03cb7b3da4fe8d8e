"""Dimensions (T7, T8) and point-in-time joins (T9, interval edges)."""

import datetime as dt

from fixtures import R1, R2, R3, doc, raw_df
from pyspark.sql import functions as F

from evhist.operators.pit import pit_join
from evhist.plans.models import Models, dim_artists


def test_tie_in_run_smallest_key_wins(spark):
    rows = [("E2", "Austin", R1, doc("E2", artist=("A1", "Name From E2"))),
            ("E1", "Seattle", R1, doc("E1", artist=("A1", "Name From E1 Seattle"))),
            ("E1", "Austin", R1, doc("E1", artist=("A1", "Name From E1 Austin")))]
    d = dim_artists(raw_df(spark, rows)).collect()
    assert [r.artist_name for r in d] == ["Name From E1 Austin"]


def test_json_null_id_or_name_has_no_artist_row(spark):
    rows = [("E1", "X", R1, doc(artist=(None, "Nameless id"))),
            ("E2", "X", R1, doc("E2", artist=("A9", None)))]
    assert dim_artists(raw_df(spark, rows)).count() == 0


def test_artist_versions_and_sk(spark):
    import hashlib
    rows = [("E1", "X", R1, doc(artist=("A1", "P"))), ("E1", "X", R2, doc(artist=("A1", "P"))),
            ("E1", "X", R3, doc(artist=("A1", "P Band")))]
    d = dim_artists(raw_df(spark, rows)).orderBy("valid_from").collect()
    assert [(r.artist_name, r.valid_from, r.valid_to, r.is_current) for r in d] == [
        ("P", R1, R3, False), ("P Band", R3, None, True)]
    assert d[0].artist_sk == hashlib.md5(b"A1|2024-01-01 06:00:00.000").hexdigest()


def test_headliner_change_leaves_old_versions_unmatched(spark):
    """Artist P at r1, Q at r2 (Q first seen r2): v1 carries Q with NULL artist_sk."""
    rows = [("E1", "X", R1, doc(status="onsale", artist=("P", "Artist P"))),
            ("E1", "X", R2, doc(status="offsale", artist=("Q", "Artist Q")))]
    f = Models(raw_df(spark, rows), as_of="2024-01-30").fct_events.orderBy("version").collect()
    assert [(r.version, r.artist_id, r.artist_sk is None) for r in f] == [(1, "Q", True), (2, "Q", False)]


def test_interval_edges(spark):
    facts = spark.createDataFrame([("k", R1), ("k", R2), ("k", R3), ("k", dt.datetime(2023, 1, 1))],
                                  "id string, valid_from timestamp_ntz")
    hist = spark.createDataFrame([("k", R1, R2, "v1"), ("k", R2, None, "v2")],
                                 "id string, valid_from timestamp_ntz, valid_to timestamp_ntz, label string")
    got = {r.valid_from: r.label for r in pit_join(facts, hist, on="id", columns=["label"]).collect()}
    assert got == {R1: "v1", R2: "v2", R3: "v2", dt.datetime(2023, 1, 1): None}


def test_pit_join_is_equi_join_not_nested_loop(spark):
    facts = spark.range(10).select(F.col("id").cast("string").alias("id"),
                                   F.lit(R1).cast("timestamp_ntz").alias("valid_from"))
    hist = spark.range(10).select(F.col("id").cast("string").alias("id"),
                                  F.lit(R1).cast("timestamp_ntz").alias("valid_from"),
                                  F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit("x").alias("label"))
    plan = pit_join(facts, hist, on="id", columns=["label"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_no_hint_and_facts_without_key_are_spread(spark):
    facts = spark.createDataFrame([(None, R1, i) for i in range(400)] + [("A", R1, -1)], "id string, valid_from timestamp_ntz, n int")
    hist = spark.createDataFrame([("A", R1, None, "x"), (None, R1, None, "y")], "id string, valid_from timestamp_ntz, valid_to timestamp_ntz, label string")
    out = pit_join(facts, hist, on="id", columns=["label"])
    assert "hint" not in out._jdf.queryExecution().logical().toString().lower()
    got = out.collect()
    assert len(got) == 401 and [r.label for r in got if r.n == -1] == ["x"] and all(r.label is None for r in got if r.n >= 0)
    was = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = pit_join(facts, hist, on="id", columns=["label"]).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 200
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
