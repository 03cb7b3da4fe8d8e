"""Data checks (Q1-Q4): planted faults are found with the right status."""

from evhist.operators import quality as dq


def test_report_statuses(spark):
    df = spark.createDataFrame([(None, "onsale"), ("k1", None), ("k2", "moved"), ("k2", "onsale")],
                               "key string, status string")
    checks = [dq.Check("t", "not_null", "key"), dq.Check("t", "unique", "key"),
              dq.Check("t", "accepted_values", "status", "warn", ("onsale", "offsale")),
              dq.Check("t", "not_null", "status", "warn")]
    got = {(r.test, r.column_name): (r.status, r.failing_rows) for r in dq.dq_report({"t": df}, checks).collect()}
    assert got == {("not_null", "key"): ("fail", 1), ("unique", "key"): ("fail", 1),
                   ("accepted_values", "status"): ("warn", 1), ("not_null", "status"): ("warn", 1)}


def test_unique_on_expression_ignores_nulls(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("a", None)], "e string, c string")
    assert dq.dq_unique(df, "e || '|' || c").first().failing_rows == 0


def test_fixture_report(spark):
    from conftest import SF001
    from evhist.plans.catalog import REGISTRY
    rep = {(r.model, r.test, r.column_name): r.status for r in REGISTRY["dq_report"](spark, SF001).collect()}
    assert len(rep) == 25
    assert rep[("fct_events", "accepted_values", "event_status")] == "warn"   # 'moved' is planted
    assert rep[("fct_events", "unique", "event_sk")] == "pass"
