"""Model-level traps (T5, T6) and FIXTURES §4 counts."""

import pytest
from fixtures import R1, doc, raw_df
from pyspark.sql import functions as F

from conftest import SF001
from evhist.functions.dates import plausible_dates
from evhist.plans.models import Models
from evhist.fixture.feed import raw_feed


def test_implausible_date(spark):
    rows = [("E1", "X", R1, doc(date="2037-01-01"))]
    m = Models(raw_df(spark, rows), as_of="2024-01-30")
    assert m.stg_events.count() == 0
    f = m.fct_events.first()
    assert f.event_date.isoformat() == "2037-01-01" and f.genre is None and f.event_name is None
    agg = m.fct_events_by_city.collect()
    assert [(r.genre, r.total_events) for r in agg] == [(None, 1)]


def test_date_window_bounds(spark):
    df = spark.createDataFrame([("2023-01-30",), ("2023-01-29",), ("2029-01-30",), ("2029-01-31",), (None,)],
                               "d string").select(F.col("d").cast("date").alias("event_date"))
    kept = {str(r.event_date) for r in plausible_dates(df, "event_date", "2024-01-30").collect()}
    assert kept == {"2023-01-30", "2029-01-30", "None"}


@pytest.fixture(scope="module")
def m001(spark):
    return Models(raw_feed(spark, SF001), as_of="2024-01-30")


def test_fixture_counts_sf0001(m001):
    assert m001.raw.count() == 602
    assert m001.raw.agg(F.sum(F.length("payload"))).first()[0] == 335298
    assert m001.snapshots.count() == 366
    assert m001.snapshots.where("is_current").count() == 30
    assert (m001.dim_artists.count(), m001.dim_venues.count()) == (16, 20)
    f = m001.fct_events
    assert f.count() == 366 and f.select("event_sk").distinct().count() == 366
    assert f.where("artist_sk is null").count() == 45
    by_city = m001.fct_events_by_city
    assert (by_city.count(), by_city.agg(F.sum("total_events")).first()[0]) == (28, 28)


def test_literal_rule_counts(spark):
    lit = Models(raw_feed(spark, SF001), as_of="2024-01-30", rule="literal").snapshots
    assert lit.where("is_current").count() == 17


def test_fct_columns_in_order(m001):
    from evhist.plans.models import FCT_COLUMNS
    assert m001.fct_events.columns == FCT_COLUMNS
    assert len(FCT_COLUMNS) == 26


def test_views_and_bounded_handoff(spark, m001):
    import pytest as _pytest

    from evhist.plans.views import ResultTooLarge, register_views, to_local
    names = register_views(m001, prefix="t_")
    assert "t_fct_events" in names
    assert spark.sql("SELECT count(*) AS n FROM t_fct_events WHERE is_current").first().n == 30
    assert len(to_local(m001.fct_events_by_city, 100)) == 28
    with _pytest.raises(ResultTooLarge):
        to_local(m001.fct_events, 10)


def test_fused_fact_equals_modular(spark, m001):
    from evhist.plans.models import fct_events
    modular = fct_events(m001.snapshots, m001.event_attrs, m001.dim_artists, m001.dim_venues)
    fused = m001.fct_events
    assert fused.columns == modular.columns
    assert sorted(tuple(r) for r in fused.collect()) == sorted(tuple(r) for r in modular.collect())
    # one pass: no latest-per-key window in the fused plan
    assert "row_number" not in fused._jdf.queryExecution().executedPlan().toString()
