"""Aggregate NULL semantics and dashboard filters."""

import datetime as dt

from fixtures import R1, doc, raw_df

from evhist.plans import insights as K
from evhist.plans.models import Models, fct_events_by_city


def test_aggregate_nulls(spark):
    rows = [("E1", "X", R1, doc("E1", pmax=None, artist=None)),
            ("E2", "X", R1, doc("E2", pmin=30, pmax=60.5, artist=("A1", "N"))),
            ("E3", "X", R1, doc("E3", genre=None))]
    m = Models(raw_df(spark, rows), as_of="2024-01-30")
    got = {r.genre: r for r in fct_events_by_city(m.fct_events).collect()}
    rock = got["Rock"]
    assert rock.total_events == 2
    assert rock.unique_artists == 1          # NULL artist not counted
    assert rock.avg_ticket_price == (30 + 60.5) / 2.0   # NULL max drops the row from the avg
    assert rock.max_ticket_price == 60.5
    assert got[None].total_events == 1       # NULL genre is its own group


def test_dashboard_filter_defaults_drop_nulls(spark):
    df = spark.createDataFrame(
        [("A", "Rock", dt.date(2024, 2, 1)), (None, "Rock", dt.date(2024, 2, 1)),
         ("A", None, dt.date(2024, 2, 1)), ("A", "Rock", None)],
        "fetched_city string, genre string, event_date date")
    assert K.dashboard_filter(df).count() == 1
    assert K.dashboard_filter(df, cities=["B"]).count() == 0
    assert K.dashboard_filter(df, start="2024-02-02").count() == 0
    assert K.dashboard_filter(df, end="2024-02-01").count() == 1


def test_top_genres_limit_and_ties(spark):
    df = spark.createDataFrame([(g,) for g in "abcdefghijkl" for _ in range(2)] + [("z",)] * 5, "genre string")
    got = [r.genre for r in K.top_genres(df, 3).collect()]
    assert got == ["z", "a", "b"]


def test_events_over_time_upper_bound_only(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), "A", 1), (dt.date(2024, 2, 29), "A", 2),
                                (dt.date(2024, 3, 1), "A", 4)],
                               "event_date date, fetched_city string, total_events long")
    got = {r.event_date: r.total_events for r in K.events_over_time(df, "2024-01-30").collect()}
    assert got == {dt.date(2020, 1, 1): 1, dt.date(2024, 2, 29): 2}
    low = K.events_over_time(df, "2024-01-30", lower_bound=True).collect()
    assert [r.event_date for r in low] == [dt.date(2024, 2, 29)]


def test_price_distribution_quartiles(spark):
    df = spark.createDataFrame([("A", float(p)) for p in [1, 2, 3, 4, 100]], "fetched_city string, price_min double")
    r = K.price_distribution(df).first()
    assert (r.n, r.q1, r.median, r.q3) == (5, 2.0, 3.0, 4.0)
    assert (r.lower_fence, r.upper_fence) == (-1.0, 7.0)
    assert (r.lower_whisker, r.upper_whisker, r.n_outliers) == (1.0, 4.0, 1)


def test_upcoming_nulls_last(spark):
    df = spark.createDataFrame([("s1", None), ("s2", dt.date(2024, 1, 1))], "event_sk string, event_date date")
    for c, _ in K.UPCOMING_DISPLAY:
        if c not in df.columns:
            from pyspark.sql import functions as F
            df = df.withColumn(c, F.lit(None).cast("string"))
    got = [r["Date"] for r in K.upcoming_events(df, 1).collect()]
    assert got == [dt.date(2024, 1, 1)]


def test_approximate_variants_agree_on_small_data(spark):
    from conftest import SF001
    from evhist.plans.models import Models
    from evhist.fixture.feed import raw_feed
    m = Models(raw_feed(spark, SF001), as_of="2024-01-30")
    exact = {(r.fetched_city, r.event_date, r.genre): (r.unique_artists, r.unique_venues)
             for r in fct_events_by_city(m.fct_events).collect()}
    approx = {(r.fetched_city, r.event_date, r.genre): (r.unique_artists, r.unique_venues)
              for r in fct_events_by_city(m.fct_events, approx=True).collect()}
    assert approx == exact                      # HLL++ is exact at these cardinalities
    f = K.dashboard_filter(m.current)
    e = {r.fetched_city: r for r in K.price_distribution(f).collect()}
    a = {r.fetched_city: r for r in K.price_distribution(f, exact=False).collect()}
    assert set(a) == set(e)
    for city, r in a.items():
        assert r.n == e[city].n and r.min_price == e[city].min_price and r.max_price == e[city].max_price
        assert r.min_price <= r.q1 <= r.median <= r.q3 <= r.max_price
