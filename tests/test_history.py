"""SCD2 micro-fixtures."""

from fixtures import R1, R2, R3, doc, raw_df

from evhist.plans.models import stg_event_snapshots


def hist(spark, docs, rule="documented", city="Pittsburgh", key="E1"):
    rows = [(key, city, ts, d) for ts, d in zip([R1, R2, R3][: len(docs)], docs)]
    out = stg_event_snapshots(raw_df(spark, rows), rule).orderBy("valid_from").collect()
    return [(r.version, r.valid_from, r.valid_to, r.is_current) for r in out]


def test_unchanged_one_version(spark):
    a = doc()
    assert hist(spark, [a, a, a]) == [(1, R1, None, True)]
    # literal rule: LEAD sees all observations, so the only version is closed
    assert hist(spark, [a, a, a], "literal") == [(1, R1, R2, False)]


def test_change_starts_version(spark):
    a, b = doc(status="onsale"), doc(status="offsale")
    assert hist(spark, [a, a, b]) == [(1, R1, R3, False), (2, R3, None, True)]
    assert hist(spark, [a, a, b], "literal") == [(1, R1, R2, False), (2, R3, None, True)]


def test_return_to_old_value_is_new_version(spark):
    a, b = doc(pmin=20), doc(pmin=25)
    assert [v for v, *_ in hist(spark, [a, b, a])] == [1, 2, 3]


def test_null_value_changes_are_changes(spark):
    docs = [doc(pmin=None), doc(pmin=20), doc(pmin=None)]
    assert [v for v, *_ in hist(spark, docs)] == [1, 2, 3]


def test_untracked_change_is_not_a_version(spark):
    assert len(hist(spark, [doc(currency="USD"), doc(currency="CAD")])) == 1


def test_all_tracked_null_first(spark):
    nulls = doc(status=None, date=None, time=None, pmin=None, pmax=None)
    docs = [nulls, nulls, doc()]
    assert [v for v, *_ in hist(spark, docs)] == [1, 2]
    assert [v for v, *_ in hist(spark, docs, "literal")] == [0, 1]


def test_two_cities_independent(spark):
    from evhist.plans.models import Models

    rows = [("E1", "Pittsburgh", R1, doc(pmin=20)), ("E1", "Pittsburgh", R2, doc(pmin=30)),
            ("E1", "Chicago", R1, doc(pmin=20)), ("E1", "Chicago", R2, doc(pmin=20))]
    m = Models(raw_df(spark, rows), as_of="2024-01-30")
    snaps = {(r.fetched_city, r.version) for r in m.snapshots.collect()}
    assert snaps == {("Pittsburgh", 1), ("Pittsburgh", 2), ("Chicago", 1)}
    sks = [r.event_sk for r in m.fct_events.collect()]
    assert len(sks) == len(set(sks)) == 3


def test_history_properties_on_fixture(spark):
    """Intervals contiguous and disjoint, one current row, adjacent versions differ."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from conftest import SF01
    from evhist.plans.models import EVENT_TRACKED
    from evhist.fixture.feed import raw_feed

    h = stg_event_snapshots(raw_feed(spark, SF01))
    w = Window.partitionBy("event_id", "fetched_city").orderBy("version")
    checked = h.select(
        "*", F.lead("valid_from").over(w).alias("next_from"), F.row_number().over(w).alias("rn"),
        *[F.lag(c).over(w).alias(f"prev_{c}") for c in EVENT_TRACKED])
    same_as_prev = None
    for c in EVENT_TRACKED:
        e = F.col(f"prev_{c}").eqNullSafe(F.col(c))
        same_as_prev = e if same_as_prev is None else same_as_prev & e
    bad = checked.where(
        ~F.col("valid_to").eqNullSafe(F.col("next_from"))      # contiguous, disjoint
        | (F.col("version") != F.col("rn"))                     # versions 1..n
        | ((F.col("rn") > 1) & same_as_prev)                    # adjacent versions differ
        | (F.col("valid_to").isNotNull() & (F.col("valid_to") <= F.col("valid_from"))))
    assert bad.count() == 0
    per_key = h.groupBy("event_id", "fetched_city").agg(F.count_if("is_current").alias("n"))
    assert per_key.where("n != 1").count() == 0


def test_segmented_history_equals_plain_with_hot_key(spark):
    """A hot key (400 observations) split into day and 6-hour segments gives
    exactly the plain history, including changes at segment boundaries."""
    import datetime as dt
    import random

    from pyspark.sql import functions as F

    from evhist.operators.history import scd2, scd2_segmented

    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(400):                                   # the hot key: hourly observations
        rows.append(("HOT", t0 + dt.timedelta(hours=i), rnd.choice(["a", "b", None]),
                     rnd.choice([1.0, 2.0, None]), rnd.choice(["x", "y"])))
    for k in range(5):                                     # ordinary keys
        for i in range(rnd.randint(1, 6)):
            rows.append((f"K{k}", t0 + dt.timedelta(days=i), rnd.choice(["a", "b"]), 1.0, "x"))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, s string, p double, c string")
    plain = sorted(tuple(r) for r in scd2(df, ["k"], "ts", ["s", "p"], ["c"]).collect())
    for seg in [F.to_date("ts"), F.date_trunc("hour", F.col("ts")),
                F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / (6 * 3600))]:
        got = sorted(tuple(r) for r in scd2_segmented(df, ["k"], "ts", ["s", "p"], ["c"], seg).collect())
        assert got == plain
