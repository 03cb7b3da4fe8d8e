"""Dirty payloads (FIXTURES §5): NULLs in "null" mode, errors in "fail" mode."""

import pytest
from fixtures import R1, doc, raw_df

from evhist.functions.paths import ALL_FIELDS, flatten


def flat(spark, payload, on_error="null"):
    return flatten(raw_df(spark, [("E1", "X", R1, payload)]), ALL_FIELDS, on_error).first()


def test_full_document(spark):
    r = flat(spark, doc(lat="31.5", lon="-81.5"))
    assert r.event_date.isoformat() == "2024-03-01"
    assert str(r.event_datetime_utc) == "2024-03-01 01:00:00"   # wall clock kept, no TZ shift
    assert (r.price_min, r.price_max) == (20.0, 40.5)
    assert (r.venue_latitude, r.venue_longitude) == (31.5, -81.5)  # numeric strings parse
    assert (r.artist_id, r.artist_name, r.genre) == ("A1", "Artist 1", "Rock")


@pytest.mark.parametrize("payload", ["{}", "not json at all", '{"_embedded":{"venues":[],"attractions":[]},'
                                                               '"classifications":[],"priceRanges":[]}'])
def test_empty_or_malformed_gives_nulls(spark, payload):
    r = flat(spark, payload)
    assert all(r[f] is None for f in ALL_FIELDS)


def test_bad_date_and_string_price(spark):
    r = flat(spark, doc(date="TBA", pmin="25"))
    assert r.event_date is None and r.event_datetime_utc is None
    assert r.price_min == 25.0


def test_json_null_is_missing(spark):
    r = flat(spark, doc(artist=("A1", None)))
    assert r.artist_id == "A1" and r.artist_name is None


def test_fail_mode_raises(spark):
    with pytest.raises(Exception):
        flat(spark, doc(date="TBA"), on_error="fail")


def test_parse_is_pruned_to_requested_fields(spark):
    df = flatten(raw_df(spark, [("E1", "X", R1, doc())]), ["artist_id"])
    assert df.columns == ["event_id", "fetched_city", "ingested_at", "artist_id"]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "priceRanges" not in plan and "attractions" in plan


def test_json_valid(spark):
    from pyspark.sql import functions as F

    from evhist.functions.paths import json_valid
    df = raw_df(spark, [("E1", "X", R1, doc()), ("E2", "X", R1, "{broken")])
    got = {r.event_id: r.v for r in df.select("event_id", json_valid(F.col("payload")).alias("v")).collect()}
    assert got == {"E1": True, "E2": False}


def test_surrogate_key_null_safe(spark):
    from pyspark.sql import functions as F

    from evhist.functions.keys import surrogate_key
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    ks = [r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()]
    assert ks[0] != ks[1]
    import hashlib
    assert ks[0] == hashlib.md5(b"|a").hexdigest()
    assert df.select(F.md5(F.concat_ws("|", "x", "y")).alias("k")).distinct().count() == 1  # why coalesce matters


def test_variant_paths_agree_with_flatten(spark):
    from pyspark.sql import functions as F

    from conftest import SF001
    from evhist.functions.paths import variant_value
    from evhist.fixture.feed import raw_feed
    raw = raw_feed(spark, SF001)
    flat = flatten(raw, ["artist_name", "price_min", "venue_latitude", "event_date"])
    via_variant = raw.select(
        "event_id", "fetched_city", "ingested_at",
        variant_value(F.col("payload"), "$._embedded.attractions[0].name").alias("artist_name"),
        variant_value(F.col("payload"), "$.priceRanges[0].min", "double").alias("price_min"),
        variant_value(F.col("payload"), "$._embedded.venues[0].location.latitude", "double").alias("venue_latitude"),
        variant_value(F.col("payload"), "$.dates.start.localDate", "date").alias("event_date"))
    assert flat.exceptAll(via_variant).count() == 0 and via_variant.exceptAll(flat).count() == 0
