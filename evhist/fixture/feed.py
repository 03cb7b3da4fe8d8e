"""Deterministic landing feed derived from the driver's ``events`` table.

Each ``events`` row becomes one observation of a concert event returned by the
API for one city in one daily run (``landed``); the in-run dedup keeps the first
observation per (event_id, fetched_city, run) and yields ``raw_events`` with the
landing table's four columns.  All work is column expressions plus one
map-side-combined aggregate, so it scales with ``events``.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import CITY_NAMES
from ..sources.landing import dedup_run

RAW_COLUMNS = ["event_id", "fetched_city", "ingested_at", "payload"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _opt(cond: Column, text: Column) -> Column:
    """``text`` when ``cond`` holds, else the empty string (never NULL)."""
    return F.when(cond, text).otherwise(F.lit(""))


def landed_keys(events: DataFrame) -> DataFrame:
    """Keys and source fields of every landed observation (no JSON yet)."""
    return events.select(*_landed_key_columns())


@lru_cache(maxsize=1)
def _landed_key_columns() -> tuple[Column, ...]:
    # Column expressions are unresolved and reusable: build them once per process
    # (each Column call is a round trip to the JVM).
    u, seq = F.col("user_id"), F.col("event_id")
    city_idx = ((u + seq % 2) % len(CITY_NAMES)).cast("int")
    return (
        seq.alias("seq"),
        F.concat(F.lit("E"), F.lpad(_s(u), 6, "0")).alias("event_id"),
        F.element_at(F.array(*[F.lit(c) for c in CITY_NAMES]), city_idx + 1).alias("fetched_city"),
        (F.col("ts").cast("date").cast("timestamp_ntz") + F.expr("INTERVAL 6 HOURS")).alias("ingested_at"),
        u.alias("u"),
        F.col("value").alias("v"),
        (F.col("event_type") == "error").alias("is_error"),
        F.dayofmonth("ts").alias("d"),
    )


@lru_cache(maxsize=1)
def payload_expr() -> Column:
    """The event document text, built from the columns of ``landed_keys``."""
    u, v, d = F.col("u"), F.col("v"), F.col("d")
    eid = F.col("event_id")
    vn, an = u % 20, u % 40

    is_error = F.col("is_error")
    status = (F.when(is_error & (v >= 100), F.lit("moved"))
              .when(v >= 150, F.lit("cancelled"))
              .when(v >= 80, F.lit("offsale"))
              .otherwise(F.lit("onsale")))
    local_date = _s(F.when(u % 29 == 0, F.lit("2037-01-01").cast("date"))
                    .otherwise(F.date_add(F.lit("2024-02-01").cast("date"),
                                          (u % 60 + F.when(v >= 150, 7).otherwise(0)).cast("int"))))
    local_time = F.when(d > 20, F.lit("19:30:00")).otherwise(F.lit("20:00:00"))
    start = F.when(u % 17 == 0, F.lit('{"dateTBD":true}')).otherwise(F.concat(
        F.lit('{"localDate":"'), local_date, F.lit('","localTime":"'), local_time,
        F.lit('","dateTime":"'), local_date, F.lit('T01:00:00Z"}')))
    genre = F.element_at(F.array(*[F.lit(g) for g in ["Rock", "Country", "Jazz", "Alternative", "Other"]]),
                         (u % 5 + 1).cast("int"))
    classifications = _opt(u % 11 != 0, F.concat(
        F.lit(',"classifications":[{"genre":{"name":"'), genre,
        F.lit('"},"subGenre":{"name":"Sub '), _s(u % 3), F.lit('"}}]')))
    p = 20 + 5 * (u % 8) + F.when(v >= 80, 10).otherwise(0)
    prices = _opt(~is_error, F.concat(
        F.lit(',"priceRanges":[{"currency":"USD","min":'), _s(p),
        F.lit(',"max":'), _s(2 * p), F.lit('.5}]')))
    venue_name = F.concat(F.lit("Venue "), _s(vn), _opt((vn % 3 == 0) & (d > 15), F.lit(" Hall")))
    location = _opt(vn % 7 != 0, F.concat(
        F.lit(',"location":{"latitude":"'), _s(30 + vn), F.lit('.25","longitude":"-'),
        _s(80 + vn), F.lit('.5"}')))
    venue = F.concat(
        F.lit('{"id":"V'), _s(vn), F.lit('","name":"'), venue_name,
        F.lit('","city":{"name":"City '), _s(vn % 7), F.lit('"},"state":{"stateCode":"S'),
        _s(vn % 7), F.lit('"},"country":{"countryCode":"US"},"address":{"line1":"'),
        _s(10 * vn), F.lit(' Main St"}'), location, F.lit("}"))
    artist_name = F.when(u % 31 == 0, F.lit("null")).otherwise(F.concat(
        F.lit('"Artist '), _s(an), _opt((an % 4 == 0) & (d > 10), F.lit(" Band")), F.lit('"')))
    attractions = _opt(u % 13 != 0, F.concat(
        F.lit(',"attractions":[{"id":"A'), _s(an), F.lit('","name":'), artist_name, F.lit("}]")))
    return F.concat(
        F.lit('{"id":"'), eid, F.lit('","name":"Show '), _s(u),
        F.lit('","url":"https://t.example/'), eid, F.lit('","dates":{"start":'), start,
        F.lit(',"status":{"code":"'), status, F.lit('"}}'),
        classifications, prices,
        F.lit(',"_embedded":{"venues":['), venue, F.lit("]"), attractions, F.lit("}}"))


def landed_feed(events: DataFrame) -> DataFrame:
    """One landed observation per ``events`` row: seq + the four raw columns."""
    return landed_keys(events).select("seq", "event_id", "fetched_city", "ingested_at",
                                      payload_expr().alias("payload"))


def raw_from_events(events: DataFrame) -> DataFrame:
    """``raw_events``: in-run dedup first (on the light columns), JSON second."""
    keys = landed_keys(events)
    winners = dedup_run(keys, ["event_id", "fetched_city", "ingested_at"], order="seq")
    return winners.select(*RAW_COLUMNS[:3], payload_expr().alias("payload"))


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw landing table of the fixture at ``sf_dir``."""
    return raw_from_events(read_table(spark, sf_dir, "events"))
