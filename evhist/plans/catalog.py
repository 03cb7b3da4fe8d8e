"""Registry of every implemented query: name -> (spark, sf_dir) -> DataFrame.

All queries start from the fixture's ``events`` table through the landing feed
(``raw_feed``), so their work grows with the input; nothing runs on made-up
rows.  ``as_of`` is the fixture's run date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FIXTURE_AS_OF, MAX_PAGES_PER_CITY
from ..functions.keys import surrogate_key, ts_text
from ..functions.paths import ALL_FIELDS, flatten, flatten_variant, json_valid, variant_rows
from ..functions.dates import plausible_dates
from ..operators import quality as dq
from ..operators.history import change_flags, dedup_per_run, latest_per_key, version_numbers
from ..operators.merge import (State, advance, extend_frames, fct_incremental_frame, high_water_mark, merge_frames)
from ..operators.pit import pit_join, pit_merge
from ..operators.sketches import daily_sketches, uniques_by_city
from ..fixture.feed import landed_keys, payload_expr, raw_feed, read_table
from ..fixture.pages import pages_from_landed
from ..session import query_scratch
from ..sources.landing import cap_per_city, documents, land_pages, landed_to_raw
from . import insights as K
from .checks import CHECKS
from .models import EVENT_ATTRS, EVENT_TRACKED, KEYS, Models

SPLIT_TS = "2024-01-20 00:00:00"
LATE_DAY = "2024-01-12"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def models(spark: SparkSession, sf_dir: str, **kw) -> Models:
    return Models(raw_feed(spark, sf_dir), as_of=kw.pop("as_of", FIXTURE_AS_OF), unique=True, **kw)


def _filtered(spark, sf_dir) -> DataFrame:
    return K.dashboard_filter(models(spark, sf_dir).current)


def _filtered_daily(spark, sf_dir) -> DataFrame:
    return K.dashboard_filter(models(spark, sf_dir).fct_events_by_city)


# ---- sources ---------------------------------------------------------------

@query("raw_events")
def q_raw_events(spark, sf_dir):
    return raw_feed(spark, sf_dir)


def _landed_pages(spark, sf_dir) -> DataFrame:
    keys = landed_keys(read_table(spark, sf_dir, "events"))
    out = land_pages(pages_from_landed(keys, payload=payload_expr()))
    return out.withColumn("pos", F.col("pos").cast("long"))


@query("land_pages")
def q_land_pages(spark, sf_dir):
    return _landed_pages(spark, sf_dir)


@query("cap_per_city")
def q_cap_per_city(spark, sf_dir):
    """The request cap, asked for explicitly: ten pages of a hundred per (city, run)."""
    return cap_per_city(_landed_pages(spark, sf_dir), MAX_PAGES_PER_CITY)


@query("run_dedup")
def q_run_dedup(spark, sf_dir):
    return landed_to_raw(_landed_pages(spark, sf_dir))


@query("raw_documents")
def q_raw_documents(spark, sf_dir):
    """Typed values written as JSON documents again."""
    typed = flatten(raw_feed(spark, sf_dir), ["event_name", "event_status", "price_min", "genre"])
    return documents(typed, ["event_name", "event_status", "price_min", "genre"])


# ---- projections -------------------------------------------------------------

@query("flatten_payload")
def q_flatten(spark, sf_dir):
    return flatten(raw_feed(spark, sf_dir), ALL_FIELDS)


@query("flatten_variant")
def q_flatten_variant(spark, sf_dir):
    """The typed fields from a stored VARIANT column, parsed when it was written."""
    path = query_scratch(spark, "variant")
    variant_rows(raw_feed(spark, sf_dir)).write.parquet(path)
    return flatten_variant(spark.read.parquet(path))


@query("parse_json_strict")
def q_parse_json_strict(spark, sf_dir):
    """X7 in fail mode: a payload that is no JSON stops the query."""
    rows = variant_rows(raw_feed(spark, sf_dir), on_error="fail")
    return flatten_variant(rows, ["event_name", "event_status", "price_min"])


@query("json_valid")
def q_json_valid(spark, sf_dir):
    raw = raw_feed(spark, sf_dir)
    return raw.select("event_id", "fetched_city", "ingested_at", json_valid(F.col("payload")).alias("is_valid_json"))


@query("surrogate_key")
def q_surrogate_key(spark, sf_dir):
    raw = raw_feed(spark, sf_dir)
    return raw.select("event_id", "fetched_city", "ingested_at",
                      surrogate_key("event_id", "fetched_city", ts_text("ingested_at")).alias("observation_sk"))


# ---- filters -----------------------------------------------------------------

@query("plausible_dates")
def q_plausible(spark, sf_dir):
    typed = flatten(raw_feed(spark, sf_dir), ["event_date"])
    return plausible_dates(typed, "event_date", FIXTURE_AS_OF)


@query("current_events")
def q_current(spark, sf_dir):
    return models(spark, sf_dir).current


@query("mappable_venues")
def q_mappable(spark, sf_dir):
    return K.mappable_venues(models(spark, sf_dir).dim_venues)


@query("dashboard_filter")
def q_dashboard_filter(spark, sf_dir):
    return _filtered(spark, sf_dir)


@query("dashboard_filter_daily")
def q_dashboard_filter_daily(spark, sf_dir):
    return _filtered_daily(spark, sf_dir)


# ---- joins and merge -----------------------------------------------------------

def _with_attrs(m: Models) -> DataFrame:
    return m.snapshots.join(m.event_attrs.select(*KEYS, *EVENT_ATTRS), KEYS, "left")


@query("events_with_attrs")
def q_events_with_attrs(spark, sf_dir):
    return _with_attrs(models(spark, sf_dir))


@query("pit_join_artists")
def q_pit_artists(spark, sf_dir):
    m = models(spark, sf_dir)
    f = pit_join(_with_attrs(m), m.dim_artists, on="artist_id", columns=["artist_sk", "artist_name"])
    return f.select("event_id", "fetched_city", "version", "valid_from", "artist_id", "artist_sk", "artist_name")


@query("pit_join_venues")
def q_pit_venues(spark, sf_dir):
    m = models(spark, sf_dir)
    f = pit_join(_with_attrs(m), m.dim_venues, on="venue_id",
                 columns=["venue_sk", "venue_name", "venue_city", "venue_state_code"])
    return f.select("event_id", "fetched_city", "version", "valid_from", "venue_id", "venue_sk",
                    "venue_name", "venue_city", "venue_state_code")


@query("pit_merge_artists")
def q_pit_merge_artists(spark, sf_dir):
    """The artist join in one pass: facts and versions sorted together."""
    m = models(spark, sf_dir)
    f = pit_merge(_with_attrs(m), m.dim_artists, on="artist_id", columns=["artist_sk", "artist_name"])
    return f.select("event_id", "fetched_city", "version", "valid_from", "artist_id", "artist_sk", "artist_name")


@query("pit_merge_venues")
def q_pit_merge_venues(spark, sf_dir):
    m = models(spark, sf_dir)
    f = pit_merge(_with_attrs(m), m.dim_venues, on="venue_id",
                  columns=["venue_sk", "venue_name", "venue_city", "venue_state_code"])
    return f.select("event_id", "fetched_city", "version", "valid_from", "venue_id", "venue_sk",
                    "venue_name", "venue_city", "venue_state_code")


@query("venue_map")
def q_venue_map(spark, sf_dir):
    m = models(spark, sf_dir)
    return K.venue_map(m.dim_venues, K.dashboard_filter(m.current))


def _split(spark, sf_dir):
    raw = raw_feed(spark, sf_dir)
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    before = Models(raw.where(F.col("ingested_at") < split), as_of=FIXTURE_AS_OF, unique=True)
    return raw, raw.where(F.col("ingested_at") >= split), before.fct_events


@query("merge_upsert")
def q_merge_upsert(spark, sf_dir):
    """Append-style merge of newer versions by event_sk (the reference's mode)."""
    raw, _, stored = _split(spark, sf_dir)
    full = Models(raw, as_of=FIXTURE_AS_OF, unique=True).fct_events
    newer = full.where(F.col("valid_from") > high_water_mark(stored).scalar())
    return merge_frames(stored, newer, "event_sk")


@query("fct_incremental")
def q_fct_incremental(spark, sf_dir):
    """Changed-key incremental fact; equals the full rebuild."""
    raw, batch, stored = _split(spark, sf_dir)
    return fct_incremental_frame(stored, raw, batch, FIXTURE_AS_OF)


@query("fct_extend")
def q_fct_extend(spark, sf_dir):
    """Extend-mode incremental fact (stored fact + dims + in-order batch); equals the full rebuild."""
    raw = raw_feed(spark, sf_dir)
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    before = Models(raw.where(F.col("ingested_at") < split), as_of=FIXTURE_AS_OF, unique=True)
    fct, _, _ = extend_frames(before.fct_events, before.dim_artists, before.dim_venues,
                              raw.where(F.col("ingested_at") >= split), FIXTURE_AS_OF)
    return fct


@query("fct_late_day")
def q_fct_late_day(spark, sf_dir):
    """Stored tables that got one day's rows last: by the reverse index and the swapped
    buckets the fact equals the full rebuild."""
    raw = raw_feed(spark, sf_dir)
    late = F.to_date("ingested_at") == F.lit(LATE_DAY).cast("date")
    state = State(spark, query_scratch(spark, "late-day"))
    advance(state, raw.where(~late), raw.where(~late), FIXTURE_AS_OF)
    advance(state, raw, raw.where(late), FIXTURE_AS_OF)
    return state.fct_events.read()


# ---- aggregations ----------------------------------------------------------------

@query("fct_events_by_city")
def q_by_city(spark, sf_dir):
    return models(spark, sf_dir).fct_events_by_city


@query("events_by_city")
def q_events_by_city(spark, sf_dir):
    return K.events_by_city(_filtered(spark, sf_dir))


@query("uniques_by_city")
def q_uniques_by_city(spark, sf_dir):
    """Distinct artists and venues per city, rolled up from the daily sketches."""
    return uniques_by_city(daily_sketches(models(spark, sf_dir).fct_events))


@query("top_genres")
def q_top_genres(spark, sf_dir):
    return K.top_genres(_filtered(spark, sf_dir))


@query("events_over_time")
def q_events_over_time(spark, sf_dir):
    return K.events_over_time(_filtered_daily(spark, sf_dir), FIXTURE_AS_OF)


@query("kpis")
def q_kpis(spark, sf_dir):
    return K.kpis(_filtered(spark, sf_dir))


@query("kpi_display")
def q_kpi_display(spark, sf_dir):
    """The KPI row with its average price as shown, ``$x.xx`` or ``N/A``."""
    return K.kpi_display(K.kpis(_filtered(spark, sf_dir)))


@query("price_distribution")
def q_price_distribution(spark, sf_dir):
    return K.price_distribution(_filtered(spark, sf_dir))


@query("high_water_mark")
def q_hwm(spark, sf_dir):
    return high_water_mark(models(spark, sf_dir).fct_events)


@query("filter_values")
def q_filter_values(spark, sf_dir):
    return K.filter_values(models(spark, sf_dir).current)


@query("date_bounds")
def q_date_bounds(spark, sf_dir):
    return K.date_bounds(models(spark, sf_dir).current)


# ---- windows ------------------------------------------------------------------------

@query("latest_per_key")
def q_latest(spark, sf_dir):
    return latest_per_key(raw_feed(spark, sf_dir), KEYS, "ingested_at")


@query("dedup_per_run")
def q_dedup_per_run(spark, sf_dir):
    src = flatten(raw_feed(spark, sf_dir), ["artist_id", "artist_name"]) \
        .where(F.col("artist_id").isNotNull() & F.col("artist_name").isNotNull())
    return dedup_per_run(src.select("artist_id", "ingested_at", "event_id", "fetched_city", "artist_name"),
                         ["artist_id"], "ingested_at", ["event_id", "fetched_city"])


def _flags(spark, sf_dir) -> DataFrame:
    typed = flatten(raw_feed(spark, sf_dir), EVENT_TRACKED)
    return change_flags(typed, KEYS, "ingested_at", EVENT_TRACKED)


@query("change_flags")
def q_change_flags(spark, sf_dir):
    return _flags(spark, sf_dir).select(*KEYS, "ingested_at", "is_new_version")


@query("version_numbers")
def q_version_numbers(spark, sf_dir):
    return version_numbers(_flags(spark, sf_dir), KEYS, "ingested_at") \
        .select(*KEYS, "ingested_at", "is_new_version", "version")


# ---- sort / limit ---------------------------------------------------------------------

@query("upcoming_events")
def q_upcoming(spark, sf_dir):
    return K.upcoming_events(_filtered(spark, sf_dir))


@query("upcoming_counts")
def q_upcoming_counts(spark, sf_dir):
    return K.upcoming_counts(_filtered(spark, sf_dir))


# ---- models -------------------------------------------------------------------------------

@query("stg_events")
def q_stg_events(spark, sf_dir):
    return models(spark, sf_dir).stg_events


@query("stg_event_snapshots")
def q_snapshots(spark, sf_dir):
    return models(spark, sf_dir).snapshots


@query("stg_event_snapshots_literal")
def q_snapshots_literal(spark, sf_dir):
    return models(spark, sf_dir, rule="literal").snapshots


@query("dim_artists")
def q_dim_artists(spark, sf_dir):
    return models(spark, sf_dir).dim_artists


@query("dim_venues")
def q_dim_venues(spark, sf_dir):
    return models(spark, sf_dir).dim_venues


@query("fct_events")
def q_fct_events(spark, sf_dir):
    return models(spark, sf_dir).fct_events


# ---- findings --------------------------------------------------------------------------------

@query("city_share")
def q_city_share(spark, sf_dir):
    return K.city_share(_filtered(spark, sf_dir))


@query("top_genre_per_city")
def q_top_genre_per_city(spark, sf_dir):
    return K.top_genre_per_city(_filtered(spark, sf_dir))


@query("city_price_rank")
def q_city_price_rank(spark, sf_dir):
    return K.city_price_rank(_filtered(spark, sf_dir))


@query("price_changes")
def q_price_changes(spark, sf_dir):
    return K.price_changes(models(spark, sf_dir).snapshots)


# ---- data checks ------------------------------------------------------------------------------

def model_tables(m: Models) -> dict[str, DataFrame]:
    return {"raw_events": m.raw, "stg_events": m.stg_events, "stg_event_snapshots": m.snapshots,
            "dim_artists": m.dim_artists, "dim_venues": m.dim_venues, "fct_events": m.fct_events}


@query("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    t = model_tables(models(spark, sf_dir))
    parts = {}
    for c in CHECKS:
        if c.test == "not_null":
            parts.setdefault(c.model, []).append(c.column)
    out = None
    for model, cols in parts.items():
        r = dq.dq_not_null(t[model], cols, model)
        out = r if out is None else out.unionByName(r)
    return out


@query("dq_unique")
def q_dq_unique(spark, sf_dir):
    t = model_tables(models(spark, sf_dir))
    out = None
    for c in CHECKS:
        if c.test == "unique":
            r = dq.dq_unique(t[c.model], c.column, c.model)
            out = r if out is None else out.unionByName(r)
    return out


@query("dq_accepted_values")
def q_dq_accepted(spark, sf_dir):
    m = models(spark, sf_dir)
    c = next(c for c in CHECKS if c.test == "accepted_values")
    return dq.dq_accepted_values(m.fct_events, c.column, c.values, c.model)


@query("dq_report")
def q_dq_report(spark, sf_dir):
    return dq.dq_report(model_tables(models(spark, sf_dir)), CHECKS)


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
