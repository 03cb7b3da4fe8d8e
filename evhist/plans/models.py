"""The six models (M1-M6) as DataFrame functions.

raw -> {stg_events, stg_event_snapshots, dim_artists, dim_venues}
    -> fct_events -> fct_events_by_city
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import is_plausible, plausible_dates
from ..functions.keys import surrogate_key, ts_text
from ..functions.paths import ALL_FIELDS, flatten
from ..operators.history import dedup_per_run, latest_per_key, scd2, scd2_segmented
from ..operators.pit import pit_join

KEYS = ["event_id", "fetched_city"]

EVENT_TRACKED = ["event_status", "event_date", "event_time", "price_min", "price_max"]
EVENT_CARRIED = ["price_currency"]
VENUE_TRACKED = ["venue_name", "venue_city", "venue_state_code", "venue_address"]
VENUE_CARRIED = ["venue_country_code", "venue_latitude", "venue_longitude"]
EVENT_ATTRS = ["event_name", "event_url", "event_datetime_utc", "genre", "sub_genre",
               "venue_id", "artist_id"]

# FIXED VALUES: output columns of the models, and their types where they are stored.
STG_EVENTS_COLUMNS = ["event_id", "fetched_city", "ingested_at", *ALL_FIELDS, "payload"]

FCT_COLUMNS = [
    "event_sk", "artist_sk", "venue_sk", "event_id", "artist_id", "venue_id",
    "fetched_city", "version", "valid_from", "valid_to", "is_current",
    "event_status", "event_date", "event_time", "price_min", "price_max", "price_currency",
    "event_name", "event_url", "event_datetime_utc", "genre", "sub_genre",
    "artist_name", "venue_name", "venue_city", "venue_state_code",
]
_TYPES = {"version": "bigint", "valid_from": "timestamp_ntz", "valid_to": "timestamp_ntz", "is_current": "boolean",
          "event_date": "date", "price_min": "double", "price_max": "double", "event_datetime_utc": "timestamp_ntz",
          "venue_latitude": "double", "venue_longitude": "double"}


def _schema(names: list[str]) -> str:
    return ", ".join(f"{n} {_TYPES.get(n, 'string')}" for n in names)


FCT_SCHEMA = _schema(FCT_COLUMNS)
ARTIST_SCHEMA = _schema(["artist_sk", "artist_id", "artist_name", "valid_from", "valid_to", "is_current"])
VENUE_SCHEMA = _schema(["venue_sk", "venue_id", *VENUE_TRACKED[:3], "venue_country_code", "venue_address",
                        "venue_latitude", "venue_longitude", "valid_from", "valid_to", "is_current"])


def stg_events(raw: DataFrame, as_of: str | dt.date | None = None, on_error: str = "null",
               fields: list[str] | None = None, keep_payload: bool = True) -> DataFrame:
    """M1: latest observation per (event_id, fetched_city), flattened, plausible dates.

    Dedup runs before parsing, so only the surviving document of each key is
    parsed.  ``fields`` trims the parse to the columns a consumer needs.
    """
    latest = latest_per_key(raw, KEYS, "ingested_at")
    fields = list(fields or ALL_FIELDS)
    if "event_date" not in fields:
        fields.append("event_date")
    typed = flatten(latest, fields, on_error, keep_payload=keep_payload)
    return plausible_dates(typed, "event_date", as_of)


def stg_event_snapshots(raw: DataFrame, rule: str = "documented", on_error: str = "null",
                        segment: Column | None = None, unique: bool = False) -> DataFrame:
    """M2: event history.  ``rule="literal"`` reproduces the reference SQL.

    ``unique``: ``raw`` has one row per key and run (``one_per_run``, ``dedup_run``).

    ``segment`` (documented rule only), e.g. ``date_trunc('month', ingested_at)``,
    splits each key's window into per-segment tasks for keys too hot for one task.
    """
    typed = flatten(raw, EVENT_TRACKED + EVENT_CARRIED, on_error)
    if segment is not None and rule != "documented":
        raise ValueError("a segmented history follows the documented rule only")
    if segment is not None:
        return scd2_segmented(typed, KEYS, "ingested_at", EVENT_TRACKED, EVENT_CARRIED, segment)
    if rule == "documented":
        return scd2(typed, KEYS, "ingested_at", EVENT_TRACKED, EVENT_CARRIED, unique=unique)
    if rule == "literal":
        return scd2(typed, KEYS, "ingested_at", EVENT_TRACKED, EVENT_CARRIED,
                    valid_to="next_observation", first_version="literal", unique=unique)
    raise ValueError(f"unknown rule {rule!r}")


ARTIST_RUN_COLUMNS = ["artist_id", "ingested_at", "artist_name"]
VENUE_RUN_COLUMNS = ["venue_id", "ingested_at", *VENUE_TRACKED, *VENUE_CARRIED]


def artist_runs(raw: DataFrame, on_error: str = "null") -> DataFrame:
    """One artist observation per (artist_id, run): JSON-null ids/names count
    as missing (T8), ties go to the smallest (event_id, fetched_city) (T7)."""
    src = (flatten(raw, ["artist_id", "artist_name"], on_error)
           .where(F.col("artist_id").isNotNull() & F.col("artist_name").isNotNull()))
    per_run = dedup_per_run(src.select("artist_id", "ingested_at", "event_id", "fetched_city", "artist_name"),
                            ["artist_id"], "ingested_at", tiebreak=["event_id", "fetched_city"])
    return per_run.select(*ARTIST_RUN_COLUMNS)


def venue_runs(raw: DataFrame, on_error: str = "null") -> DataFrame:
    """One venue observation per (venue_id, run), same tie-break."""
    cols = ["venue_id", *VENUE_TRACKED, *VENUE_CARRIED]
    src = flatten(raw, cols, on_error).where(F.col("venue_id").isNotNull())
    per_run = dedup_per_run(src.select("venue_id", "ingested_at", "event_id", "fetched_city", *cols[1:]),
                            ["venue_id"], "ingested_at", tiebreak=["event_id", "fetched_city"])
    return per_run.select(*VENUE_RUN_COLUMNS)


def artist_rows(hist: DataFrame) -> DataFrame:
    return hist.select(surrogate_key("artist_id", ts_text("valid_from")).alias("artist_sk"),
                       "artist_id", "artist_name", "valid_from", "valid_to", "is_current")


def venue_rows(hist: DataFrame) -> DataFrame:
    return hist.select(surrogate_key("venue_id", ts_text("valid_from")).alias("venue_sk"),
                       "venue_id", *VENUE_TRACKED[:3], "venue_country_code", "venue_address",
                       "venue_latitude", "venue_longitude", "valid_from", "valid_to", "is_current")


def dim_artists(raw: DataFrame, on_error: str = "null") -> DataFrame:
    """M3: artist history (tracked: name)."""
    return artist_rows(scd2(artist_runs(raw, on_error), ["artist_id"], "ingested_at", ["artist_name"], unique=True))


def dim_venues(raw: DataFrame, on_error: str = "null") -> DataFrame:
    """M4: venue history; tracked name/city/state/address, carried country/lat/lon."""
    return venue_rows(scd2(venue_runs(raw, on_error), ["venue_id"], "ingested_at",
                           VENUE_TRACKED, VENUE_CARRIED, unique=True))


def fct_events(snapshots: DataFrame, stg: DataFrame, artists: DataFrame, venues: DataFrame) -> DataFrame:
    """M5: every event version with latest static attributes and PIT dimension keys.

    ``stg`` and ``snapshots`` are both hash-partitioned on (event_id,
    fetched_city) by their windows, so the attribute join needs no new shuffle.
    """
    attrs = stg.select(*KEYS, *EVENT_ATTRS)
    return _attach_dims(snapshots.join(attrs, KEYS, "left"), artists, venues)


def _attach_dims(f: DataFrame, artists: DataFrame, venues: DataFrame) -> DataFrame:
    f = pit_join(f, artists, on="artist_id", columns=["artist_sk", "artist_name"])
    f = pit_join(f, venues, on="venue_id",
                 columns=["venue_sk", "venue_name", "venue_city", "venue_state_code"])
    f = f.withColumn("event_sk", surrogate_key("event_id", "fetched_city", "version"))
    return f.select(*FCT_COLUMNS)


def fct_events_fused(raw: DataFrame, artists: DataFrame, venues: DataFrame,
                     as_of: str | dt.date | None = None, on_error: str = "null", unique: bool = False) -> DataFrame:
    """M5 in one pass over the observations: the history window also carries
    each key's latest static attributes (``scd2(latest=...)``), so the fact
    needs neither a separate latest-per-key shuffle nor the attribute join.
    Same rows as ``fct_events(stg_event_snapshots, stg_events, ...)``: the
    attributes are NULL when the latest observation's date is implausible,
    exactly as the left join against the filtered ``stg_events`` gives."""
    typed = flatten(raw, [*EVENT_TRACKED, *EVENT_CARRIED, *EVENT_ATTRS], on_error)
    hist = scd2(typed, KEYS, "ingested_at", EVENT_TRACKED, EVENT_CARRIED,
                latest=[*EVENT_ATTRS, "event_date"], unique=unique)
    plausible = is_plausible("latest_event_date", as_of)
    f = hist.select(*KEYS, "version", "valid_from", "valid_to", "is_current", *EVENT_TRACKED, *EVENT_CARRIED,
                    *[F.when(plausible, F.col(f"latest_{c}")).alias(c) for c in EVENT_ATTRS])
    return _attach_dims(f, artists, venues)


FCT_PARTITIONS = ["is_current"]


def fct_layout(fct: DataFrame) -> DataFrame:
    """Write layout of the fact: partitioned by ``is_current`` (every dashboard
    query reads current versions only, so it prunes to one folder), rows of a
    file clustered by city and date so Parquet row-group statistics skip the
    rest of a filtered read."""
    return fct.sortWithinPartitions("is_current", "fetched_city", "event_date")


def fct_from_files(df: DataFrame) -> DataFrame:
    """A fact read back from ``FCT_PARTITIONS`` folders: partition discovery
    yields ``is_current`` as text, so cast it back (pruning still applies)
    and restore the model's column order."""
    return df.withColumn("is_current", F.col("is_current").cast("boolean")).select(*FCT_COLUMNS)


def read_fct(spark, path: str) -> DataFrame:
    """Read a fact written with ``FCT_PARTITIONS``."""
    return fct_from_files(spark.read.parquet(path))


def fct_events_by_city(fct: DataFrame, approx: bool = False) -> DataFrame:
    """M6: current versions with a date, by city x date x genre (NULL genre is a group).

    ``approx=True`` swaps the two exact distinct counts (planned with an
    Expand) for HyperLogLog sketches that aggregate map-side.
    """
    distinct = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(F.col(c)))
    return (fct.where(F.col("event_date").isNotNull() & F.col("is_current"))
            .groupBy("fetched_city", "event_date", "genre")
            .agg(F.count(F.lit(1)).alias("total_events"),
                 distinct("artist_id").alias("unique_artists"),
                 distinct("venue_id").alias("unique_venues"),
                 F.min("price_min").alias("min_ticket_price"),
                 F.max("price_max").alias("max_ticket_price"),
                 F.avg((F.col("price_min") + F.col("price_max")) / F.lit(2.0)).alias("avg_ticket_price")))


@dataclass
class Models:
    """Lazily wired model graph over one raw DataFrame (no runner needed)."""

    raw: DataFrame
    as_of: str | dt.date | None = None
    rule: str = "documented"
    segment: Column | None = None
    unique: bool = False  # raw has one row per key and run

    @cached_property
    def stg_events(self) -> DataFrame:
        return stg_events(self.raw, self.as_of)

    @cached_property
    def event_attrs(self) -> DataFrame:
        return stg_events(self.raw, self.as_of, fields=EVENT_ATTRS, keep_payload=False)

    @cached_property
    def snapshots(self) -> DataFrame:
        return stg_event_snapshots(self.raw, self.rule, segment=self.segment, unique=self.unique)

    @cached_property
    def dim_artists(self) -> DataFrame:
        return dim_artists(self.raw)

    @cached_property
    def dim_venues(self) -> DataFrame:
        return dim_venues(self.raw)

    @cached_property
    def fct_events(self) -> DataFrame:
        if self.rule == "documented" and self.segment is None:
            # one window pass carries the latest attributes: no stg shuffle, no join
            return fct_events_fused(self.raw, self.dim_artists, self.dim_venues, self.as_of, unique=self.unique)
        return fct_events(self.snapshots, self.event_attrs, self.dim_artists, self.dim_venues)

    @cached_property
    def fct_events_by_city(self) -> DataFrame:
        return fct_events_by_city(self.fct_events)

    @cached_property
    def current(self) -> DataFrame:
        """current fact rows."""
        return self.fct_events.where(F.col("is_current"))
