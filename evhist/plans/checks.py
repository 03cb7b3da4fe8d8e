"""The data tests of the six models and the raw table (Q1-Q3), as data."""

from __future__ import annotations

from ..constants import ACCEPTED_STATUSES
from ..operators import quality as dq

CHECKS = [
    *[dq.Check("raw_events", "not_null", c) for c in ["event_id", "fetched_city", "ingested_at", "payload"]],
    *[dq.Check("stg_events", "not_null", c) for c in ["event_id", "fetched_city", "event_name"]],
    *[dq.Check("stg_event_snapshots", "not_null", c)
      for c in ["event_id", "fetched_city", "version", "valid_from", "is_current"]],
    *[dq.Check("dim_artists", "not_null", c) for c in ["artist_sk", "artist_id", "artist_name"]],
    *[dq.Check("dim_venues", "not_null", c) for c in ["venue_sk", "venue_id", "venue_name"]],
    *[dq.Check("fct_events", "not_null", c) for c in ["event_sk", "event_id"]],
    dq.Check("stg_events", "unique", "event_id || '|' || fetched_city"),
    dq.Check("dim_artists", "unique", "artist_sk"),
    dq.Check("dim_venues", "unique", "venue_sk"),
    dq.Check("fct_events", "unique", "event_sk"),
    dq.Check("fct_events", "accepted_values", "event_status", severity="warn",
             values=tuple(ACCEPTED_STATUSES)),
]
