"""Key-based upsert (J5) and the incremental fact.

Plain Parquet has no row-level MERGE, so an upsert is expressed as
``target LEFT ANTI source U source``, over the buckets that the source's keys
touch (``BucketTable``); the other buckets are neither read nor written.

Incremental fact, "changed keys" mode (fixes the stale-current-row problem of
a merge that only adds newer versions, SURVEY T2/T3):

* changed keys = (event_id, fetched_city) of the batch's raw rows;
* for late rows (at or before the stored high-water mark), the keys linked
  (via their latest artist/venue) to an artist or venue in those rows are
  added, because a late row can move a dimension interval;
* every stored row of a changed key is deleted and all versions of the key
  are recomputed from raw (versions may shrink, so upsert-by-event_sk alone
  is not enough).

For in-order batches the result equals a full rebuild with the same
``as_of``: an unobserved key keeps its latest attributes, and a dimension
version opened at a new run only ever applies to fact versions starting at
or after that run, which belong to keys observed in it.

On stored tables (``State``, ``advance``) the cost follows the batch.  Two
append-only logs are kept beside the fact and the dimensions: every key's parsed
observations, by key, and a reverse index from each artist and venue to the keys
that ever named it, by id.  A late row opens its ids' buckets of the index, the
linked keys' buckets of the observations, and the buckets of the tables that
change; all tables change in one logged swap.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import HIGH_WATER_MARK_DEFAULT
from ..functions.paths import flatten
from ..sources.tables import BUCKETS, BucketLog, BucketTable, Swap, path_exists

KEYS = ["event_id", "fetched_city"]


class DuplicateKeyError(ValueError):
    pass


def _list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def assert_unique(source: DataFrame, key: str | Sequence[str]) -> None:
    """Reject a source with repeated keys (an upsert needs one row per key)."""
    key = _list(key)
    dup = source.groupBy(*key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"source has duplicate key {dup[0].asDict()}")


def merge_frames(target: DataFrame, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """J5 as a DataFrame: matched keys take the source row, new keys are inserted."""
    key = _list(key)
    keep = target.join(source.select(*key), key, "left_anti")
    return keep.unionByName(source.select(*target.columns)).select(*target.columns)


def merge_upsert(table: BucketTable, source: DataFrame, check_unique: bool = True) -> None:
    """J5 on a stored table: rewrites the buckets that the source's keys touch."""
    if check_unique:
        assert_unique(source, table.keys)
    if not table.exists():
        return table.replace_all(source)
    buckets = table.touched(source)
    return table.replace(merge_frames(table.read(buckets), source, table.keys), buckets)


def high_water_mark(fct: DataFrame) -> DataFrame:
    """``coalesce(max(valid_from), 1900-01-01)`` as a one-row frame."""
    return fct.agg(F.coalesce(F.max("valid_from"),
                              F.lit(HIGH_WATER_MARK_DEFAULT).cast("timestamp_ntz")).alias("high_water_mark"))


def changed_keys(raw: DataFrame, batch: DataFrame, stored: DataFrame | None,
                 as_of: str | dt.date | None = None) -> DataFrame:
    """Keys whose fact rows must be recomputed after ``batch`` landed in ``raw``.

    Nothing runs while the frame is built: the high-water mark is a scalar subquery.
    """
    keys = batch.select(*KEYS).distinct()
    if stored is None:
        return keys
    late = batch.where(F.col("ingested_at") <= high_water_mark(stored).scalar())
    return keys.unionByName(linked_keys(raw, late, as_of)).distinct()


def linked_keys(raw: DataFrame, late: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """Keys whose latest artist or venue occurs in the late rows."""
    from ..plans.models import stg_events  # local: models imports operators

    touched = flatten(late, ["artist_id", "venue_id"])
    attrs = stg_events(raw, as_of, fields=["artist_id", "venue_id"], keep_payload=False)
    by = [attrs.join(touched.select(c).where(F.col(c).isNotNull()).distinct(), c, "left_semi").select(*KEYS)
          for c in ("artist_id", "venue_id")]
    return by[0].unionByName(by[1])


def fct_rows_for_keys(raw: DataFrame, keys: DataFrame, as_of: str | dt.date | None = None,
                      rule: str = "documented", dims: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """All fact versions of ``keys``; histories from the keys' raw rows only,
    dimensions as given or from all raw rows."""
    from ..plans.models import (EVENT_ATTRS, dim_artists, dim_venues, fct_events, fct_events_fused,
                                stg_event_snapshots, stg_events)

    sub = raw.join(keys, KEYS, "left_semi")
    artists, venues = dims or (dim_artists(raw), dim_venues(raw))
    if rule == "documented":
        return fct_events_fused(sub, artists, venues, as_of)
    return fct_events(stg_event_snapshots(sub, rule),
                      stg_events(sub, as_of, fields=EVENT_ATTRS, keep_payload=False), artists, venues)


def fct_incremental_frame(stored: DataFrame | None, raw: DataFrame, batch: DataFrame,
                          as_of: str | dt.date | None = None, rule: str = "documented") -> DataFrame:
    """J6 as a DataFrame: the fact after ``batch`` (already part of ``raw``)."""
    keys = changed_keys(raw, batch, stored, as_of)
    fresh = fct_rows_for_keys(raw, keys, as_of, rule)
    if stored is None:
        return fresh
    kept = stored.join(keys, KEYS, "left_anti")
    return kept.unionByName(fresh.select(*stored.columns)).select(*stored.columns)


# ---- extend mode: work proportional to the batch ---------------------------------


def _extend_dim(dim: DataFrame, runs: DataFrame, key: str, sk: str, tracked, carried, rows_fn) -> DataFrame:
    from .history import scd2_extend

    current = dim.where(F.col("is_current"))
    ext = scd2_extend(current, runs, [key], "ingested_at", tracked, carried)
    replaced = current.join(runs.select(key).distinct(), key, "left_semi").select(sk)
    return dim.join(replaced, sk, "left_anti").unionByName(rows_fn(ext)).select(*dim.columns)


def extend_dims(artists: DataFrame, venues: DataFrame, typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both dimensions (or the buckets of them that the batch touches) after an in-order batch."""
    from ..plans.models import (VENUE_CARRIED, VENUE_TRACKED, artist_rows, artist_runs, venue_rows, venue_runs)

    return (_extend_dim(artists, artist_runs(typed), "artist_id", "artist_sk", ["artist_name"], [], artist_rows),
            _extend_dim(venues, venue_runs(typed), "venue_id", "venue_sk", VENUE_TRACKED, VENUE_CARRIED, venue_rows))


def extend_fact(fct: DataFrame, artists: DataFrame, venues: DataFrame, typed: DataFrame,
                as_of: str | dt.date | None = None) -> DataFrame:
    """The fact (or its touched buckets) after an in-order batch, with the dimensions already extended."""
    from ..plans.models import EVENT_ATTRS, EVENT_CARRIED, EVENT_TRACKED, fct_events, stg_events
    from .history import scd2_extend

    changed = typed.select(*KEYS).distinct()
    stored = fct.join(changed, KEYS, "left_semi")
    snap_cols = [*KEYS, "version", "valid_from", "valid_to", "is_current", *EVENT_TRACKED, *EVENT_CARRIED]
    ext = scd2_extend(stored.where(F.col("is_current")).select(*KEYS, "version", "valid_from",
                                                                *EVENT_TRACKED, *EVENT_CARRIED),
                      typed.select(*KEYS, "ingested_at", *EVENT_TRACKED, *EVENT_CARRIED),
                      KEYS, "ingested_at", EVENT_TRACKED, EVENT_CARRIED)
    hist = stored.where(~F.col("is_current")).select(*snap_cols).unionByName(ext.select(*snap_cols))
    attrs = stg_events(typed, as_of, fields=EVENT_ATTRS, keep_payload=False)
    rows = fct_events(hist, attrs, artists, venues)
    return fct.join(changed, KEYS, "left_anti").unionByName(rows.select(*fct.columns)).select(*fct.columns)


def extend_frames(fct: DataFrame, artists: DataFrame, venues: DataFrame, batch: DataFrame,
                  as_of: str | dt.date | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New (fct, dim_artists, dim_venues) after an in-order ``batch``, as frames."""
    from ..functions.paths import ALL_FIELDS

    typed = flatten(batch, ALL_FIELDS)
    artists, venues = extend_dims(artists, venues, typed)
    return extend_fact(fct, artists, venues, typed, as_of), artists, venues


LINK_SCHEMA = "kind string, id string, event_id string, fetched_city string"
LINKED_IDS = {"artist": "artist_id", "venue": "venue_id"}


def link_rows(typed: DataFrame) -> DataFrame:
    """(kind, id, key) of every artist and venue that the observations name."""
    pairs = F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(c).alias("id")) for kind, c in LINKED_IDS.items()))
    return typed.select(*KEYS, F.inline(pairs)).where(F.col("id").isNotNull()).select("kind", "id", *KEYS).distinct()


class State:
    """The stored fact, both dimensions, the logs that keep them up and the watermark, below one folder.

    One driver works on a folder at a time.
    """

    def __init__(self, spark, root: str, buckets: int = BUCKETS):
        from ..functions.paths import ALL_FIELDS, PAYLOAD_PATHS
        from ..plans.models import ARTIST_SCHEMA, FCT_SCHEMA, VENUE_SCHEMA

        self.spark, self.root = spark, root.rstrip("/")
        table = lambda name, schema, keys: BucketTable(spark, f"{self.root}/{name}", schema, keys, buckets, home=self.root)
        self.fct_events = table("fct_events", FCT_SCHEMA, KEYS)
        self.dim_artists = table("dim_artists", ARTIST_SCHEMA, ["artist_id"])
        self.dim_venues = table("dim_venues", VENUE_SCHEMA, ["venue_id"])
        fields = ", ".join(f"{f} {PAYLOAD_PATHS[f][1]}" for f in ALL_FIELDS)
        self.observed = BucketLog(spark, f"{self.root}/observed", f"event_id string, fetched_city string, ingested_at timestamp_ntz, {fields}", KEYS, buckets)
        self.links = BucketLog(spark, f"{self.root}/links", LINK_SCHEMA, ["kind", "id"], buckets)

    def watermark(self):
        """The newest run that is in the tables; None before the first one."""
        path = f"{self.root}/watermark"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            return None
        return self.spark.read.schema("watermark timestamp_ntz").parquet(path).agg(F.max("watermark")).first()[0]

    def advance_to(self, when) -> None:
        """Written last: until then a repeated step finds the old mark and does the same again."""
        frame = self.spark.range(1).select(F.lit(when).cast("timestamp_ntz").alias("watermark"))
        frame.write.mode("append").parquet(f"{self.root}/watermark")

    def remember(self, typed: DataFrame) -> None:
        """Add parsed observations, and the pairs of id and key that are new, to the logs."""
        from ..functions.paths import ALL_FIELDS

        self.observed.append(typed.select(*KEYS, "ingested_at", *ALL_FIELDS))
        pairs = link_rows(typed)
        if self.links.exists():
            pairs = pairs.join(self.links.read(self.links.touched(pairs)), ["kind", "id", *KEYS], "left_anti")
        self.links.append(pairs)

    def linked(self, ids: DataFrame) -> DataFrame:
        """Keys that ever named one of ``ids`` (kind, id)."""
        return self.links.read(self.links.touched(ids)).join(ids, ["kind", "id"], "left_semi").select(*KEYS).distinct()

    def history(self, keys: DataFrame, until) -> DataFrame:
        """All observations of ``keys`` up to a run."""
        rows = self.observed.read(self.observed.touched(keys)).where(F.col("ingested_at") <= F.lit(until).cast("timestamp_ntz"))
        return rows.join(keys, KEYS, "left_semi")


def _touched_ids(typed: DataFrame, key: str) -> DataFrame:
    return typed.select(key).where(F.col(key).isNotNull()).distinct()


def _with_staged(table: BucketTable, staged: DataFrame, buckets: list[int], wanted: DataFrame) -> DataFrame:
    """The buckets that ``wanted`` needs: staged ones where they change, else stored ones."""
    rest = set(table.touched(wanted)) - set(buckets)
    return staged.unionByName(table.read(rest)) if rest else staged


def advance(state: State, raw: DataFrame, batch: DataFrame, as_of: str | dt.date | None = None) -> str:
    """Bring the fact and both dimensions up to date after ``batch`` landed in ``raw``.

    ``raw`` and ``batch`` are observations, parsed or not; parsed ones
    (``pipeline.typed_events``) are not parsed again.  ``raw`` is read in the first
    run only.  Returns the mode used: ``full`` (first run), ``extend`` (every batch
    row is newer than everything processed), ``replay`` (late rows: the keys they
    concern are recomputed from their observations; newer rows of the batch then
    extend), or ``empty``.  Only the buckets that the batch's keys and ids touch are
    read and rewritten.  The tables of a step change together, every step gives the
    same tables when it is repeated, and the watermark moves last: a run that died
    anywhere is simply started again.
    """
    from ..functions.paths import ALL_FIELDS

    lo, hi = batch.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    if lo is None:
        return "empty"
    done = state.watermark()
    if done is None:
        _build(state, raw, as_of)
        state.remember(flatten(raw, ALL_FIELDS))
        state.advance_to(hi)
        return "full"
    typed = flatten(batch, ALL_FIELDS)
    state.remember(typed if state.observed.exists() else flatten(raw, ALL_FIELDS))
    mark = F.lit(done).cast("timestamp_ntz")
    if lo <= done:
        _replay(state, typed.where(F.col("ingested_at") <= mark), done, as_of)
    if hi > done:
        _extend(state, typed.where(F.col("ingested_at") > mark), as_of)
    state.advance_to(max(hi, done))
    return "extend" if lo > done else "replay"


def _build(state: State, raw: DataFrame, as_of) -> None:
    from ..plans.models import Models, fct_events_fused

    m = Models(raw, as_of)
    swap = Swap(state.spark, state.root)
    dims = [swap.stage(table, frame, range(table.buckets))
            for table, frame in ((state.dim_artists, m.dim_artists), (state.dim_venues, m.dim_venues))]
    swap.stage(state.fct_events, fct_events_fused(m.raw, *dims, m.as_of), range(state.fct_events.buckets))
    swap.commit()


def _extend(state: State, typed: DataFrame, as_of) -> None:
    """In-order rows: the touched buckets only, the history is not read."""
    tables = {"artist_id": state.dim_artists, "venue_id": state.dim_venues}
    swap = Swap(state.spark, state.root)
    parts = {key: table.touched(_touched_ids(typed, key)) for key, table in tables.items()}
    frames = extend_dims(*(table.read(parts[key]) for key, table in tables.items()), typed)
    dims = [swap.stage(table, frame, parts[key]) for (key, table), frame in zip(tables.items(), frames)]
    buckets = state.fct_events.touched(typed.select(*KEYS))
    stored = state.fct_events.read(buckets)
    # stored versions of a touched key may name artists and venues that the batch does not
    held = stored.join(typed.select(*KEYS).distinct(), KEYS, "left_semi")
    dims = [_with_staged(table, dim, parts[key], _touched_ids(held, key)) for (key, table), dim in zip(tables.items(), dims)]
    swap.stage(state.fct_events, extend_fact(stored, *dims, typed, as_of), buckets)
    swap.commit()


def _replay(state: State, late: DataFrame, done, as_of) -> None:
    """Late rows: the versions of their ids, then all versions of their keys and of those linked to the ids."""
    from ..plans.models import dim_artists, dim_venues, fct_events_fused

    swap = Swap(state.spark, state.root)
    keys = state.linked(link_rows(late).select("kind", "id").distinct()).unionByName(late.select(*KEYS)).distinct()
    keys = swap.keep(keys, "keys")
    rows = swap.keep(state.history(keys, done), "rows")
    dims = []
    for table, key, build in ((state.dim_artists, "artist_id", dim_artists), (state.dim_venues, "venue_id", dim_venues)):
        ids = _touched_ids(late, key)
        buckets = table.touched(ids)
        old = table.read(buckets)
        fresh = build(rows.join(ids, key, "left_semi"))  # whoever names the id is linked to it
        staged = swap.stage(table, old.join(ids, key, "left_anti").unionByName(fresh.select(*old.columns)), buckets)
        dims.append(_with_staged(table, staged, buckets, _touched_ids(rows, key)))
    buckets = state.fct_events.touched(keys)
    held = state.fct_events.read(buckets)
    fresh = fct_events_fused(rows, *dims, as_of)
    swap.stage(state.fct_events, held.join(keys, KEYS, "left_anti").unionByName(fresh.select(*held.columns)), buckets)
    swap.commit()
