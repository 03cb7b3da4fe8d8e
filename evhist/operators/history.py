"""Latest-wins dedup and SCD type 2 histories.

All windows of one history share one partitioning (the natural key) and one
ordering (observation time), so Spark plans a single Exchange + Sort for the
lag, running sum, version filter and lead.

Group sizes: every history runs after a per-(key, run) dedup, so a key never
holds more rows than there are runs, however hot the key is in the raw data.
The dedup itself is an aggregate with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.landing import dedup_run

__all__ = ["latest_per_key", "dedup_per_run", "change_flags", "version_numbers", "scd2", "scd2_extend",
           "scd2_segmented"]


def _list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per ``keys``.

    ``row_number() = 1`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle, so each map task forwards at most one row per key.
    """
    order = _list(order)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_per_run(df: DataFrame, keys: Sequence[str], run: str,
                  tiebreak: Sequence[str]) -> DataFrame:
    """One row per (keys, run); the smallest ``tiebreak`` wins."""
    return dedup_run(df, [*keys, run], order=list(tiebreak), drop_null_keys=False)


def _window(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def _changed(tracked: Sequence[str], w) -> Column:
    """Null-safe 'differs from the previous observation' over tracked columns."""
    diffs = [~F.lag(c).over(w).eqNullSafe(F.col(c)) for c in tracked]
    return reduce(lambda a, b: a | b, diffs)


def change_flags(df: DataFrame, keys: Sequence[str], order: str | Sequence[str],
                 tracked: Sequence[str], first_version: str = "always") -> DataFrame:
    """``is_new_version`` = 1 when a tracked value differs from the previous row.

    ``first_version="always"`` starts every key at 1 (documented contract);
    ``"literal"`` follows the reference SQL, where a first row whose tracked
    values are all NULL gets 0 (T4).
    """
    order = _list(order)
    w = _window(keys, order)
    changed = _changed(tracked, w)
    if first_version == "always":
        changed = changed | F.lag(order[0]).over(w).isNull()
    return df.withColumn("is_new_version", F.when(changed, 1).otherwise(0))


def version_numbers(df: DataFrame, keys: Sequence[str], order: str | Sequence[str],
                    flag: str = "is_new_version") -> DataFrame:
    """Running sum of the change flag (ROWS UNBOUNDED PRECEDING)."""
    w = _window(keys, _list(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("version", F.sum(flag).over(w).cast("long"))


def scd2(df: DataFrame, keys: Sequence[str], order: str | Sequence[str],
         tracked: Sequence[str], carried: Sequence[str] = (),
         valid_to: str = "next_version", first_version: str = "always",
         latest: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """A type-2 history, one row per (keys, version).

    ``valid_from`` is the first observation of a version; ``valid_to`` is the
    start of the next *version* (``"next_version"``, documented) or the next
    *observation* (``"next_observation"``, the reference SQL's literal result,
    T1).  ``is_current`` = ``valid_to IS NULL``.  Tracked and carried columns
    come from the version's first observation.
    Rows of one key and observation time are one observation, whatever landed
    twice: the least by tracked and carried values counts.  ``unique`` says that the
    caller's rows are one per key and time already, which saves a window.
    ``latest`` columns are attached to every version with their value from the
    key's *latest* observation (``last`` over the key's whole frame — same
    window, no extra shuffle), output as ``latest_<name>``.
    Output: keys, version, valid_from, valid_to, is_current, tracked, carried[, latest_*].
    """
    keys, order = list(keys), _list(order)
    ts = order[0]
    w = _window(keys, order)
    # ties: sorted on the same keys first, so the windows below need no other sort
    if not unique:
        tied = _window(keys, [*order, *tracked, *carried, *latest])
        df = df.withColumn("_again", F.lag(ts).over(tied).eqNullSafe(F.col(ts)) & F.col(ts).isNotNull())
        df = df.where(~F.coalesce("_again", F.lit(False))).drop("_again")
    if latest:
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        df = df.withColumns({f"latest_{c}": F.last(c).over(whole) for c in latest})
    flagged = change_flags(df, keys, order, tracked, first_version)
    versioned = version_numbers(flagged, keys, order)
    # First row per version.  With the flag this is one filter, not a
    # second row_number() sort; the lag test keeps a literal version 0.
    starts_cond = (F.col("is_new_version") == 1) | F.lag(ts).over(w).isNull()
    with_next = versioned.withColumn("_next_obs", F.lead(ts).over(w)).withColumn("_start", starts_cond)
    starts = with_next.where(F.col("_start"))
    if valid_to == "next_version":
        starts = starts.withColumn("valid_to", F.lead(ts).over(w))
    elif valid_to == "next_observation":
        starts = starts.withColumn("valid_to", F.col("_next_obs"))
    else:
        raise ValueError(f"valid_to must be next_version or next_observation, not {valid_to!r}")
    return starts.select(*keys, "version", F.col(ts).alias("valid_from"), "valid_to",
                         F.col("valid_to").isNull().alias("is_current"),
                         *tracked, *carried, *[f"latest_{c}" for c in latest])


def scd2_extend(current: DataFrame, new_obs: DataFrame, keys: Sequence[str], order: str,
                tracked: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    """Extend a (documented-rule) history with observations newer than every
    stored observation of their key.

    ``current``: the stored current version per key (keys, valid_from,
    [version], tracked, carried).  ``new_obs``: (keys, order, tracked, carried).
    The stored current row is the anchor: it is the first row of its key, the
    first new observation is compared with it, and version numbers continue
    from it.  Returns the rows that replace the anchors — the anchor with its
    new ``valid_to``/``is_current`` and every new version — in ``scd2``'s
    layout.  Work is proportional to the batch, not to the stored history.
    """
    keys = list(keys)
    version = F.col("version") if "version" in current.columns else F.lit(0).cast("long")
    anchors = (current.join(new_obs.select(*keys).distinct(), keys, "left_semi")
               .select(*keys, F.col("valid_from").alias(order), version.cast("long").alias("version"),
                       *tracked, *carried, F.lit(True).alias("_anchor")))
    # a repeated batch meets its own result: what an anchor already covers is left out
    known = anchors.select(*keys, F.col(order).alias("_from"))
    new_obs = (new_obs.dropDuplicates([*keys, order]).join(known, keys, "left")
               .where(F.col("_from").isNull() | (F.col(order) > F.col("_from"))).drop("_from"))
    obs = new_obs.select(*keys, order, F.lit(None).cast("long").alias("version"),
                         *tracked, *carried, F.lit(False).alias("_anchor"))
    w = _window(keys, [order])
    changed = _changed(tracked, w) | F.lag(order).over(w).isNull()
    flag = F.when(F.col("_anchor"), 0).when(changed, 1).otherwise(0)
    base = F.coalesce(F.first("version").over(w), F.lit(0).cast("long"))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (anchors.unionByName(obs)
            .withColumn("_flag", flag)
            .withColumn("version", (base + F.sum("_flag").over(run)).cast("long"))
            .where(F.col("_anchor") | (F.col("_flag") == 1))
            .withColumn("valid_to", F.lead(order).over(w)))
    return rows.select(*keys, "version", F.col(order).alias("valid_from"), "valid_to",
                       F.col("valid_to").isNull().alias("is_current"), *tracked, *carried)


def scd2_segmented(df: DataFrame, keys: Sequence[str], order: str, tracked: Sequence[str],
                   carried: Sequence[str] = (), segment: Column | None = None) -> DataFrame:
    """``scd2`` (documented rule) for keys too hot for one task.

    Rows are windowed per (key, segment) — ``segment`` is a value that never
    decreases with ``order``, e.g. the month of the observation — so one key's
    rows spread over as many tasks as it has segments.  Per segment, one
    aggregate row summarises what the next segment needs (first and last
    tracked values, local change count, first local change); a window over
    these summaries (one row per key and segment) carries the state across
    segments: whether a segment's first row starts a version, how many
    versions precede it, and where the next version starts.  The summaries
    are repartitioned like the rows, so joining them back does not move the
    rows again.  Same output as ``scd2``.
    """
    keys = list(keys)
    seg = segment if segment is not None else F.date_trunc("month", F.col(order))
    rows = df.withColumn("_seg", seg)
    w1 = Window.partitionBy(*keys, "_seg").orderBy(order)
    local = (rows.withColumn("_first", F.lag(order).over(w1).isNull())
                 .withColumn("_chg", F.when(F.col("_first"), F.lit(False)).otherwise(_changed(tracked, w1))))
    tracked_struct = F.struct(*[F.col(c) for c in tracked])
    summary = (local.groupBy(*keys, "_seg")
               .agg(F.min(order).alias("_seg_first_ts"),
                    F.min_by(tracked_struct, F.col(order)).alias("_seg_first"),
                    F.max_by(tracked_struct, F.col(order)).alias("_seg_last"),
                    F.count_if("_chg").alias("_seg_changes"),
                    F.min(F.when(F.col("_chg"), F.col(order))).alias("_seg_first_change")))
    w2 = Window.partitionBy(*keys).orderBy("_seg")
    prev = F.lag("_seg_last").over(w2)
    differs = reduce(lambda a, b: a | b,
                     [~prev.getField(c).eqNullSafe(F.col("_seg_first").getField(c)) for c in tracked])
    first_flag = F.when(F.lag("_seg").over(w2).isNull() | differs, 1).otherwise(0)
    carried_state = (summary.withColumn("_first_flag", first_flag)
                     .withColumn("_seg_flags", F.col("_first_flag") + F.col("_seg_changes"))
                     .withColumn("_before", F.coalesce(F.sum("_seg_flags").over(
                         w2.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))
                     .withColumn("_seg_first_start", F.when(F.col("_first_flag") == 1, F.col("_seg_first_ts"))
                                 .otherwise(F.col("_seg_first_change")))
                     .withColumn("_next_start", F.first("_seg_first_start", ignorenulls=True).over(
                         w2.rowsBetween(1, Window.unboundedFollowing)))
                     .select(*keys, "_seg", "_first_flag", "_before", "_next_start"))
    carried_state = carried_state.repartition(*[F.col(k) for k in keys], F.col("_seg"))
    joined = local.join(carried_state, [*keys, "_seg"])
    flag = F.when(F.col("_first"), F.col("_first_flag")).otherwise(F.col("_chg").cast("int"))
    run = w1.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = (joined.withColumn("_flag", flag)
              .withColumn("version", (F.col("_before") + F.sum("_flag").over(run)).cast("long"))
              .where(F.col("_flag") == 1)
              .withColumn("valid_to", F.coalesce(F.lead(order).over(w1), F.col("_next_start"))))
    return starts.select(*keys, "version", F.col(order).alias("valid_from"), "valid_to",
                         F.col("valid_to").isNull().alias("is_current"), *tracked, *carried)
