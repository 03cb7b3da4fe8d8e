"""Point-in-time join of facts to a type-2 history.

A fact row at time ``t`` matches the history version of its key with
``valid_from <= t < valid_to`` (``valid_to`` NULL = open).  Written as an equi
join on the key plus a range residual, so Spark plans a hash or sort-merge
join on the key, never a nested loop.  Work per fact row is bounded by the
versions of its key (itself bounded by the number of runs).

No hint is given: AQE measures the history's shuffle output and broadcasts it
only below ``spark.sql.adaptive.autoBroadcastJoinThreshold``.  In a sort-merge
join AQE's skew-join split handles a hot key on the fact side (left outer
joins may split their left side), and facts without a key, which match
nothing, are spread over all reducers instead of meeting in one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _spread(facts: DataFrame, on: str) -> Column:
    """The key, or for facts without one a key of their own that matches nothing."""
    if dict(facts.dtypes)[on] != "string":
        return facts[on]
    # two code points that no key starts with, then the row's hash: never equal to a key
    return F.coalesce(facts[on], F.concat(F.lit("\x00\x00"), F.xxhash64(*[facts[c] for c in facts.columns]).cast("string")))


def pit_join(facts: DataFrame, history: DataFrame, on: str, ts: str = "valid_from",
             columns: Sequence[str] = (), how: str = "left",
             history_on: str | None = None) -> DataFrame:
    """Attach ``columns`` of the history version valid at ``facts[ts]``.

    ``on`` names the key in ``facts``; ``history_on`` in ``history`` (default
    the same name).  History columns are renamed internally, so names such as
    ``valid_from`` may exist on both sides.
    """
    history_on = history_on or on
    h = history.select(F.col(history_on).alias("_pit_key"),
                       F.col("valid_from").alias("_pit_from"),
                       F.col("valid_to").alias("_pit_to"),
                       *[F.col(c).alias(f"_pit_{c}") for c in columns])
    t, key = facts[ts], _spread(facts, on)
    cond = (key == h["_pit_key"]) & (t >= h["_pit_from"]) & (h["_pit_to"].isNull() | (t < h["_pit_to"]))
    joined = facts.join(h, cond, how)
    return joined.select(*[facts[c] for c in facts.columns],
                         *[F.col(f"_pit_{c}").alias(c) for c in columns])


def pit_merge(facts: DataFrame, history: DataFrame, on: str, ts: str = "valid_from", columns: Sequence[str] = (),
              history_on: str | None = None, segment: str = "month") -> DataFrame:
    """``pit_join`` (left) in one pass, for keys with very many versions.

    Facts and versions are put into one table and sorted by key and time; each fact
    takes the last version started at or before it, if that is still valid.  So a
    key costs its facts plus its versions, where the join compares each fact with all
    versions.  A hot key is split by ``segment`` of time (a unit of ``date_trunc``): the
    last version of each segment, one row per key and segment, is carried into the
    following ones.  The versions of a key must not overlap.
    """
    h = history.select(F.col(history_on or on).alias("_key"), F.col("valid_from").alias("_ts"), F.lit(0).alias("_kind"),
                       F.struct(F.col("valid_to").alias("_to"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)]).alias("_version"))
    f = facts.select(_spread(facts, on).alias("_key"), facts[ts].alias("_ts"), F.lit(1).alias("_kind"),
                     F.struct(*[facts[c] for c in facts.columns]).alias("_fact"))
    both = h.where(F.col("_key").isNotNull()).unionByName(f, allowMissingColumns=True)
    both = both.withColumn("_seg", F.date_trunc(segment, F.col("_ts").cast("timestamp"))).repartition("_key", "_seg")
    along = Window.partitionBy("_key", "_seg").orderBy("_ts", "_kind")
    within = both.withColumn("_last", F.last("_version", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = both.groupBy("_key", "_seg").agg(F.max_by("_version", F.when(F.col("_kind") == 0, F.col("_ts"))).alias("_end"))
    before = Window.partitionBy("_key").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(F.col("_key").alias("_ck"), F.col("_seg").alias("_cs"), F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    carry = carry.where(F.col("_carry").isNotNull())
    found = within.where("_kind = 1").join(carry, (F.col("_key") == F.col("_ck")) & F.col("_seg").eqNullSafe(F.col("_cs")), "left")
    version = F.coalesce("_last", "_carry")
    valid = F.col("_ts").isNotNull() & (version["_to"].isNull() | (F.col("_ts") < version["_to"]))
    return found.select("_fact.*", *[F.when(valid, version[f"_{i}"]).alias(c) for i, c in enumerate(columns)])
