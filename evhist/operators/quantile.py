"""Exact quantiles of hot groups, by rank selection over prefix counts.

A group's values are dealt into ``BUCKETS`` ranges between its least and greatest value,
spaced by logarithm so that one extreme value does not push all others into one range.
Counts per range are summed up in order, which names the range of every wanted rank and
the rank inside it.  Only the ranges named are then sorted, each on its own.  So a
group's values spread over as many tasks as it has ranges, and no window holds more than
``BUCKETS`` rows or one range's distinct values.

Quantiles interpolate linearly between the two neighbouring ranks, as ``percentile`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096


def exact_quantiles(counts: DataFrame, group: str, value: str, n: str, probs: Sequence[float], names: Sequence[str],
                    buckets: int = BUCKETS) -> DataFrame:
    """One row per ``group`` with the quantiles of ``value``, each of weight ``n``.

    ``counts`` has one row per (group, value), values and weights not null; a null
    group is a group like any other.
    """
    rows = counts.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v"), F.col(n).alias("_n"))
    bounds = rows.groupBy("_g").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_n").alias("_total"))
    bounds = bounds.select(F.col("_g").alias("_bg"), "_lo", "_hi", "_total")
    # never decreasing in the value: logarithm, quotient and floor keep the order
    share = F.log1p(F.col("_v") - F.col("_lo")) / F.nullif(F.log1p(F.col("_hi") - F.col("_lo")), F.lit(0.0))
    rows = rows.join(bounds, F.col("_g").eqNullSafe(F.col("_bg")))
    rows = rows.withColumn("_b", F.least(F.floor(F.coalesce(share, F.lit(0.0)) * buckets), F.lit(buckets - 1)))
    hist = rows.groupBy("_g", "_b").agg(F.sum("_n").alias("_in"), F.first("_total").alias("_total"))
    upto = F.sum("_in").over(Window.partitionBy("_g").orderBy("_b"))
    hist = hist.withColumn("_before", upto - F.col("_in"))
    # both neighbouring ranks of every quantile, from 0
    at = lambda p: (F.col("_total") - 1) * F.lit(float(p))
    ranks = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), f(at(p)).cast("bigint").alias("rank"), at(p).alias("at"))
                      for i, p in enumerate(probs) for side, f in enumerate((F.floor, F.ceil))))
    wanted = hist.select("_g", "_b", "_before", "_in", F.inline(ranks))
    wanted = wanted.where((F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("_in")))
    wanted = wanted.select(F.col("_g").alias("_wg"), F.col("_b").alias("_wb"), "i", "side", "at", "rank", (F.col("rank") - F.col("_before")).alias("_left"))
    named = wanted.select("_wg", "_wb").distinct()
    inside = rows.join(named, F.col("_g").eqNullSafe(F.col("_wg")) & (F.col("_b") == F.col("_wb")), "left_semi")
    upto = F.sum("_n").over(Window.partitionBy("_g", "_b").orderBy("_v"))
    inside = inside.select("_g", "_b", "_v", "_n", upto.alias("_upto"))
    hit = inside.join(wanted, F.col("_g").eqNullSafe(F.col("_wg")) & (F.col("_b") == F.col("_wb")) & (F.col("_left") < F.col("_upto")) & (F.col("_left") >= F.col("_upto") - F.col("_n")))
    pick = lambda i, side, c: F.max(F.when((F.col("i") == i) & (F.col("side") == side), F.col(c)))
    cols = [x for i in range(len(probs)) for x in (pick(i, 0, "_v").alias(f"_l{i}"), pick(i, 1, "_v").alias(f"_h{i}"), pick(i, 0, "at").alias(f"_p{i}"), pick(i, 0, "rank").alias(f"_r{i}"))]
    out = hit.groupBy("_g").agg(*cols)

    def between(i: int):
        low, high, p, r = (F.col(f"_{c}{i}") for c in "lhpr")
        return F.when(p == r, low).otherwise((r + 1 - p) * low + (p - r) * high)

    return out.select(F.col("_g").alias(group), *(between(i).alias(name) for i, name in enumerate(names)))
