"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

SALTS = 8


def _with_min(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u's neighbours; a hot u is spread over SALTS."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    least = least.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return pairs.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(least, ["u", "s"]).drop("s")


def _stars(edges: DataFrame) -> bool:
    """Whether every id hangs on one root and no root hangs on another."""
    ids = edges.select("u")
    if edges.count() != ids.distinct().count():
        return False
    return ids.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in ``links(a, b)``; root is the least id of the component.

    Every round is written to the shared folder; the driver sees counts only.
    """
    edges = keep(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_min(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct()
        small = _with_min(keep(large, "large-star"))  # u > v in every pair
        small = small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = keep(small.distinct(), "small-star")
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots.select("id", F.col("id").alias("root")))
