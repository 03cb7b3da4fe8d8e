"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws one number per record from a hash of its name and the record's key,
an exponential variate with the shard's weight as its rate; the least draw owns the
record.  A shard's draws depend on nothing but its name, its weight and the key.  So a
record's shard does not depend on other records, a shard gets records in proportion to
its weight, a new shard takes records only into itself, and a removed one gives up only
its own.

Places inside a shard are gapless and follow the order of the keys.  No shard meets in
one task: narrow rows are sorted by range of (shard, key, row), which splits a key that
many rows share as well; each range knows how many rows of each shard lie before it.

Defined results: a null key is a key like any other (all such rows share a shard);
repeated rows share a shard and get places of their own; ties between shards go to the
one listed first; null and empty texts have size 1; an empty table gives no rows;
columns other than those named are not read, and clashing names do not matter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

SHARDS = 16
_BITS = 52  # of the hash; with them u = (x + 0.5) / 2**52 is exact and inside (0, 1)


def equal_shards(n: int) -> dict[str, float]:
    """``n`` shards of weight 1, named by their number."""
    return {str(i): 1.0 for i in range(n)}


def owner(shards: Mapping[str, float], *key: Column) -> Column:
    """Name of the shard that owns a record; keys count by their text, whatever their type."""
    if not shards or not all(w > 0 and w < float("inf") for w in shards.values()):
        raise ValueError("shards have positive, finite weights; leave out the others")
    listed = F.array(*(F.struct(F.lit(i).alias("place"), F.lit(str(name)).alias("name"), F.lit(float(w)).alias("weight")) for i, (name, w) in enumerate(shards.items())))

    def draw(shard: Column) -> Column:
        h = F.xxhash64(shard["name"], *(k.cast("string") for k in key))
        u = (F.shiftrightunsigned(h, 64 - _BITS) + F.lit(0.5)) / F.lit(float(1 << _BITS))
        return F.struct((-F.log(u) / shard["weight"]).alias("draw"), shard["place"].alias("place"), shard["name"].alias("name"))

    return F.array_min(F.transform(listed, draw))["name"]


def places(rows: DataFrame, group: str, order: Sequence[str], name: str = "slot") -> DataFrame:
    """``rows`` with a gapless number from 0 within ``group``, in ``order``.

    Both tables written here hold only what ``rows`` has, so pass narrow rows.
    """
    rows = keep(rows.withColumn("_row", F.monotonically_increasing_id()), "shard-rows")
    by = [group, *order, "_row"]
    # within a range the rows of a group are neighbours, so their numbers run on
    laid = keep(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "shard-order")
    laid = laid.withColumn("_part", F.shiftright("_at", 33))
    parts = laid.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    out = laid.join(parts, laid[group].eqNullSafe(parts["_g"]) & (F.col("_part") == F.col("_p")))
    return out.withColumn(name, F.col("_at") + F.col("_shift")).drop("_row", "_at", "_part", "_g", "_p", "_shift")


def assign(docs: DataFrame, shards: Mapping[str, float], key: Sequence[str] = ("doc_id",), grown: Mapping[str, float] | None = None, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """Key columns, the ``carry`` expressions, shard and slot of every row.

    With ``grown``, another set of shards, ``grown_shard`` is the owner under it.
    """
    keys = [F.col(k) for k in key]
    names = [f"_k{i}" for i in range(len(keys))]
    carry = carry or {}
    cols = [*(k.alias(n) for k, n in zip(keys, names)), *(c.alias(f"_x{i}") for i, c in enumerate(carry.values())), owner(shards, *keys).alias("_shard")]
    if grown is not None:
        cols.append(owner(grown, *keys).alias("_grown"))
    out = places(docs.select(*cols), "_shard", names, "_slot")
    named = [*zip(names, key), *((f"_x{i}", n) for i, n in enumerate(carry)), ("_shard", "shard"), ("_slot", "slot"), *([("_grown", "grown_shard")] if grown is not None else [])]
    return out.select(*(F.col(a).alias(b) for a, b in named))


def moves(docs: DataFrame, old: Mapping[str, float], new: Mapping[str, float], key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The rows of ``docs`` that change their shard, with ``from_shard`` and ``to_shard``; no shuffle."""
    keys = [F.col(k) for k in key]
    out = docs.withColumn("from_shard", owner(old, *keys)).withColumn("to_shard", owner(new, *keys))
    return out.where("from_shard <> to_shard")


def write_shards(docs: DataFrame, path: str, shards: Mapping[str, float], key: Sequence[str] = ("doc_id",)) -> None:
    """``docs`` as Parquet below ``path``, a folder ``shard=<name>`` each; large shards in several files."""
    laid = docs.withColumn("shard", owner(shards, *(F.col(k) for k in key))).hint("rebalance", "shard")
    laid.write.mode("overwrite").partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, n: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (one shard more) of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    carry = {"size": F.octet_length(text).cast("long") + 1, "text_crc32": F.crc32(text.cast("binary"))}
    out = assign(docs, equal_shards(n), grown=equal_shards(n + 1), carry=carry)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.col("grown_shard").cast("int").alias("grown_shard"))
