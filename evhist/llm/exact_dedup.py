"""Exact dedup by composable polynomial fingerprints.

A text is cut into chunks of ``CHUNK`` bytes.  The chunk hashes come from one matrix
product over all chunks of an Arrow block, modulo two primes, and combine by
length-shifted arithmetic: h(ab) = h(a) * B**len(b) + h(b).  So a huge document is
hashed chunk by chunk and its parts may come from anywhere.  Texts of equal
fingerprint and length are then compared with their group's representative, chunk by
chunk, in a stream that holds one chunk; texts that differ split their group and the
comparison runs again, so among rows with ids of their own the result never rests on a
hash.  (Rows that share an id and a fingerprint are taken for one text.)

Hot groups: groups are counted with map-side combine; the group table goes to every
executor while it is small as a hash table, and past that bound is replicated over
``SALTS`` and sorted and shuffled with the rows, so the driver never holds more than the
bound; a representative is replicated once per ``SLOT_BYTES`` of its copies, so no task
gets a whole large group.

Defined results: null text is empty; all empty texts are equal; a null id sorts below
all others; of repeated rows with the same id and text one is kept; an empty table
gives an empty result; other columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_view, keep, light

CHUNK = 1024
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1220703125)
SALTS = 16
SLOT_BYTES = 32 << 20
COMPARE_BYTES = 64 << 10


def combine(left: tuple[int, int], right: tuple[int, int], base: int, prime: int) -> tuple[int, int]:
    """(hash, length) of the concatenation of two parts, from theirs."""
    return (left[0] * pow(base, right[1], prime) + right[0]) % prime, left[1] + right[1]


def chunk_hashes(data: np.ndarray, base: int, prime: int) -> np.ndarray:
    """Polynomial hash of each full row of a (chunks, CHUNK) matrix of bytes + 1 or 0 padding.

    Sums stay below 2**9 * 2**31 * 2**10 = 2**50, so float64 products are exact.
    """
    power = np.ones(CHUNK, dtype=np.float64)
    for i in range(CHUNK - 2, -1, -1):
        power[i] = int(power[i + 1]) * base % prime
    return (data @ power).astype(np.int64) % prime


def fingerprints(data: np.ndarray, offsets: np.ndarray, base: int, prime: int) -> np.ndarray:
    """Fingerprint of every text in a block, by chunk hashes and their combination."""
    lens = np.diff(offsets)
    n_chunks = -(-lens // CHUNK)
    first = np.concatenate([[0], np.cumsum(n_chunks)])
    out = np.zeros(len(lens), np.int64)
    shift = pow(base, CHUNK, prime)
    limit = 4096  # chunks hashed at a time: 32 MB of float64
    i = 0
    while i < len(lens):
        j = max(i + 1, int(np.searchsorted(first, first[i] + limit, "right")) - 1)
        if n_chunks[i] > limit:  # one huge text, in slices; the last slice ends at its end
            total = (0, 0)
            a, b = int(offsets[i]), int(offsets[i + 1])
            while a < b:
                e = min(b, a + limit * CHUNK)
                part = fingerprints(data[a:e], np.array([0, e - a]), base, prime)
                total = combine(total, (int(part[0]), e - a), base, prime)
                a = e
            out[i] = total[0]
            i += 1
            continue
        rows = int(first[j] - first[i])
        flat = np.zeros(rows * CHUNK, np.float64)
        # each text is padded in front, where zeros do not change its hash
        pad = np.repeat((first[i + 1 : j + 1] - first[i]) * CHUNK - (offsets[i + 1 : j + 1] - offsets[i]), lens[i:j])
        flat[np.arange(offsets[j] - offsets[i]) + pad] = data[offsets[i] : offsets[j]].astype(np.float64) + 1
        h = chunk_hashes(flat.reshape(rows, CHUNK), base, prime) if rows else np.zeros(0, np.int64)
        acc = np.zeros(j - i, np.int64)
        left, at = n_chunks[i:j].copy(), first[i:j] - first[i]
        while (live := np.flatnonzero(left > 0)).size:  # Horner over each text's chunks
            acc[live] = (acc[live] * shift + h[at[live]]) % prime
            left[live] -= 1
            at[live] += 1
        out[i:j] = acc
        i = j
    return out


def _hasher(primes, with_text):
    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column("_text"))
            cols = {n: batch.column(n) for n in batch.schema.names if with_text or n != "_text"}
            cols["_bytes"] = pa.array(np.diff(offsets), pa.int64())
            for k, (base, prime) in enumerate(zip(BASES, primes)):
                cols[f"_h{k}"] = pa.array(fingerprints(data, offsets, base, prime), pa.int64())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def _compare(batches):
    """Rows sorted by (class, slot, chunk, role): each chunk against its representative's."""
    key, ref = None, b""
    for batch in batches:
        out = []
        for i, (grp, slot, c, role, chunk) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("_grp", "_slot", "_c", "_role", "_chunk")))):
            if role == 0:
                if key != (grp, slot, c):
                    key, ref = (grp, slot, c), chunk
                continue
            if key != (grp, slot, c) or chunk != ref:
                other = ref if key == (grp, slot, c) else b""
                out.append((i, "l" if chunk < other else "g"))
        at = pa.array([i for i, _ in out], pa.int64())
        cols = {n: batch.column(n).take(at) for n in ("_id", "_bytes", "_h0", "_h1", "_cls", "_c")}
        cols["_sign"] = pa.array([x for _, x in out], pa.string())
        yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def _salted(big: DataFrame, small: DataFrame, keys: list[str], few: bool, how: str = "left") -> DataFrame:
    """Join rows with a table of groups: of ``few``, rows stay where they are; else a hot group's rows go to SALTS tasks."""
    if few:
        return big.join(F.broadcast(small), keys, how)
    big = big.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)))
    small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return big.join(small.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, and the ``carry`` columns.

    ``carry`` maps names to expressions over ``docs``, evaluated in the first scan.
    ``primes`` may be set small to force collisions (tests).
    """
    carry = carry or {}
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("_text")
    rows = docs.select(F.col(id_col).alias("_id"), *(c.alias(f"_x{i}") for i, c in enumerate(carry.values())), text)
    extra = [f"_x{i}" for i in range(len(carry))]
    types = dict(rows.dtypes)
    fp_schema = ", ".join(f"{c} {types[c]}" for c in ["_id", *extra]) + ", _bytes bigint, _h0 bigint, _h1 bigint"
    fp = keep(rows.mapInArrow(_hasher(primes, False), fp_schema).withColumn("_cls", F.lit("")), "fingerprints")
    fkeys = ["_bytes", "_h0", "_h1"]
    full = (rows.select("_id", "_text").mapInArrow(_hasher(primes, True), f"_id {types['_id']}, _text binary, _bytes bigint, _h0 bigint, _h1 bigint"))
    split = None  # (_id, fingerprint) -> class path, for texts found to differ
    while True:
        labelled = fp if split is None else _relabel(fp, split, fkeys)
        groups = labelled.groupBy(*fkeys, "_cls").agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
        groups = keep(groups.where("_n > 1"), "groups")
        few = light(groups)
        wrong = keep(_mismatches(full, split, groups, fkeys, few), "mismatches")
        if wrong.isEmpty():
            break
        step = wrong.groupBy("_id", *fkeys, "_cls").agg(F.min_by("_sign", "_c").alias("_sign"))
        step = step.select("_id", *fkeys, F.concat("_cls", "_sign").alias("_cls"))
        if split is not None:  # a text split before keeps its path unless it was split again
            step = step.unionByName(split.join(step, ["_id", *fkeys], "left_anti"))
        split = keep(step, "split")
    out = _salted(labelled, groups, [*fkeys, "_cls"], few)
    out = out.withColumn("_keep_id", F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep")))
    out = out.withColumn("_size", F.coalesce("_n", F.lit(1)).cast("long"))
    last = F.col("_id").eqNullSafe(F.col("_keep_id"))
    # repeated rows: only rows that carry the kept id meet in this window
    again = Window.partitionBy("_id", *fkeys, "_cls").orderBy(F.lit(0))
    heads = out.where(last & F.col("_n").isNotNull()).withColumn("_kept", F.row_number().over(again) == 1)
    rest = out.where(~(last & F.col("_n").isNotNull())).withColumn("_kept", F.col("_n").isNull())
    out = heads.unionByName(rest)
    return out.select(F.col("_id").alias(id_col), F.col("_keep_id").alias("keep_id"), F.col("_size").alias("group_size"), F.col("_kept").alias("kept"), *(F.col(x).alias(n) for x, n in zip(extra, carry)))


def _relabel(fp: DataFrame, split: DataFrame, fkeys: list[str]) -> DataFrame:
    keys = ["_id", *fkeys]
    return fp.drop("_cls").join(split.distinct(), keys, "left").withColumn("_cls", F.coalesce("_cls", F.lit("")))


def _mismatches(full: DataFrame, split: DataFrame | None, groups: DataFrame, fkeys: list[str], few: bool) -> DataFrame:
    """Rows whose text differs from their group's representative, with chunk and sign."""
    texts = full.withColumn("_cls", F.lit("")) if split is None else _relabel(full, split, fkeys)
    rows = _salted(texts, groups, [*fkeys, "_cls"], few, "inner")
    slots = F.ceil((F.col("_n") * F.col("_bytes") + 1) / F.lit(SLOT_BYTES)).cast("bigint")
    head = F.col("_id").eqNullSafe(F.col("_keep"))
    rows = rows.withColumn("_role", F.when(head, 0).otherwise(1))
    rows = rows.withColumn("_slots", F.when(head, F.sequence(F.lit(0).cast("bigint"), slots - 1)).otherwise(F.array(F.pmod(F.xxhash64("_id"), slots))))
    starts = F.sequence(F.lit(0).cast("bigint"), F.floor(F.greatest(F.col("_bytes") - 1, F.lit(0)) / COMPARE_BYTES))
    pieces = F.transform(starts, lambda c: F.struct(c.alias("_c"), F.substring(F.col("_text"), (c * COMPARE_BYTES + 1).cast("int"), F.lit(COMPARE_BYTES)).alias("_chunk")))
    rows = rows.withColumn("_p", F.explode(pieces)).select("_id", "_cls", *fkeys, "_keep", "_role", "_slots", "_p.*")
    rows = rows.withColumn("_slot", F.explode("_slots")).drop("_slots")
    rows = rows.withColumn("_grp", F.concat_ws(":", *fkeys, "_cls"))
    rows = rows.repartition("_grp", "_slot", "_c").sortWithinPartitions("_grp", "_slot", "_c", "_role")
    t = dict(rows.dtypes)["_id"]
    return rows.drop("_keep").mapInArrow(_compare, f"_id {t}, _bytes bigint, _h0 bigint, _h1 bigint, _cls string, _c bigint, _sign string")
