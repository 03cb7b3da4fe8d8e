"""Shared helpers: the shared folder, byte blocks, vectorised text hashing."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shared_dir

U64 = np.uint64

#: Bytes that a hash table built by the driver and sent to every executor may take.
REPLICATED = 32 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches handed to workers, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a plain local session without that setting gets a folder of its own;
    a cluster without it is an error, since executors share nothing else.
    """
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        shared_dir(spark, tempfile.mkdtemp(prefix="llm-shared-"))
    return scratch_path(spark, name)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def light(table: DataFrame) -> bool:
    """Whether a stored table takes at most ``REPLICATED`` bytes as a hash table, by its rows and strings.

    Spark goes by the files, which are packed, and takes no account of an explode above them.
    """
    fixed = ("bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp", "timestamp_ntz")
    long = [F.coalesce(F.octet_length(F.col(n).cast("string")), F.lit(0)).cast("bigint") for n, t in table.dtypes if t not in fixed]
    rows, more = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(long, F.lit(0).cast("bigint"))), F.lit(0))).first()
    return rows * (64 + 16 * len(table.columns)) + 2 * more <= REPLICATED  # keys are held twice


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values, n + 1 offsets) of a string or binary Arrow array; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(offsets: np.ndarray, target: int = 1 << 20):
    """Row ranges (i, j) whose texts together hold about ``target`` bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + target, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first of each text and their number) of the stretches of marked bytes.

    ``offsets`` cuts the bytes into texts; a stretch ends where its text ends.
    """
    first, last = inside.copy(), inside.copy()
    if len(inside):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    at = cuts[cuts < len(inside)]
    first[at] = inside[at]
    at = cuts[cuts > 0] - 1
    last[at] = inside[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of neighbouring stretches as an Arrow array."""
    n = len(starts)
    if not n:
        return pa.array([], pa.large_binary())
    # stretches and what lies between them alternate; every second value is a stretch
    edges = np.empty(2 * n, np.int64)
    edges[0::2], edges[1::2] = starts, ends
    both = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * n - 1, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])
    return both.take(pa.array(np.arange(0, 2 * n - 1, 2)))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: equal in, equal out, all bits stirred."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BASE = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
_POW: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers of the base and of its inverse modulo 2**64."""
    have = _POW.get("up")
    if have is None or len(have) < n:
        m = 1 << max(16, int(n).bit_length())
        for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.ones(m, U64)
            size = 1
            while size < m:
                step = U64(pow(b, size, 1 << 64))
                p[size : 2 * size] = p[: min(size, m - size)] * step
                size *= 2
            _POW[name] = p
    return _POW["up"], _POW["down"]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """n + 1 running sums S with S[j] - S[i] = sum of (byte + 1) * base**position."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free 64-bit hashes of the spans [start, end)."""
    _, down = powers(len(prefix))
    return mix64((prefix[end] - prefix[start]) * down[start])


#: Bytes of a word: digits, letters (A-Z count as a-z) and everything past ASCII.
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts that ``offsets`` cuts out of ``data``, A-Z as a-z.

    Returns (starts, ends, 64-bit hashes, first word of each text and the total).
    """
    inside = _WORD[data]
    before = np.empty(len(data) + 1, bool)
    before[0] = False
    before[1:] = inside
    cuts = offsets[1:-1]
    first = inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
    at = cuts[(cuts < len(data))]
    first[at] = inside[at]
    last = inside.copy()
    if len(data):
        last[:-1] &= ~inside[1:]
    at = cuts[(cuts > 0)] - 1
    at = at[at < len(data)]
    last[at] = inside[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    prefix = prefix_hash(_LOWER[data])
    return starts, ends, span_hash(prefix, starts, ends), np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, firsts: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``k`` words per text, and how many each text has.

    A text of 1 to k - 1 words has one shingle, of all its words; an empty text none.
    """
    n = np.diff(firsts)
    total = len(hashes)
    acc = np.zeros(total, U64)
    room = np.repeat(firsts[1:], n) - np.arange(total)  # words left in the text, from this one on
    for j in range(k):
        part = np.zeros(total, U64)
        part[: total - j] = hashes[j:]
        part[room <= j] = U64(0)
        acc = acc * U64(0xD6E8FEB86659FD93) + part + U64(j)
    begins = (np.arange(total) == np.repeat(firsts[:-1], n)) if total else np.zeros(0, bool)
    use = (room >= k) | begins & (room < k)
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    return mix64(acc[use]), counts


def to_signed(x: np.ndarray) -> np.ndarray:
    return x.astype(U64).view(np.int64)
