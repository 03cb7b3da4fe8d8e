"""Suffix-array dedup by a run-length index.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (in a
smaller id, or earlier in the same text).  All texts are judged as they came in.

1. Anchors.  Every window of ``length`` bytes selects the 40-byte gram in it with the
   least hash, so equal windows select the same gram at the same place.  Neighbouring
   windows that share their anchor form a run.  Anchors that occur once cannot repeat.
2. Pieces.  The text of every run with a repeated anchor goes to its anchor's part, once
   per Arrow batch; every window meets all windows equal to it there, and only there.
3. Index.  A part's distinct pieces, in order of first occurrence, get a Burrows-Wheeler
   transform that is kept as its runs, with the suffix positions at both sides of every
   run boundary sampled.  Between samples the match with the preceding suffix and its
   length follow by streaming along the text (length one less, position one more), so
   matching statistics cost one step a byte.  Windows linked by matches of ``length``
   and more are one string; all but its first place are marked.
4. What is kept of each run goes back to its document; the rest of the run's windows go.

Hot strings: an anchor that repeats within a batch enters the anchor count once per
batch; equal pieces are sent once per batch; a part holds distinct pieces only, and an
anchor with more than ``split`` of them (one passage in very many contexts) is dealt out
again window by window, by the window's own hash.  Parts stream in bounded chunks.  Texts
are shuffled once, deflated one by one, and unpacked a bounded number of bytes at a time.

Defined results: null text is empty; texts below ``length`` bytes stay whole; the order
of documents is that of their ids, a null id first; rows that share an id are ordered
by their text's hash, and rows alike in both count as one document, each with the same
result; an empty table gives no rows; other columns are ignored or carried unchanged.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, byte_view, keep, mix64, prefix_hash, span_hash

LENGTH = 100
GRAM = 40
SPLIT = 20_000
CHUNK_BYTES = 2 << 20
SLICE = 4 << 20  # longer texts are scanned in overlapping slices
OPEN_BYTES = 8 << 20  # of texts unpacked at a time
U = np.uint64

ENTRY = np.dtype([("h", "<u8"), ("d", "<i8"), ("s", "<u4"), ("n", "u1")])
RUN = np.dtype([("h", "<u8"), ("s", "<u4"), ("n", "u1")])
KEPT = np.dtype([("s", "<u4"), ("n", "<u4")])


# ---- anchors


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Runs of windows with one anchor: (text, first start in the text, windows, anchor hash)."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, np.zeros(0, U)
    at = np.arange(n - gram + 1)
    hashes = span_hash(prefix_hash(data), at, at + gram)
    key = (hashes & ~U(0xFFFFFFFF)) | at.astype(U)
    span, size = length - gram + 1, 1
    while 2 * size <= span:  # least key of each window, by doubling
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < span:
        rest = span - size
        key = np.minimum(key[:-rest], key[rest:])
    chosen = (key & U(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(chosen)]
    valid = np.arange(len(chosen)) + length <= offsets[text + 1]
    new = np.ones(len(chosen), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new & valid)
    if not len(first):
        return none, none, none, np.zeros(0, U)
    ends = np.append(np.flatnonzero((new | ~valid)[1:]) + 1, len(chosen))
    last = ends[np.searchsorted(ends, first, "right")]
    owner = text[first]
    return owner, first - offsets[owner], last - first, hashes[chosen[first]]


def _slices(offsets: np.ndarray, length: int):
    """(row, from, to) parts of texts; a long text is cut so that each window lies in one part."""
    for r in range(len(offsets) - 1):
        a, b = int(offsets[r]), int(offsets[r + 1])
        if b - a <= SLICE:
            yield r, a, b
            continue
        while b - a >= length:
            e = min(b, a + SLICE + length - 1)
            yield r, a, e
            a += SLICE


def scan(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Runs of all texts of a batch: (row, start, windows, anchor hash)."""
    out = []

    def flush(group):
        if not group:
            return
        part = np.concatenate([data[a:b] for _, a, b in group])
        cuts = np.concatenate([[0], np.cumsum([b - a for _, a, b in group])])
        owner, start, n, h = runs_of(part, cuts, length, gram)
        rows, begins = np.array([r for r, _, _ in group]), np.array([a - offsets[r] for r, a, _ in group])
        out.append((rows[owner], start + begins[owner], n, h))

    group, size = [], 0
    for piece in _slices(offsets, length):
        if piece[2] - piece[1] < length:
            continue
        group.append(piece)
        size += piece[2] - piece[1]
        if size >= 1 << 20:
            flush(group)
            group, size = [], 0
    flush(group)
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, U)
    return tuple(np.concatenate(x) for x in zip(*out))


def _dealt(entry: np.ndarray, where: np.ndarray):
    """(bucket, packed entries) for every bucket that has any."""
    order = np.argsort(where, kind="stable")
    entry, where = entry[order], where[order]
    heads = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])) if len(where) else np.zeros(0, np.int64)
    return where[heads], [entry[a:b].tobytes() for a, b in zip(heads, np.append(heads[1:], len(entry)))]


_STAGE1 = "bucket int, known boolean, runs binary"


def _anchors(length, gram, buckets):
    """Packed entries per hash bucket; runs whose anchor repeats within the batch go on as they are."""

    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column("_text"))
            ids = batch.column("_d").to_numpy(zero_copy_only=False)
            row, s, n, h = scan(data, offsets, length, gram)
            order = np.argsort(h)
            hs = h[order]
            same = np.zeros(len(hs), bool)
            same[1:] = hs[1:] == hs[:-1]
            again = same.copy()
            again[:-1] |= same[1:]
            # one entry per anchor: with its run, or (n = 0) to say that it repeats already
            single, known = order[~again], order[again]
            flags = hs[again & ~same]
            entry = np.zeros(len(single) + len(flags), ENTRY)
            entry["h"] = np.concatenate([h[single], flags])
            entry["d"][: len(single)], entry["s"][: len(single)], entry["n"][: len(single)] = ids[row[single]], s[single], n[single]
            at, blobs = _dealt(entry, (mix64(entry["h"]) % U(buckets)).astype(np.int32))
            runs = np.zeros(len(known), ENTRY)
            runs["h"], runs["d"], runs["s"], runs["n"] = h[known], ids[row[known]], s[known], n[known]
            to, packed = _dealt(runs, _home(runs["d"], buckets))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([at, to]), pa.int32()), pa.array(np.arange(len(at) + len(to)) >= len(at)), pa.array(blobs + packed, pa.binary())], names=["bucket", "known", "runs"])

    return run


def _home(d: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket in which a document's runs meet."""
    return (mix64(d.astype(np.int64).view(U)) % U(buckets)).astype(np.int32)


def _repeated(buckets):
    """Of a partition's entries, the runs whose anchor was met twice, dealt out by document."""

    def run(batches):
        entries = []
        for batch in batches:
            known = batch.filter(batch.column("known"))
            if len(known):
                yield known.select(["bucket", "runs"])
            entries += [np.frombuffer(x, ENTRY) for x in batch.filter(pc.invert(batch.column("known"))).column("runs").to_pylist()]
        if not entries:
            return
        table = np.concatenate(entries)
        del entries
        order = np.argsort(table["h"])
        h = table["h"][order]
        same = np.zeros(len(h), bool)
        same[1:] = h[1:] == h[:-1]
        again = same.copy()
        again[:-1] |= same[1:]
        table = table[order[again]]
        table = table[table["n"] > 0]
        to, packed = _dealt(table, _home(table["d"], buckets))
        yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(packed, pa.binary())], names=["bucket", "runs"])

    return run


def _by_document(batches):
    """One row per document with its candidate runs."""
    parts = [np.frombuffer(x, ENTRY) for batch in batches for x in batch.column("runs").to_pylist()]
    if not parts:
        return
    table = np.concatenate(parts)
    del parts
    table = table[np.argsort(table["d"], kind="stable")]
    d = table["d"]
    runs = np.zeros(len(table), RUN)
    for name in ("h", "s", "n"):
        runs[name] = table[name]
    heads = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]])) if len(d) else np.zeros(0, np.int64)
    ends = np.append(heads[1:], len(d))
    for i in range(0, len(heads), 5000):
        a, b = heads[i : i + 5000], ends[i : i + 5000]
        yield pa.RecordBatch.from_arrays([pa.array(d[a]), pa.array([runs[x:y].tobytes() for x, y in zip(a, b)], pa.binary())], names=["d", "runs"])


def _runs(value) -> np.ndarray:
    return np.frombuffer(value, RUN) if value else np.zeros(0, RUN)


def _packed(batches):
    """Texts for the shuffle: their size in 8 bytes, then their bytes deflated."""
    for batch in batches:
        at = batch.schema.get_field_index("_text")
        texts = (x.as_buffer() for x in batch.column(at))
        packed = pa.array([len(t).to_bytes(8, "little") + zlib.compress(t, 1) for t in texts], pa.binary())
        yield batch.set_column(at, "_text", packed)


def _unpacked(batches):
    """(rows, their texts), as many rows at a time as hold OPEN_BYTES, one at least."""
    for batch in batches:
        packed = batch.column("_text").to_pylist()
        offsets = np.cumsum([0] + [int.from_bytes(x[:8], "little") for x in packed])
        for i, j in blocks(offsets, OPEN_BYTES):
            yield batch.slice(i, j - i), [zlib.decompress(x[8:]) for x in packed[i:j]]


def _pieces(length):
    """The text of every candidate run, equal ones of a batch once, at their first place."""

    def run(batches):
        for batch, texts in _unpacked(batches):
            ids = batch.column("_d").to_pylist()
            first: dict = {}
            for r, value in enumerate(batch.column("runs").to_pylist()):
                d, text = ids[r], texts[r]
                for h, s, n in _runs(value).tolist():
                    key = (h, text[s : s + n - 1 + length])
                    was = first.get(key)
                    if was is None or (d, s) < was:
                        first[key] = (d, s)
            keys, places = list(first), list(first.values())
            for i in range(0, len(keys), 8192):
                k, p = keys[i : i + 8192], places[i : i + 8192]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array([x[0] for x in k], U).view(np.int64)), pa.array([x[1] for x in k], pa.binary()), pa.array([x[0] for x in p], pa.int64()), pa.array([x[1] for x in p], pa.int64())],
                    names=["h", "piece", "d", "s"])

    return run


# ---- the index


class RunLengthIndex:
    """Run-compressed BWT of pieces, each closed by a symbol of its own.

    ``q``, ``f``, ``l``: for every run of the transform, in text order, the position of
    its first suffix, the position of the suffix before it (the end of the run before),
    and how many bytes the two share.
    """

    def __init__(self, pieces: list[bytes]):
        m = len(pieces)
        lens = np.array([len(p) for p in pieces], np.int64)
        n = int(lens.sum()) + m
        self.starts = np.concatenate([[0], np.cumsum(lens + 1)])[:-1]
        self.ends = self.starts + lens
        self.bytes = np.frombuffer(b"\0".join(pieces) + b"\0" + b"\0" * 8, np.uint8)
        self.symbols = self.bytes[:n].astype(np.int64) + m
        self.symbols[self.ends] = np.arange(m)
        self.n = n
        sa = self._suffixes(m + 256)
        before = self.symbols[sa - 1]  # the transform; position 0 wraps to the last closing symbol
        heads = np.ones(n, bool)
        heads[1:] = before[1:] != before[:-1]
        self.runs = int(heads.sum())
        i = np.flatnonzero(heads)
        q, f = sa[i], np.where(i > 0, sa[i - 1], -1)
        order = np.argsort(q)
        self.q, self.f = q[order], f[order]
        self.l = self._shared(self.q, self.f)

    def _suffixes(self, alphabet: int) -> np.ndarray:
        """Suffix array by prefix doubling; only groups not yet told apart are sorted again."""
        n, bits = self.n, int(alphabet).bit_length()
        step = max(1, 62 // bits)
        padded = np.concatenate([self.symbols, np.zeros(step, np.int64)])
        key = np.zeros(n, np.int64)
        for j in range(step):
            key = (key << bits) | padded[j : j + n]
        sa = np.argsort(key)
        key = key[sa]
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank = np.empty(n, np.int64)
        rank[sa] = head
        while True:
            single = new & np.append(new[1:], True)
            at = np.flatnonzero(~single)
            if not len(at):
                return sa
            pos = sa[at]
            key = rank[pos] * n + rank[np.minimum(pos + step, n - 1)]
            order = np.argsort(key)
            pos, key = pos[order], key[order]
            sa[at] = pos
            fresh = np.ones(len(at), bool)
            fresh[1:] = key[1:] != key[:-1]
            new[at] |= fresh
            rank[pos] = np.maximum.accumulate(np.where(fresh, at, 0))
            step *= 2

    def _left(self, pos: np.ndarray) -> np.ndarray:
        """Bytes from a position to the end of its piece."""
        return self.ends[np.searchsorted(self.starts, pos, "right") - 1] - pos

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at a and b share within their pieces; 0 where b < 0."""
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero(b >= 0)
        most = np.zeros(len(a), np.int64)
        most[live] = np.minimum(self._left(a[live]), self._left(b[live]))
        words = np.ndarray((len(self.bytes) - 7,), "<u8", self.bytes.data, 0, (1,))
        while live.size:
            x, y = a[live] + out[live], b[live] + out[live]
            diff = words[x] ^ words[y]
            low = (diff & (~diff + U(1))).astype(np.float64)
            same = np.where(diff == 0, 8, np.log2(np.where(diff == 0, 1, low)).astype(np.int64) // 8)
            out[live] += same
            live = live[(same == 8) & (out[live] < most[live])]
        return np.minimum(out, most)

    def matches(self) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of the whole text, streamed from the samples: the
        preceding suffix and the bytes shared with it, for every position."""
        sampled = np.zeros(self.n, bool)
        sampled[self.q] = True
        k = np.cumsum(sampled) - 1
        step = np.arange(self.n) - self.q[k]
        return self.f[k] + step, np.maximum(self.l[k] - step, 0)

    def first_places(self, length: int) -> np.ndarray:
        """For every position the least one with the same ``length`` bytes (itself if none)."""
        link, shared = self.matches()
        at = np.arange(self.n)
        root = np.where(shared >= length, link, at)
        moved = np.flatnonzero(root != at)
        while moved.size:  # jump along the links to the head of each class
            to = root[root[moved]]
            on = to != root[moved]
            root[moved] = to
            moved = moved[on]
        least = at.copy()
        linked = np.flatnonzero(root != at)
        np.minimum.at(least, root[linked], linked)
        return least[root]


def kept_windows(first: dict[bytes, tuple[int, int]], length: int):
    """(id, start, windows) that are the first place of their string, over distinct pieces."""
    items = sorted(first.items(), key=lambda x: x[1])
    index = RunLengthIndex([p for p, _ in items])
    best = index.first_places(length)
    at = np.arange(index.n)
    piece = np.searchsorted(index.starts, at, "right") - 1
    stays = (best == at) & (at + length <= index.ends[piece])
    edge = np.diff(np.concatenate([[0], stays.astype(np.int8), [0]]))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    d, s = np.array([p[0] for _, p in items], np.int64), np.array([p[1] for _, p in items], np.int64)
    owner = piece[a]
    return d[owner], s[owner] + a - index.starts[owner], b - a


_STAGE4 = "route bigint, d bigint, s bigint, n bigint, win binary"


def _rows(route, d, s, n, win):
    return pa.RecordBatch.from_arrays([pa.array(route, pa.int64()), pa.array(d, pa.int64()), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array(win, pa.binary())], names=["route", "d", "s", "n", "win"])


def _hash_window(win: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(win, digest_size=8).digest(), "little", signed=True)


def _index(length, split):
    """Kept windows of each part; an anchor with too many distinct pieces leaves as single windows."""

    def windows(pieces):
        for piece, (d, s) in pieces:
            for i in range(len(piece) - length + 1):
                w = piece[i : i + length]
                yield _hash_window(w), d, s + i, 1, w

    def chunked(rows, size=5000):
        buffer = []
        for row in rows:
            buffer.append(row)
            if len(buffer) == size:
                yield _rows(*zip(*buffer))
                buffer = []
        if buffer:
            yield _rows(*zip(*buffer))

    def result(chunk):
        d, s, n = kept_windows(chunk, length)
        yield _rows(d, d, s, n, [None] * len(d))

    def run(batches):
        chunk, size, group, h_now, over = {}, 0, {}, None, False
        for batch in batches:
            for h, piece, d, s in zip(*(batch.column(c).to_pylist() for c in ("h", "piece", "d", "s"))):
                if h != h_now:
                    chunk.update(group)
                    size += sum(map(len, group))
                    group, h_now, over = {}, h, False
                    if size >= CHUNK_BYTES:
                        yield from result(chunk)
                        chunk, size = {}, 0
                if over:
                    yield from chunked(windows([(piece, (d, s))]))
                    continue
                was = group.get(piece)
                if was is None or (d, s) < was:
                    group[piece] = (d, s)
                if len(group) > split:
                    yield from chunked(windows(group.items()))
                    group, over = {}, True
        chunk.update(group)
        if chunk:
            yield from result(chunk)

    return run


def _first_windows(batches):
    """Kept windows pass; of single windows, sorted by content, the first place stays."""
    now, best = None, None
    for batch in batches:
        through = batch.filter(batch.column("win").is_null())
        if len(through):
            yield through.select(["d", "s", "n"])
        out = []
        rest = batch.filter(batch.column("win").is_valid())
        for win, d, s in zip(*(rest.column(c).to_pylist() for c in ("win", "d", "s"))):
            if win != now:
                if now is not None:
                    out.append(best)
                now, best = win, (d, s)
            elif (d, s) < best:
                best = (d, s)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([1] * len(out), pa.int64())], names=["d", "s", "n"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([best[0]], pa.int64()), pa.array([best[1]], pa.int64()), pa.array([1], pa.int64())], names=["d", "s", "n"])


# ---- back to the documents


def removed_spans(size: int, runs: np.ndarray, kept: list, length: int) -> np.ndarray:
    """(k, 2) maximal byte spans covered by candidate windows that are not kept."""
    if not len(runs):
        return np.zeros((0, 2), np.int64)
    mark = np.zeros(size + 1, np.int32)
    s, n = runs["s"].astype(np.int64), runs["n"].astype(np.int64)
    np.add.at(mark, s, 1)
    np.add.at(mark, s + n, -1)
    gone = np.cumsum(mark) > 0
    for a, m in kept:
        gone[a : a + m] = False
    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + length - 1
    if not len(a):
        return np.zeros((0, 2), np.int64)
    apart = np.concatenate([[True], a[1:] > b[:-1]])  # b rises with a
    return np.stack([a[apart], np.append(b[:-1][apart[1:]], b[-1])], 1)


def _cut(length, with_text):
    def run(batches):
        for batch, whole in _unpacked(batches):
            size, gone, spans, sha, texts = [], [], [], [], []
            for text, runs, kept in zip(whole, batch.column("runs").to_pylist(), batch.column("kept").to_pylist()):
                cuts = removed_spans(len(text), _runs(runs), [(x["s"], x["n"]) for x in kept or ()], length)
                if len(cuts):
                    ends = [0, *cuts[:, 1].tolist()]
                    left = b"".join(text[a:b] for a, b in zip(ends, [*cuts[:, 0].tolist(), len(text)]))
                else:
                    left = text
                size.append(len(text)), gone.append(len(text) - len(left)), spans.append(len(cuts))
                if with_text:
                    texts.append(left.decode("utf-8", "ignore") if len(cuts) else text.decode("utf-8", "replace"))
                else:
                    sha.append(hashlib.sha256(left).hexdigest())
            cols = {n: batch.column(n) for n in batch.schema.names if n not in ("_text", "runs", "kept")}
            cols |= {"n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "n_spans": pa.array(spans, pa.int64())}
            cols |= {"kept_text": pa.array(texts, pa.string())} if with_text else {"kept_sha256": pa.array(sha, pa.string())}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def _ordered(docs: DataFrame, id_col: str, text_col: str):
    """``docs`` with a unique key ``_d`` in document order; ids serve where they can."""
    ids = docs.select(F.col(id_col).alias("_i"))
    clash = ids.groupBy("_i").count().where("`count` > 1 OR _i IS NULL").limit(1)
    if clash.isEmpty():
        return docs.withColumn("_d", F.coalesce(F.col(id_col).cast("bigint"), F.lit(0).cast("bigint")))
    print_of = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    keyed = docs.withColumn("_p", print_of)
    order = keyed.select(F.col(id_col).cast("bigint").alias("_i"), "_p").distinct().orderBy(F.col("_i").asc_nulls_first(), "_p")
    spark = docs.sparkSession
    numbered = keep(order, "order")  # sorted once; numbered from what was written
    numbered = spark.createDataFrame(numbered.orderBy(F.col("_i").asc_nulls_first(), "_p").rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1])), "_i bigint, _q bigint, _d bigint")
    numbered = keep(numbered, "keys")
    return keyed.join(numbered, F.col(id_col).cast("bigint").eqNullSafe(numbered["_i"]) & (keyed["_p"] == numbered["_q"])).drop("_i", "_q", "_p").withColumn("_d", F.coalesce("_d", F.lit(0).cast("bigint")))


def _plan(docs: DataFrame, id_col, text_col, carry, length, gram, split, with_text):
    spark = docs.sparkSession
    keyed = _ordered(docs, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("_text")
    names = [f"_c{i}" for i in range(len(carry))]
    texts = keyed.select("_d", text, *(F.col(c).alias(n) for c, n in zip(carry, names)))
    buckets = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    entries = texts.select("_d", "_text").mapInArrow(_anchors(length, gram, buckets), _STAGE1)
    found = entries.repartition("bucket").mapInArrow(_repeated(buckets), "bucket int, runs binary")
    found = found.repartition("bucket").mapInArrow(_by_document, "d bigint, runs binary")
    found = keep(found, "repeated-runs").select(F.coalesce("d", F.lit(0).cast("bigint")).alias("_d"), "runs")
    # both joins below deal out the same columns alike, so Spark reuses one exchange of the texts
    types = dict(texts.dtypes)
    packed = texts.mapInArrow(_packed, ", ".join(f"{n} {t}" for n, t in types.items()))
    packed = packed.select(F.coalesce("_d", F.lit(0).cast("bigint")).alias("_d"), "_text", *names)
    # (a broadcast would open the texts in the stage that deflates them, with twice the workers at once)
    found = found.hint("merge")
    pieces = packed.join(found, "_d").select("_d", "_text", "runs", *names).mapInArrow(_pieces(length), "h bigint, piece binary, d bigint, s bigint")
    marked = pieces.repartition("h").sortWithinPartitions("h").mapInArrow(_index(length, split), _STAGE4)
    kept = marked.repartition("route").sortWithinPartitions("win").mapInArrow(_first_windows, "d bigint, s bigint, n bigint")
    kept = kept.groupBy("d").agg(F.collect_list(F.struct("s", "n")).alias("kept")).select(F.coalesce("d", F.lit(0).cast("bigint")).alias("_d"), "kept")
    schema = ", ".join(f"{n} {types[n]}" for n in names) + ", n_bytes bigint, n_removed bigint, n_spans bigint, " + ("kept_text string" if with_text else "kept_sha256 string")
    joined = packed.join(found, "_d", "left").join(kept.hint("merge"), "_d", "left").select(*names, "_text", "runs", "kept")
    return joined.mapInArrow(_cut(length, with_text), schema), names


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, split: int = SPLIT) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    out, _ = _plan(docs, id_col, text_col, [id_col], length, gram, split, False)
    return out.withColumnRenamed("_c0", id_col)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, split: int = SPLIT) -> DataFrame:
    """``docs`` with the repeated bytes cut out of the text, all other columns unchanged.

    A character that loses some of its bytes goes as a whole; a null text becomes empty.
    """
    others = [c for c in docs.columns if c != text_col]
    out, names = _plan(docs, id_col, text_col, others, length, gram, split, True)
    return out.select(*(F.col("kept_text").alias(c) if c == text_col else F.col(names[others.index(c)]).alias(c) for c in docs.columns))
