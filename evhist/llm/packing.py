"""Best-fit packing by exact-complement hashing.

Texts become token ids (byte-level BPE, the ids of the tokenizer file) and one closing
id; only longer documents are cut, into pieces of ``capacity`` tokens with the shorter
piece first.  What is packed globally is the histogram of piece lengths, at most
``capacity`` numbers however many documents there are:

1. Exact complements.  From the longest length down, the gap that a piece leaves is
   looked up among single lengths, pair sums and triple sums; every combination that
   fills it exactly is consumed as often as the counts allow.
2. Best fit decreasing places the remaining counts, in groups of equal bins.

The plan is a short list of patterns.  Each piece gets its rank among the pieces of its
length (a rank within a salted part plus the parts' offsets, so one very common length
does not land in one task) and with it its place in a pattern.

Defined results: null text is empty and gives the closing id alone; equal and repeated
rows are packed each by itself; an empty table gives no rows; other columns are ignored.
Long texts are tokenised whole.
"""

from __future__ import annotations

import base64
import os
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

CAPACITY = 1024
END_ID = 2
PART_ROWS = 100_000  # pieces of one length that one ranking part holds


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---- tokens

_ENCODERS: dict = {}


def encoder(vocab: str):
    """text -> ids of the tokenizer file ``vocab``, without added special tokens.

    The rank file beside it holds the same vocabulary and is several times faster; texts
    that spell out a special token, or that its regex engine refuses, take the file itself.
    """
    if vocab not in _ENCODERS:
        from tokenizers import Tokenizer

        full = Tokenizer.from_file(vocab)
        special = [t.content for t in full.get_added_tokens_decoder().values()]
        slow = lambda text: full.encode(text, add_special_tokens=False).ids
        ranks = vocab.removesuffix(".json") + ".tiktoken"
        if not os.path.exists(ranks):
            _ENCODERS[vocab] = slow
            return slow
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

        def encode(text: str) -> list[int]:
            if any(s in text for s in special):
                return slow(text)
            try:
                return fast.encode_ordinary(text)
            except BaseException as e:  # the regex engine's panic is no Exception
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
                return slow(text)

        _ENCODERS[vocab] = encode
    return _ENCODERS[vocab]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens; the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _tokenize(vocab, capacity, end_id, with_ids):
    def run(batches):
        encode = encoder(vocab)
        for batch in batches:
            ids_col, texts = batch.column("_id"), batch.column("_text")
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i in range(len(texts)):
                tokens = np.array(encode(texts[i].as_py() or "") + [end_id], dtype="<u4")
                for k, (s, n) in enumerate(cut(len(tokens), capacity)):
                    part = tokens[s : s + n]
                    row.append(i), piece.append(k), start.append(s), length.append(n)
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        ids.append(part.astype(np.int32))
            cols = {"_id": ids_col.take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                cols["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def tokenize(docs: DataFrame, id_col="doc_id", text_col="text", vocab=None, capacity=CAPACITY, end_id=END_ID, with_ids=False) -> DataFrame:
    """Pieces of every document: _id, piece, start, length, ids_crc32 and, if asked, ids."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = f"_id {dict(rows.dtypes)['_id']}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return rows.mapInArrow(_tokenize(vocab or _public("byte_bpe_50k.json"), capacity, end_id, with_ids), schema)


# ---- plan: patterns from counts by length


def exact_patterns(counts: Counter, capacity: int, depth: int = 3) -> list[tuple[int, list[int]]]:
    """Consume combinations that sum to ``capacity``; lowers ``counts``.

    ``depth`` is how many lengths may fill a gap together: 1 single, 2 pair, 3 triple sums.
    """
    found = []
    if not depth:
        return found

    def take(lengths):
        need = Counter(lengths)
        m = min(counts[x] // k for x, k in need.items())
        if m:
            found.append((m, lengths))
            for x, k in need.items():
                counts[x] -= m * k
        return m

    take([capacity])
    for longest in range(capacity - 1, 0, -1):
        if not counts[longest]:
            continue
        gap = capacity - longest
        if gap <= longest:
            take([longest, gap])
        have = [x for x in range(1, min(longest, gap - 1) + 1) if counts[x]]
        for a in reversed(have):  # pair sums
            if not counts[longest] or depth < 2:
                break
            b = gap - a
            if b > a:
                break
            if counts[a] and counts[b]:
                take([longest, a, b])
        if depth > 2 and counts[longest] and 3 * longest >= gap:  # triple sums
            for a in reversed(have):
                if not counts[longest] or 3 * a < gap:
                    break
                rest = gap - a
                for b in reversed(have[: bisect_left(have, min(a, rest - 1) + 1)]):
                    c = rest - b
                    if c > b or not counts[longest] or not counts[a]:
                        break
                    if counts[b] and counts[c]:
                        take([longest, a, b, c])
    return found


def best_fit(counts: Counter, capacity: int) -> list[tuple[int, list[int]]]:
    """Best fit decreasing over counts: equal bins are handled as one group."""
    bins: dict[int, list[tuple[int, list]]] = defaultdict(list)  # gap -> [(bins, [(length, times)])]
    gaps: list[int] = []

    def put(n, inside, gap):
        if n:
            if not bins[gap]:
                insort(gaps, gap)
            bins[gap].append((n, inside))

    for length in sorted((x for x in counts if counts[x]), reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                gap, n, inside = capacity, -(-left // (capacity // length)), []
            else:
                gap = gaps[at]
                n, inside = bins[gap].pop()
                if not bins[gap]:
                    gaps.pop(at)
            times = gap // length
            full = min(n, left // times)
            put(full, [*inside, (length, times)], gap - times * length)
            left -= full * times
            if full < n:
                if left:
                    put(1, [*inside, (length, left)], gap - left * length)
                put(n - full - bool(left), inside, gap)
                left = 0
        counts[length] = 0
    return [(n, [x for x, k in inside for _ in range(k)]) for groups in bins.values() for n, inside in groups]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(times, lengths) patterns that use up the histogram; each sums to ``capacity`` at most.

    Spending short pieces on triples can leave long ones without a partner, so the plan
    is made for every depth of the exact phase and the one with the fewest bins is used.
    """
    plans = []
    for depth in (3, 2, 1, 0):
        counts = Counter({int(k): int(v) for k, v in histogram.items()})
        plans.append(exact_patterns(counts, capacity, depth) + best_fit(counts, capacity))
    return min(plans, key=lambda p: sum(n for n, _ in p))


def slots(patterns) -> dict[int, np.ndarray]:
    """For each length rows (first rank, first sequence, times in it, offset), by first rank."""
    used, out, first = Counter(), defaultdict(list), 0
    for n, lengths in patterns:
        offset = 0
        runs: list[list[int]] = []
        for x in lengths:
            if runs and runs[-1][0] == x:
                runs[-1][1] += 1
            else:
                runs.append([x, 1, offset])
            offset += x
        for x, k, at in runs:
            out[x].append((used[x], first, k, at))
            used[x] += n * k
        first += n
    return {x: np.array(v, np.int64) for x, v in out.items()}


def _place(table):
    def run(batches):
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "_rank"))
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                rows = table[int(x)]
                k = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                within = rank[at] - k[:, 0]
                seq[at] = k[:, 1] + within // k[:, 2]
                off[at] = k[:, 3] + within % k[:, 2] * x
            cols = {n: batch.column(n) for n in batch.schema.names if n != "_rank"}
            cols |= {"sequence_id": pa.array(seq), "offset": pa.array(off)}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def pack(docs: DataFrame, id_col="doc_id", text_col="text", vocab=None, capacity=CAPACITY, end_id=END_ID, with_ids=False) -> DataFrame:
    """Every piece with its sequence_id and its offset there; see ``sequences`` for the token rows."""
    pieces = keep(tokenize(docs, id_col, text_col, vocab, capacity, end_id, with_ids), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    parts = max(1, -(-sum(histogram.values()) // PART_ROWS))
    rows = pieces.withColumn("_part", F.pmod(F.xxhash64("_id", "piece"), F.lit(parts)))
    sizes = rows.groupBy("length", "_part").count()
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    order = Window.partitionBy("length", "_part").orderBy("_id", "piece", "start", "ids_crc32")
    ranked = rows.withColumn("_n", F.row_number().over(order)).join(sizes, ["length", "_part"])
    ranked = ranked.select(*pieces.columns, (F.col("_before") + F.col("_n") - 1).cast("bigint").alias("_rank"))
    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id bigint, offset bigint"
    return ranked.mapInArrow(_place(slots(plan(histogram, capacity))), schema).withColumnRenamed("_id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """The token rows themselves: sequence_id, ids (of ``pack(..., with_ids=True)``)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # a sequence holds capacity tokens at most
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
