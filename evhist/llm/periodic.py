"""Periodic runs of words, by branching tandem repeats of an enhanced suffix array.

A run is a maximal stretch of words with smallest period q, at least two periods and
``least`` words long.  Every run ends in exactly one branching tandem repeat of its
period: places i and i + q whose suffixes share exactly q words, since the word after
the run breaks the period.

1. Suffix array.  The texts of a block are sorted together, each word numbered within
   its text and each text closed by an end of its own, so no match crosses texts.  Sorting
   doubles the compared length and goes on only with places that are not yet alone.  The
   ranks of each doubling stay: they compare any two stretches by their binary lengths.
2. LCP intervals.  Children of an interval lie between its boundaries, the entries of
   the LCP array that equal its depth; nearest smaller entries give both.  All intervals
   are handled as arrays, there are no tree nodes.
3. Branching test.  Every suffix i of all children but the largest asks whether
   ISA[i + depth] and ISA[i - depth] lie in the same interval but another child.  A
   suffix is asked O(log n) times.
4. Rotation.  Each repeat found is turned to the left as far as the words allow, in
   O(log n) comparisons of ranks.  Repeats that end up on the same stretch are one run,
   its period the least among them.

Texts are independent, so documents stay where they were read: no shuffle, no key that
could be hot.  A block holds texts of about ``BLOCK`` bytes together; a longer text is a
block of its own, with about 100 + 4 log2(words) bytes of memory a word.

Defined results: null and empty texts have no words and no runs; a null or repeated id
is a row like any other; of equally long runs the one that starts first, then the one of
smaller period comes first; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, byte_view, spans, spelled

LEAST = 12
BLOCK = 1 << 20

# FIXED VALUES: the bytes between words.
_SPACE = np.zeros(256, bool)
_SPACE[0x09:0x0E] = _SPACE[0x20] = True
SEPARATORS = r"[\x20\x09-\x0D]+"


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text and their number, codes) of the words in ``data``.

    Equal words have equal codes, by Arrow's dictionary; no hash decides.
    """
    starts, ends, firsts = spans(~_SPACE[data], offsets)
    codes = pc.dictionary_encode(spelled(data, starts, ends)).indices.to_numpy()
    return starts, ends, firsts, codes.astype(np.int64)


class Ranks:
    """Suffix order of all texts in a block, and equality of any two stretches.

    ``levels[k]`` holds numbers that are equal for two places exactly if the 2**k words
    from there on are equal; a stretch over its text's end equals no other.
    """

    def __init__(self, codes: np.ndarray, firsts: np.ndarray):
        n = self.n = len(codes)
        text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        self.begin, self.end = firsts[:-1][text], firsts[1:][text]
        key = text * (int(codes.max()) + 1) + codes if n else codes
        self.levels = [self._ranked(key, np.zeros(n, np.int64))]
        size = 1
        while True:
            rank = self.levels[-1]
            live = np.flatnonzero((np.bincount(rank, minlength=n) > 1)[rank])
            if not len(live):
                break
            after = live + size
            inside = after < self.end[live]
            tail = np.zeros(len(live), np.int64)  # the end sorts before every word
            tail[inside] = rank[after[inside]] + 1
            head = rank[live].astype(np.int64)
            new = rank.copy()
            new[live] = self._ranked(head * (n + 1) + tail, head)
            self.levels.append(new)
            size *= 2
        self.place = self.levels[-1]  # the inverse suffix array
        self.order = np.empty(n, np.int64)
        self.order[self.place] = np.arange(n)

    @staticmethod
    def _ranked(key: np.ndarray, head: np.ndarray) -> np.ndarray:
        """Rank of each member: the head of its group plus the members of it with smaller keys.

        Keys of a group with a smaller head are smaller.
        """
        order = np.argsort(key)
        key, head = key[order], head[order]
        at = np.arange(len(key))
        opens, differs = np.ones(len(key), bool), np.ones(len(key), bool)
        opens[1:] = head[1:] != head[:-1]
        differs[1:] = key[1:] != key[:-1]
        since = lambda marks: np.maximum.accumulate(np.where(marks, at, 0))  # noqa: E731  the last mark up to here
        out = np.empty(len(key), np.int32)
        out[order] = head + since(differs) - since(opens)
        return out

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of words that the suffixes from ``a`` and from ``b`` share."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a + out, b + out
            ok = np.flatnonzero((x < self.end[a]) & (y < self.end[b]))
            rank = self.levels[k]
            out[ok[rank[x[ok]] == rank[y[ok]]]] += 1 << k
        return out

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words before ``a`` and before ``b``, places of one text."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a - out - (1 << k), b - out - (1 << k)
            ok = np.flatnonzero(np.minimum(x, y) >= self.begin[a])
            rank = self.levels[k]
            out[ok[rank[x[ok]] == rank[y[ok]]]] += 1 << k
        return out


class Minima:
    """Nearest smaller values, by least values of stretches of binary lengths."""

    def __init__(self, values: np.ndarray, longest: int):
        """Stretches without a smaller value have at most ``longest`` values."""
        self.least = [values]
        for k in range(int(longest).bit_length()):
            low = self.least[-1]
            if len(low) <= 1 << k:
                break
            self.least.append(np.minimum(low[: -(1 << k)], low[1 << k :]))

    def before(self, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The last place before ``at`` with a value below ``limit``; there is one."""
        out = at.copy()
        for k in range(len(self.least) - 1, -1, -1):
            ok = np.flatnonzero(out >= 1 << k)
            x = out[ok] - (1 << k)
            go = self.least[k][x] >= limit[ok]
            out[ok[go]] = x[go]
        return out - 1

    def after(self, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The first place after ``at`` with a value below ``limit``; there is one."""
        out = at + 1
        for k in range(len(self.least) - 1, -1, -1):
            ok = np.flatnonzero(out < len(self.least[k]))
            go = ok[self.least[k][out[ok]] >= limit[ok]]
            out[go] += 1 << k
        return out


def tandem_repeats(ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of every branching tandem repeat, each once."""
    n = ranks.n
    none = np.zeros(0, np.int64)
    if n < 2:
        return none, none
    lcp = np.zeros(n + 1, np.int64)  # lcp[j]: words that suffixes j - 1 and j of the order share
    lcp[0] = lcp[n] = -1
    lcp[1:n] = ranks.forward(ranks.order[:-1], ranks.order[1:])
    cut = np.flatnonzero(lcp > 0)  # the boundaries of all intervals with a depth
    if not len(cut):
        return none, none
    depth = lcp[cut]
    minima = Minima(lcp, int((ranks.end - ranks.begin).max()))
    low, high = minima.before(cut, depth), minima.after(cut, depth)  # the interval is [low, high)
    # children: one to the right of each boundary, and one before the first boundary
    opening = minima.before(cut, depth + 1) == low
    child = [np.concatenate([cut, low[opening]]), np.concatenate([minima.after(cut, depth + 1), cut[opening]])]
    depth, low, high = (np.concatenate([x, x[opening]]) for x in (depth, low, high))
    size = child[1] - child[0]
    # leave out the largest child of each interval (one interval: same bounds)
    order = np.lexsort((-size, high, low))
    largest = np.ones(len(order), bool)
    largest[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
    use = order[~largest]
    found = []
    step = 0
    total = np.cumsum(size[use])
    while step < len(use):  # in portions, so that the lists stay small
        stop = max(step + 1, int(np.searchsorted(total, (total[step - 1] if step else 0) + (1 << 21), "right")))
        part = use[step:stop]
        each = np.repeat(part, size[part])
        inner = np.arange(len(each)) - np.repeat(np.cumsum(size[part]) - size[part], size[part])
        i = ranks.order[child[0][each] + inner]
        for sign in (1, -1):
            j = i + sign * depth[each]
            ok = np.flatnonzero((j >= ranks.begin[i]) & (j < ranks.end[i]))
            p, e = ranks.place[j[ok]], each[ok]
            hit = (p >= low[e]) & (p < high[e]) & ~((p >= child[0][e]) & (p < child[1][e]))
            found.append(np.minimum(i[ok], j[ok])[hit] * n + depth[e][hit])
        step = stop
    return np.divmod(np.unique(np.concatenate(found)), n) if found else (none, none)


def find_runs(codes: np.ndarray, firsts: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of all texts, by start and period; places in the block."""
    ranks = Ranks(codes, firsts)
    place, period = tandem_repeats(ranks)
    start = place - ranks.backward(place, place + period)
    end = place + 2 * period
    long = end - start >= least
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    own = np.ones(len(start), bool)
    own[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[own], end[own], period[own]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words joined by one space, a slice of words at a time."""
    out = []
    for i in range(0, len(starts), 1 << 16):
        a, b = int(starts[i]), int(ends[min(i + (1 << 16), len(starts)) - 1])
        raw = data[a:b].tobytes()
        out.append(b" ".join([raw[x:y] for x, y in zip((starts[i : i + (1 << 16)] - a).tolist(), (ends[i : i + (1 << 16)] - a).tolist())]))
    return b" ".join(out)


def _scanner(least: int, block: int):
    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column("_text"))
            for i, j in blocks(offsets, block):
                a = int(offsets[i])
                part, cuts = data[a : int(offsets[j])], offsets[i : j + 1] - a
                starts, ends, firsts, codes = split_words(part, cuts)
                s, e, p = find_runs(codes, firsts, least)
                edges = np.zeros(len(starts) + 1, np.int64)  # dropped: all of a run but its first period
                np.add.at(edges, s + p, 1)
                np.add.at(edges, e, -1)
                kept = np.cumsum(edges)[:-1] == 0
                text = np.searchsorted(firsts, s, "right") - 1
                s, e = s - firsts[text], e - firsts[text]
                bounds = np.searchsorted(text, np.arange(j - i + 1))
                runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(s), pa.array(e - s), pa.array(p.astype(np.int64))], names=["start", "length", "period"]))
                collapsed = []
                for k in range(j - i):
                    own = slice(int(firsts[k]), int(firsts[k + 1]))
                    stay = kept[own]
                    collapsed.append(_joined(part, starts[own][stay], ends[own][stay]))
                cols = {"_row": batch.column("_row").slice(i, j - i), "n_words": pa.array(np.diff(firsts), pa.int64()), "runs": runs, "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string())}
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """id, n_words, runs (start, length, period; by start, then period) and the collapsed text of every row.

    The collapsed text has the words, joined by one space, that no run contains after
    its first period.  ``block`` is the size in bytes of the texts sorted together.
    """
    rows = docs.select(F.col(id_col).alias("_row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    t = dict(rows.dtypes)["_row"]
    out = rows.mapInArrow(_scanner(least, block), f"_row {t}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
    return out.withColumnRenamed("_row", id_col)


def planted(text: Column, doc_id: Column) -> Column:
    """``text`` as a column in which every tenth id's words repeat from some word on.

    Let h be the CRC-32 of the id's digits and g = h // 10.  Where h ends in 0 and there
    are n > 0 words, those from a = g % n on repeat with period 1 + (n - a) // (3 + g % 8).
    Built from whole slices, so it takes time in proportion to the text.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1), "")
    n = F.size(words)
    g = F.floor(h / 10)
    a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    turns = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    repeated = F.concat(F.slice(words, F.lit(1), a), F.slice(turns, F.lit(1), n - a))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(repeated, " ")).otherwise(text)


def run_report(docs: DataFrame) -> DataFrame:
    """Number of runs, the longest one and digests of every document with planted repeats."""
    rows = docs.select("doc_id", planted(F.col("text").cast("string"), F.col("doc_id")).alias("text"))
    # the longest; of these the first, then the smallest period (runs come in that order)
    top = F.array_max(F.transform("runs", lambda r, i: F.struct(r["length"], -i)))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    out = periodic_runs(rows).withColumn("_best", F.get("runs", -top["col2"]))
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col("_best")[c].alias(c) for c in ("start", "length", "period")),
        F.expr("1000L * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
