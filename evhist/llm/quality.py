"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into quantile bins.  Cyclic boosting visits the features in turn,
fits one shallow tree on that feature's bins to the logistic gradient and adds it to the
feature's lookup table; then the strongest pairs get two-way tables the same way.  A
score is a sum of table entries, so scoring is a vectorised addition per bin column.

Features are counted over whole texts, in blocks of bytes.  The model is fitted on a
bounded sample of labelled rows: the ``max_rows`` rows with the smallest hash of their
id (a documented parameter).  Only those few numbers per row reach the driver.

Defined results: null and empty texts have all-zero counts and are scored like any
other; labels that are null or not 0/1 are ignored; without labelled rows, or with one
class only, the score is the smoothed share of label 1 (1 when there is none at all);
repeated rows are scored each; an empty table gives no rows; columns other than id and
text are never read, unless asked to be carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, byte_view, keep, shingles, words

MAX_ROWS = 20_000
BINS = 48
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 150
RATE = 0.15

_CLASSES = ("upper", "lower", "digit", "space", "newline", "stop", "bang", "pipe", "symbol", "high", "control")
_CLASS = np.zeros(256, np.uint8)
for _i, _members in enumerate((range(0x41, 0x5B), range(0x61, 0x7B), range(0x30, 0x3A), b" \t\r", b"\n", b".,;:'\"-()?", b"!", b"|", b"#$%&*@^~<>{}[]\\/+=_`", range(0x80, 0x100), [])):
    for _b in _members:
        _CLASS[_b] = _i
_CLASS[[b for b in range(32) if b not in (9, 10, 13)] + [127]] = len(_CLASSES) - 1

FEATURES = (
    "log_bytes", "log_words", "mean_word", "upper", "digit", "space", "newline", "stop", "bang", "pipe", "symbol",
    "high", "control", "repeat_word", "distinct_words", "top_word", "distinct_trigrams", "short_words", "long_words",
)


def _distinct(keys: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct keys per document, and the count of the commonest."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    packed = np.sort((doc.astype(np.uint64) << np.uint64(44)) | (keys >> np.uint64(20)))
    heads = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
    runs = np.diff(np.append(heads, len(packed)))
    owner = (packed[heads] >> np.uint64(44)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, owner, runs)
    return np.bincount(owner, minlength=n).astype(float), top


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, features) matrix of a block of texts."""
    n, lens = len(offsets) - 1, np.diff(offsets)
    k = len(_CLASSES)
    doc = np.repeat(np.arange(n), lens)
    count = np.bincount(doc * k + _CLASS[data], minlength=n * k).reshape(n, k).astype(float)
    starts, ends, hashes, firsts = words(data, offsets)
    n_words = np.diff(firsts)
    owner = np.repeat(np.arange(n), n_words)
    width = ends - starts
    per = lambda mask: np.bincount(owner[mask], minlength=n).astype(float)
    same = np.zeros(len(hashes), bool)
    if len(hashes):
        same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    distinct, top = _distinct(hashes, owner, n)
    grams, n_grams = shingles(hashes, firsts, 3)
    tri, _ = _distinct(grams, np.repeat(np.arange(n), n_grams), n)
    byte, word, letters = np.maximum(lens, 1), np.maximum(n_words, 1), np.maximum(count[:, 0] + count[:, 1], 1)
    share = dict(zip(_CLASSES, (count / byte[:, None]).T))
    cols = [np.log2(1 + lens), np.log2(1 + n_words), np.bincount(owner, weights=width, minlength=n) / word, count[:, 0] / letters]
    cols += [share[c] for c in ("digit", "space", "newline", "stop", "bang", "pipe", "symbol", "high", "control")]
    cols += [per(same) / word, distinct / word, top / word, tri / np.maximum(n_grams, 1), per(width <= 3) / word, per(width >= 12) / word]
    return np.stack(cols, 1).astype(np.float32)


# ---- model


class Model:
    """Intercept, per-feature bins and tables, and two-way tables."""

    def __init__(self, edges, pair_edges):
        self.edges, self.pair_edges = edges, pair_edges
        self.bias = 0.0
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []

    def bins(self, x):
        return [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)]

    def pair_bins(self, x):
        return {j: np.searchsorted(self.pair_edges[j], x[:, j], "right") for p in self.pairs for j in p[:2]}

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for table, b in zip(self.tables, self.bins(x)):
            z += table[b]
        coarse = self.pair_bins(x)
        for i, j, table in self.pairs:
            z += table[coarse[i], coarse[j]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Quantile cuts halfway between neighbouring values."""
    out = []
    for j in range(x.shape[1]):
        v = np.unique(x[:, j].astype(np.float64))
        q = np.unique(np.quantile(x[:, j].astype(np.float64), np.linspace(0, 1, bins + 1)[1:-1], method="higher"))
        at = np.searchsorted(v, q)
        at = at[at > 0]
        out.append(np.unique((v[at] + v[at - 1]) / 2) if len(at) else np.zeros(0))
    return out


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, l2: float) -> np.ndarray:
    """Values of a shallow tree over ordered bins, grown by the best split."""
    parts, gain_of = [(0, len(g))], lambda a, b: a * a / (b + l2)
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            cut = np.arange(a + 1, b)
            left, right = gain_of(cg[cut] - cg[a], ch[cut] - ch[a]), gain_of(cg[b] - cg[cut], ch[b] - ch[cut])
            gain = left + right - gain_of(cg[b] - cg[a], ch[b] - ch[a])
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (gain[i], k, int(cut[i]))
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + l2)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Best depth-two tree over a two-way grid: one cut of the rows, a cut of the columns on either side."""
    best, table = 0.0, np.zeros_like(g)
    for r in range(1, g.shape[0]):
        total, values = 0.0, np.zeros_like(g)
        for side in (slice(0, r), slice(r, g.shape[0])):
            cg, ch = np.cumsum(g[side].sum(0)), np.cumsum(h[side].sum(0))
            left = cg[:-1] ** 2 / (ch[:-1] + l2)
            right = (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + l2)
            if not len(left):
                continue
            c = int(np.argmax(left + right))
            total += left[c] + right[c]
            values[side, : c + 1] = cg[c] / (ch[c] + l2)
            values[side, c + 1 :] = (cg[-1] - cg[c]) / (ch[-1] - ch[c] + l2)
        if total > best:
            best, table = total, values
    return best, table


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, pairs: int = PAIRS, l2: float = 5.0) -> Model:
    """Cyclic boosting of per-feature tables, then of the strongest pairs."""
    if not len(y):
        model = Model([np.zeros(0)] * x.shape[1], [np.zeros(0)] * x.shape[1])
        model.bias = 30.0
        return model
    model = Model(_edges(x, BINS), _edges(x, PAIR_BINS))
    share = (y.sum() + 0.5) / (len(y) + 1)
    model.bias = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return model
    z, bins = np.full(len(y), model.bias), model.bins(x)

    def gradient():
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, b in enumerate(bins):
            n = len(model.tables[j])
            if n < 2:
                continue
            g, h = gradient()
            step = rate * _tree(np.bincount(b, g, n), np.bincount(b, h, n), 4, l2)
            model.tables[j] += step
            z += step[b]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.pair_edges)]
    shape = [len(e) + 1 for e in model.pair_edges]

    def grid(i, j):
        g, h = gradient()
        at, n = coarse[i] * shape[j] + coarse[j], shape[i] * shape[j]
        return (np.bincount(at, v, n).reshape(shape[i], shape[j]) for v in (g, h))

    ranked = sorted(((_quadrants(*grid(i, j), l2)[0], i, j) for i in range(len(shape)) for j in range(i) if shape[i] > 1 and shape[j] > 1), reverse=True)[:pairs]
    model.pairs = [(i, j, np.zeros((shape[i], shape[j]))) for _, i, j in ranked]
    for _ in range(rounds // 4):
        for i, j, table in model.pairs:
            step = rate * _quadrants(*grid(i, j), l2)[1]
            table += step
            z += step[coarse[i], coarse[j]]
    return model


# ---- Spark


def _measure(with_model):
    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column("_text"))
            parts = [features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in blocks(offsets)]
            x = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)), np.float32)
            cols = {n: batch.column(n) for n in batch.schema.names if n != "_text"}
            if with_model is None:
                cols["_x"] = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float32()))
            else:
                cols["_score"] = pa.array(with_model.score(x))
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def _score(model):
    def run(batches):
        for batch in batches:
            x = batch.column("_x")
            x = np.asarray(x.flatten()).reshape(len(x), len(FEATURES)) if len(x) else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(model.score(x))], names=["_id", "_score"])

    return run


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Feature vectors (_id, _x) of all documents, written to the shared folder."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    return keep(rows.mapInArrow(_measure(None), f"_id {dict(rows.dtypes)['_id']}, _x array<float>"), "features")


def train(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled documents outside the held-out third."""
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_y IN (0, 1)").where(~held_out("_id"))
    sample = measured.join(marks, "_id").orderBy(F.xxhash64("_id"), "_id", "_y").limit(max_rows).select("_x", "_y").toPandas()
    x = np.stack(sample["_x"].to_list()) if len(sample) else np.zeros((0, len(FEATURES)))
    return fit(x.astype(np.float32), sample["_y"].to_numpy(float))


def held_out(column):
    """True where crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> DataFrame:
    """id, held_out, score, predicted of every document."""
    measured = measure(docs, id_col, text_col)
    model = train(measured, labels, id_col, max_rows=max_rows)
    out = measured.mapInArrow(_score(model), f"_id {dict(measured.dtypes)['_id']}, _score double")
    return out.select(F.col("_id").alias(id_col), held_out("_id").alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def accept(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns unchanged."""
    model = train(measure(docs, id_col, text_col), labels, id_col, max_rows=max_rows)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumn("_text", F.col(names[docs.columns.index(text_col)]).cast("binary"))
    schema = ", ".join(f"{n} {t}" for n, (_, t) in zip(names, docs.dtypes)) + ", _score double"
    return rows.mapInArrow(_measure(model), schema).where("_score >= 0.5").drop("_score").toDF(*docs.columns)
