"""Language identification by sparse multinomial logistic regression.

Features are the TF-IDF weights of hashed character n-grams (1 to 4 bytes of lower-cased
UTF-8, so letters with accents are grams of their own), length-normalised.  Document
frequencies are counted over all training documents.  The weights are trained by
follow-the-regularised-leader (per-coordinate rates, L1 and L2 penalties: the elastic
net leaves most weights exactly zero), then one temperature is fitted on rows that the
training left out, so that scores are probabilities.

The model is fitted on a bounded sample: per language the ``per_class`` training
documents with the smallest hash of their id.  Their sparse vectors (at most ``BUCKETS``
entries each) meet in one task; the driver sees the weights only.

Defined results: null text and text without any letter are ``und`` with score 0; null
langs are not learned; with no training document at all every text is ``und``; a single
language is predicted with score 1; repeated rows are predicted each; an empty table
gives no rows; lang, source and ids are never inputs; long texts count whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _LOWER, blocks, byte_view, keep, mix64

BUCKETS = 1 << 13
ORDERS = (1, 2, 3, 4)
PER_CLASS = 1500
EPOCHS = 3
U = np.uint64


def grams(data: np.ndarray) -> np.ndarray:
    """Bucket of every n-gram that starts at each byte; -1 where the text ends before."""
    low = _LOWER[data].astype(U)
    n = len(low)
    out = np.full((len(ORDERS), n), -1, np.int32)
    value = np.zeros(n, U)
    for k in range(max(ORDERS)):
        value[: n - k] = (value[: n - k] << U(8)) | low[k:]
        if k + 1 in ORDERS and n > k:
            h = (value[: n - k] + U((k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * U(0xBF58476D1CE4E5B9)
            out[ORDERS.index(k + 1), : n - k] = (h >> U(64 - 13)).astype(np.int32)
    return out


def counts(data: np.ndarray, offsets: np.ndarray):
    """Per text (buckets, log-scaled counts) over whole texts."""
    table = grams(data)
    for r in range(len(offsets) - 1):
        a, b = offsets[r], offsets[r + 1]
        total = np.zeros(BUCKETS, np.int64)
        for k, order in enumerate(ORDERS):
            if b - a >= order:
                total += np.bincount(table[k, a : b - order + 1], minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield at.astype(np.int32), (1 + np.log(total[at])).astype(np.float32)


def _vectors(text):
    data, offsets = byte_view(text)
    for i, j in blocks(offsets):
        yield from counts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


def weigh(at, tf, idf):
    """TF-IDF values of one text, of length one."""
    x = tf * idf[at]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


# ---- training


class FTRL:
    """Follow the regularised leader, per coordinate, with a softmax over classes."""

    def __init__(self, classes: int, size: int = BUCKETS + 1, alpha=0.5, beta=1.0, l1=1e-3, l2=1e-3):
        self.z, self.n = np.zeros((size, classes)), np.zeros((size, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        w[np.abs(z) <= self.l1] = 0.0
        return w

    def step(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[y] -= 1.0
        g = x[:, None] * p[None, :]
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log likelihood, by golden-section search on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t):
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

    a, b, g = -4.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """(weights with the intercept last, temperature) from unit vectors; a fifth calibrates."""
    one = lambda at, x: (np.append(at, BUCKETS), np.append(x, 1.0))
    rows = [one(*r) for r in rows]
    rng = np.random.default_rng(7)
    order = rng.permutation(len(rows))
    held = order[: len(rows) // 5]
    model = FTRL(classes)
    for _ in range(epochs):
        for i in rng.permutation(order[len(held) :]):
            model.step(*rows[i], y[i])
    w = model.weights()
    logits = np.array([rows[i][1] @ w[rows[i][0]] for i in held]).reshape(-1, classes)
    return w, temperature(logits, y[held])


# ---- Spark


def _frequencies(batches):
    df, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for at, _ in _vectors(batch.column("_text")):
            df[at] += 1
            n += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], n), pa.int64())], names=["bucket", "df"])


def _sparse(batches):
    for batch in batches:
        found = list(_vectors(batch.column("_text")))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_y"), batch.column("_o"), pa.array([a for a, _ in found], pa.list_(pa.int32())), pa.array([x for _, x in found], pa.list_(pa.float32()))],
            names=["_y", "_o", "at", "tf"])


def _train(langs, idf):
    def run(batches):
        rows, y = [], []
        for batch in batches:
            for lang, at, tf in zip(batch.column("_y").to_pylist(), batch.column("at"), batch.column("tf")):
                at, tf = np.array(at.values, np.int32), np.array(tf.values, np.float64)
                rows.append((at, weigh(at, tf, idf)))
                y.append(langs.index(lang))
        if not rows:
            return
        w, t = fit(rows, np.array(y), len(langs))
        at = np.flatnonzero(np.abs(w).sum(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array([*w[at].tolist(), [t]], pa.list_(pa.float64()))], names=["bucket", "w"])

    return run


def _predict(langs, idf, w, t):
    dense = (w[:BUCKETS] * idf[:, None] if len(langs) else w).astype(np.float32)

    def run(batches):
        for batch in batches:
            lang, score = [], []
            letters = batch.column("_letters").to_pylist()
            for ok, (at, tf) in zip(letters, _vectors(batch.column("_text"))):
                if not ok or not langs:
                    lang.append("und"), score.append(0.0)
                    continue
                x = tf * idf[at]
                norm = float(np.sqrt((x * x).sum())) or 1.0
                p = softmax((tf @ dense[at] / norm + w[BUCKETS]) / t)
                k = int(np.argmax(p))
                lang.append(langs[k]), score.append(float(p[k]))
            cols = {n: batch.column(n) for n in batch.schema.names if n not in ("_text", "_letters")}
            cols |= {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def held_out(column):
    """True where crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_class: int = PER_CLASS) -> DataFrame:
    """id, held_out, lang_pred, score of every row."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"), F.col(lang_col).cast("string").alias("_y"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    rows = rows.withColumn("_held", held_out("_id"))
    train = rows.where("NOT _held AND _y IS NOT NULL AND _letters")
    df = train.select("_text").mapInArrow(_frequencies, "bucket int, df bigint").groupBy("bucket").agg(F.sum("df").alias("df")).collect()  # BUCKETS + 1 numbers at most
    seen = {r["bucket"]: r["df"] for r in df}
    idf = np.zeros(BUCKETS, np.float32)
    total = seen.pop(-1, 0)
    for b, n in seen.items():
        idf[b] = np.log((1 + total) / (1 + n)) + 1
    # the sample is found on narrow rows: per language a cutoff of the hash, then the texts below it
    train = train.withColumn("_o", F.xxhash64("_id"))
    order = Window.partitionBy("_y").orderBy("_o")
    cutoffs = train.select("_y", "_o").distinct().withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= per_class)
    cutoffs = cutoffs.groupBy("_y").agg(F.max("_o").alias("_cut"))
    below = train.join(F.broadcast(cutoffs), "_y").where("_o <= _cut")  # one row per language
    sample = below.select("_y", "_o", "_text").mapInArrow(_sparse, "_y string, _o bigint, at array<int>, tf array<float>")
    sample = keep(sample.dropDuplicates(["_y", "_o"]), "lang-sample")
    langs = sorted(r["_y"] for r in sample.select("_y").distinct().collect())
    model = sample.repartition(1).sortWithinPartitions("_o", "_y").mapInArrow(_train(langs, idf), "bucket int, w array<double>").collect() if langs else []  # a bounded sample
    w, t = np.zeros((BUCKETS + 1, len(langs)), np.float64), 1.0
    for r in model:
        if r["bucket"] < 0:
            t = r["w"][0]
        else:
            w[r["bucket"]] = r["w"]
    out = rows.select("_id", "_held", "_text", "_letters").mapInArrow(_predict(langs, idf, w, t), f"_id {dict(rows.dtypes)['_id']}, _held boolean, lang_pred string, score double")
    return out.select(F.col("_id").alias(id_col), F.col("_held").alias("held_out"), "lang_pred", "score")
