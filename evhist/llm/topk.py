"""Exact top-k search by an impact-ordered, score-at-a-time index.

Vectors become integers, floor(1024 * x).  A block of vectors keeps, for every
dimension, its vectors in order of their component, cut into segments of one quantised
level.  A query visits the segments of all dimensions by descending quantised impact
(the most that the level can add to a score), so what it has visited of a dimension is
one end of that dimension's postings.  A vector's bound is the impact of the next
unvisited segment of every dimension, corrected by the components met.  Work on a block
stops only on proof: when all but a few vectors are bounded below the k-th best exact
score found so far; these few are rescored exactly.  Bounds are first taken as deep as
the block's query before had to go, and one part deeper until the proof holds.

Blocks hold about ``BLOCK`` vectors by hash of vector and id, query blocks ``QUERIES``;
every block meets every query block (a stated query set against all rows), as stored
parts against stored parts: neither is replicated, shuffled or sent by the driver.  Each
block gives k rows a query, ranked at the end.

Defined results: vectors that are null or hold a null or non-finite component, and rows
with a null id take no part; a component that does not fit a long once scaled, or a
score among the k best that does not, is an error; missing trailing components count as 0;
rows alike in id and vector are indexed once with their number and count each in the
ranking; rows that share an id are never candidates of a query with that id, and all rows
of a query's id share its k places; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

BLOCK = 4096
QUERIES = 512
LEVELS = 32
RESCORE = 128  # vectors left undecided that are rescored
TURNS = 8  # bounds are taken at such parts of the postings
K = 10


class ImpactIndex:
    """Segments of every dimension of a block of integer vectors."""

    def __init__(self, x: np.ndarray):
        self.x, self.exact = x, x.astype(np.float64)
        n, dims = x.shape
        self.order = np.ascontiguousarray(np.argsort(x, 0, kind="stable").T.astype(np.int32))  # dimension by dimension
        self.values = np.ascontiguousarray(np.take_along_axis(x, self.order.T.astype(np.int64), 0).T)
        spread = int(x.max()) - int(x.min()) + 1 if x.size else 1
        step = max(1, -(-spread // LEVELS))
        level = np.floor_divide(self.values, step)
        cut = np.ones((dims, n), bool)
        cut[:, 1:] = level[:, 1:] != level[:, :-1]
        self.dim, self.begin = np.nonzero(cut)
        flat = self.dim * n + self.begin
        self.end = np.append(flat[1:], dims * n) - self.dim * n
        low = level[self.dim, self.begin] * step
        self.low, self.high = low, low + step - 1  # what the quantised level admits
        self.order, self.values = self.order.astype(np.int64), self.values.astype(np.float64)
        self.start = 1  # parts of the postings that the query before needed

    def search(self, q: np.ndarray, k: int, barred: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of all possible members of the k best; ``barred`` rows take no part."""
        n, dims = self.x.shape
        most = float(np.abs(self.x).max(initial=0)) * float(np.abs(q).max(initial=0)) * dims
        if not dims or n <= RESCORE or most >= 2.0**50:  # nothing to save, or bounds past exact doubles
            rows = np.flatnonzero(~barred)
            if most < 2.0**62:
                return rows, self.x[rows] @ q
            return rows, self.x[rows].astype(object) @ q.astype(object)  # whole numbers of any size
        weight, exact_q = q[self.dim], q.astype(np.float64)
        impact = np.maximum(weight * self.low, weight * self.high)
        turn = np.argsort(-impact, kind="stable")
        turn = turn[weight[turn] != 0]
        count = (self.end - self.begin)[turn]
        size = np.cumsum(count)
        theta, part = -np.inf, self.start
        while True:
            done = len(turn) if part >= TURNS or not len(turn) else min(len(turn), int(np.searchsorted(size, size[-1] * part / TURNS)) + 1)
            rest = np.zeros(dims)  # the most that a dimension can still add
            if done < len(turn):
                later = turn[done:]
                dim, first = np.unique(self.dim[later], return_index=True)
                rest[dim] = impact[later[first]]
            bound = self._bounds(exact_q, np.bincount(self.dim[turn[:done]], count[:done], dims).astype(np.int64), rest)
            bound[barred] = -np.inf
            best = np.argpartition(-bound, min(k, n - 1))[: k + 1]
            best = best[~barred[best]]
            exact = np.sort(self.exact[best] @ exact_q)[::-1]
            if len(exact) >= k:
                theta = max(theta, float(exact[k - 1]))
            members = np.flatnonzero((bound >= theta) & ~barred)
            if len(members) <= RESCORE or done >= len(turn):
                self.visited = float(size[done - 1] / size[-1]) if done else 0.0  # share of the postings
                self.start = max(1, min(part, TURNS) - (len(members) <= RESCORE // 8))
                return members, (self.exact[members] @ exact_q).astype(np.int64)  # exact below 2**53
            part += 1

    def _bounds(self, q: np.ndarray, met: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """What every row can score: ``met[d]`` postings of the dimensions are visited, the best ones of each."""
        n = len(self.x)
        ends = [(slice(n - m, n) if w > 0 else slice(m)) for w, m in zip(q.tolist(), met.tolist())]
        rows = np.concatenate([o[e] for o, e in zip(self.order, ends)])
        gain = np.concatenate([v[e] for v, e in zip(self.values, ends)])
        gain *= np.repeat(q, met)
        gain -= np.repeat(rest, met)
        return np.bincount(rows, gain, n) + rest.sum()


def _pack(name):
    """One row a block: ids and integer components as bytes."""

    def run(batches):
        now, ids, rows, n = None, [], [], []

        def row():
            dims = max(map(len, rows))
            x = np.zeros((len(rows), dims), np.int64)
            for i, r in enumerate(rows):
                x[i, : len(r)] = r
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()), pa.array([dims], pa.int64()), pa.array([np.array(n, np.int64).tobytes()], pa.binary())], names=[name, "ids", "x", "dims", "n"])

        for batch in batches:
            for block, i, v, c in zip(batch.column(name).to_pylist(), batch.column("id").to_pylist(), batch.column("v"), batch.column("n").to_pylist()):
                if block != now and rows:
                    yield row()
                    ids, rows, n = [], [], []
                now = block
                ids.append(i), n.append(c)
                rows.append(np.asarray(v.values))
        if rows:
            yield row()

    return run


def _search(k):
    def run(batches):
        have, index, ids = None, None, None
        for batch in batches:
            out = []
            for block, raw_ids, raw, dims, raw_n, q_ids, q_raw, q_dims, q_n in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "x", "dims", "n", "q_ids", "q_x", "q_dims", "q_n"))):
                wide = max(dims, q_dims)
                if (block, wide) != have:
                    ids, copies = np.frombuffer(raw_ids, np.int64), np.frombuffer(raw_n, np.int64)
                    x = np.zeros((len(ids), wide), np.int64)
                    x[:, :dims] = np.frombuffer(raw, np.int64).reshape(-1, dims)
                    index, have = ImpactIndex(x), (block, wide)
                names = np.frombuffer(q_ids, np.int64)
                queries = np.zeros((len(names), wide), np.int64)
                queries[:, :q_dims] = np.frombuffer(q_raw, np.int64).reshape(-1, q_dims)
                for name, asked, q in zip(names.tolist(), np.frombuffer(q_n, np.int64).tolist(), queries):
                    rows, score = index.search(q, k, ids == name)
                    order = np.lexsort((ids[rows], -score))[:k] if score.dtype != object else sorted(range(len(rows)), key=lambda j: (-score[j], ids[rows[j]]))[:k]
                    best = [(name, int(ids[rows[j]]), int(score[j]), min(k, asked * int(copies[rows[j]]))) for j in order]
                    if any(abs(s) >= 1 << 63 for _, _, s, _ in best):
                        raise ValueError(f"top_k: a score of query {name} does not fit a long")
                    out += best
            cols = list(zip(*out)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score", "n"])

    return run


def top_k(vectors: DataFrame, queries, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for every row that ``queries`` selects.

    ``queries`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("e")).where("id IS NOT NULL AND e IS NOT NULL")
    scaled = F.transform("e", lambda x: F.floor(x * 1024.0))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    large = F.exists("e", lambda x: F.abs(x) >= 2.0**53)
    fits = F.when(finite & large, F.raise_error(F.lit("top_k: a component of 2**53 or more does not fit")).cast("boolean")).otherwise(finite)
    rows = rows.where(F.coalesce(fits, F.lit(False))).select("id", scaled.alias("v"))
    rows = keep(rows.groupBy("id", "v").agg(F.count(F.lit(1)).alias("n")), "vectors")
    asked = rows.where(queries)
    blocks = max(1, -(-rows.count() // BLOCK))
    q_blocks = max(1, -(-asked.count() // QUERIES))
    place = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("bigint")
    packed = lambda df, n, name: df.withColumn(name, place(n)).repartition(name).sortWithinPartitions(name).mapInArrow(_pack(name), f"{name} bigint, ids binary, x binary, dims bigint, n binary")
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    index = keep(packed(rows, blocks, "block"), "index")
    asked = packed(asked, q_blocks, "q").select(F.col("ids").alias("q_ids"), F.col("x").alias("q_x"), F.col("dims").alias("q_dims"), F.col("n").alias("q_n"))
    pairs = index.hint("shuffle_replicate_nl").crossJoin(keep(asked, "queries"))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")  # rows of a few MB
        partial = keep(pairs.mapInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint, n bigint"), "block-best")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    each = partial.select("query_id", "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("_copy"))
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
