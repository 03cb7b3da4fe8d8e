import numpy as np
import pytest
from pyspark.sql import functions as F

from evhist.llm.topk import ImpactIndex, top_k

from .conftest import SF01

SCHEMA = "vec_id long, embedding array<float>, v int, id string"


def brute(rows, k=10):
    """Every row is a candidate, repeated ones too; the rows of a query's id share its places."""
    x = [(i, [int(np.floor(1024 * float(c))) for c in np.asarray(v, np.float32)]) for i, v in rows]
    found = {}
    for q, a in x:
        if q % 100 == 0:
            found.setdefault(q, []).extend((-sum(m * n for m, n in zip(a, b)), c) for c, b in x if c != q)
    return {(q, r + 1, c, -s) for q, best in found.items() for r, (s, c) in enumerate(sorted(best)[:k])}


def got(df):
    return {(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(df, F.col("id") % 100 == 0).collect()}


def test_sample_table(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    assert got(df) == brute([(r.vec_id, r.embedding) for r in df.collect()])


def test_ties_repeats_and_broken_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(350)]
    extra = [(900, None), (901, [1.0, None, 2.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (None, [9.0] * 6), rows[7], rows[7], (100, rows[100][1])]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows + extra], SCHEMA)
    assert got(df) == brute(rows + extra[5:])
    assert got(df.where("vec_id < 4")) == brute(rows[:4])
    assert got(df.limit(0)) == set()


def test_repeats_and_large_values_agree_with_the_sql(spark, tmp_path):
    import duckdb

    from evhist.llm.queries import SQL

    rows = [(0, [1.0, 2.0])] * 2 + [(0, [3.0, -1.0])] + [(1, [1.0, 1.0])] * 2 + [(2, [2.0, 0.0]), (100, [0.0, 1.0])] + [(7, [0.5, 0.25])] * 15
    rows += [(8, [2.0**50, 1.0]), (9, [-(2.0**50), 3.0])]  # past 2**52 once scaled, scores fit
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "vec_id long, embedding array<double>, v int, id string")
    df.select("vec_id", "embedding").coalesce(1).write.parquet(f"{tmp_path}/e")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/e/*.parquet'")
    small = df.where("abs(embedding[0]) < 100")
    assert got(small) == brute([r for r in rows if abs(r[1][0]) < 100])
    held = rows[3:7] + rows[-2:]  # 100 is the query here, its first component 0
    df = spark.createDataFrame([(*r, 1, "z") for r in held], "vec_id long, embedding array<double>, v int, id string")
    assert got(df) == brute(held)
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{tmp_path}/e/*.parquet' WHERE abs(embedding[1]) < 100")
    con.execute(f"SELECT query_id, rank, vec_id, score FROM ({SQL['op10_exact_topk']})")
    assert got(small) == set(con.fetchall())


def test_ragged_and_large_components(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0]), (2, [1.0, 1.0, 5.0]), (3, []), (4, [2.0**30, 1.0])]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA)
    wide = [(i, v + [0.0] * (3 - len(v))) for i, v in rows]
    assert got(df) == brute(wide)


@pytest.mark.parametrize("kind", ["clustered", "heavy"])
def test_search_stops_early_and_stays_exact(kind):
    rng = np.random.default_rng(3)
    if kind == "clustered":
        x = (rng.normal(size=(40, 32))[rng.integers(40, size=4000)] * 300 + rng.normal(size=(4000, 32)) * 20).astype(np.int64)
    else:
        x = (rng.standard_t(2, size=(4000, 32)) * 100).astype(np.int64)
    index = ImpactIndex(x)
    for i in range(20):
        rows, score = index.search(x[i], 10, np.arange(4000) == i)
        truth = np.sort(np.delete(x @ x[i], i))[::-1][:10]
        assert np.sort(score)[::-1][:10].tolist() == truth.tolist()
        assert len(rows) < 4000


@pytest.mark.parametrize("kind", ["clustered", "heavy", "dense"])
def test_bounds_leave_few_vectors_to_rescore(kind):
    rng = np.random.default_rng(3)
    if kind == "clustered":
        x = (rng.normal(size=(40, 32))[rng.integers(40, size=4000)] * 300 + rng.normal(size=(4000, 32)) * 20).astype(np.int64)
    elif kind == "heavy":
        x = (rng.standard_t(2, size=(4000, 32)) * 100).astype(np.int64)
    else:
        x = (rng.normal(size=(4000, 64)) * 128).astype(np.int64)
    index = ImpactIndex(x)
    left, visited = [], []
    for i in range(20):
        rows, score = index.search(x[i], 10, np.arange(4000) == i)
        assert np.sort(score)[::-1][:10].tolist() == np.sort(np.delete(x @ x[i], i))[::-1][:10].tolist()
        left.append(len(rows)), visited.append(index.visited)
    assert max(left) <= 128  # of 4000
    assert np.mean(visited) < {"clustered": 0.4, "heavy": 0.6, "dense": 0.95}[kind]  # of the postings, when proof ended the search


@pytest.mark.parametrize("kind", ["clustered", "dense"])
def test_bounds_are_taken_once_or_twice_a_query(kind, monkeypatch):
    """A block starts as deep as its query before had to go, not at the first part again."""
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(40, 64))[rng.integers(40, size=4000)] * 300 + rng.normal(size=(4000, 64)) * 20 if kind == "clustered" else rng.normal(size=(4000, 64)) * 128).astype(np.int64)
    x[:, 7] = 0
    index, calls, plain = ImpactIndex(x), [], ImpactIndex._bounds
    monkeypatch.setattr(ImpactIndex, "_bounds", lambda self, q, met, rest: calls.append(met.sum()) or plain(self, q, met, rest))
    for i in range(60):
        q = -x[i] if i % 3 == 0 else x[i] * (np.arange(64) % 5 > 0)
        rows, score = index.search(q, 10, np.arange(4000) == i)
        assert np.sort(score)[::-1][:10].tolist() == np.sort(np.delete(x @ q, i))[::-1][:10].tolist()
    assert len(calls) <= 60 * 2 + 8


def test_component_that_does_not_fit_is_an_error(spark):
    df = spark.createDataFrame([(0, [1.0], 1, "z"), (1, [2.0**52], 1, "z")], SCHEMA)
    with pytest.raises(Exception, match="does not fit"):
        got(df)


def test_blocks_meet_queries_without_a_broadcast(spark, monkeypatch):
    """Queries times blocks are never a table, least of all one that the driver sends out."""
    from evhist.llm import topk

    plans, keep = {}, topk.keep
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "keep", lambda df, name: plans.update({name: df._jdf.queryExecution().sparkPlan().toString()}) or keep(df, name))
    rng = np.random.default_rng(7)
    rows = [(i, rng.integers(-9, 9, 8).astype(float).tolist()) for i in range(650)]
    assert got(spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA)) == brute(rows)
    assert "Broadcast" not in plans["block-best"] and "explode" not in plans["block-best"]
