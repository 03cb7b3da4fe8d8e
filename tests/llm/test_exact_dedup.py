import hashlib
from collections import defaultdict

import numpy as np
import pytest

from evhist.llm.exact_dedup import BASES, CHUNK, PRIMES, combine, exact_dedup, fingerprints

TEXTS = [None, "", "a", "a", "a", "b" * 70_000, "b" * 70_000, "b" * 69_999 + "c", "é", "e", "x\x00y", "x\x00y", "A"]


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return {(i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""])) for i, t in rows}


def got(df):
    return {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()}


@pytest.mark.parametrize("primes", [PRIMES, (3, 5)])
def test_matches_brute_force_even_when_fingerprints_collide(spark, primes):
    rows = list(enumerate(TEXTS)) + [(100 + i, "z" * (i % 3) + "ab"[i % 2]) for i in range(12)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _text string")
    assert got(exact_dedup(df, primes=primes)) == brute(rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(7, "q"), (7, "q"), (3, "q"), (None, "q")], "doc_id long, text string")
    rows = exact_dedup(df).collect()
    assert [r.kept for r in rows].count(True) == 1
    assert {(r.keep_id, r.group_size) for r in rows} == {(7, 4)}
    assert exact_dedup(df.limit(0)).count() == 0


def test_fingerprints_compose_across_chunks():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000 * CHUNK + 77, dtype=np.uint8)
    base, prime = BASES[0], PRIMES[0]
    whole = int(fingerprints(data, np.array([0, len(data)]), base, prime)[0])
    cut = 3 * CHUNK + 11
    a, b = (int(fingerprints(x, np.array([0, len(x)]), base, prime)[0]) for x in (data[:cut], data[cut:]))
    assert combine((a, cut), (b, len(data) - cut), base, prime) == (whole, len(data))
    slow = 0
    for x in data[: 2 * CHUNK + 5].tolist():
        slow = (slow * base + x + 1) % prime
    assert int(fingerprints(data[: 2 * CHUNK + 5], np.array([0, 2 * CHUNK + 5]), base, prime)[0]) == slow


@pytest.mark.parametrize("most", [32 << 20, 0])
def test_groups_reach_the_rows_in_bounded_bytes(spark, monkeypatch, most):
    """Few groups are replicated as they are, not once a salt; past the bound nothing is replicated."""
    from evhist.llm import common
    from evhist.llm import exact_dedup as module

    plans = []
    monkeypatch.setattr(common, "REPLICATED", most, raising=False)
    monkeypatch.setattr(module, "keep", lambda df, name: plans.append((name, df._jdf.queryExecution().sparkPlan().toString())) or common.keep(df, name))
    rows = [(i, f"text {i % 40}") for i in range(120)] + [(None, "text 1"), (500, "alone")]
    out = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.keep_id, r.group_size) for r in out.collect()} == {(i, max(j for j, u in rows if u == t and j is not None), sum(u == t for _, u in rows)) for i, t in rows}
    plans.append(("out", out._jdf.queryExecution().sparkPlan().toString()))
    for plan in (p for name, p in plans if name in ("mismatches", "out")):
        if most:
            assert "BroadcastHashJoin" in plan and "_salt" not in plan
        else:
            assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan and "_salt" in plan
