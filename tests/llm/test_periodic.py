import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st

from evhist.llm.periodic import find_runs, periodic_runs
from evhist.llm.queries import op13_periodic_runs


def brute(words, least=12):
    """(start, length, period) of all runs, straight from the definition."""
    n, seen = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                seen.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in seen.items())


def collapse(words, runs):
    gone = {k for a, n, q in runs for k in range(a + q, a + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def arrays(texts):
    firsts = np.cumsum([0] + [len(t) for t in texts])
    return np.array([c for t in texts for c in t], np.int64), firsts


def listed(texts, least):
    s, e, p = find_runs(*arrays(texts), least)
    return list(zip(s.tolist(), (e - s).tolist(), p.tolist()))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=4), st.sampled_from([2, 3, 12]))
def test_runs_against_the_definition(texts, least):
    want, at = [], 0
    for t in texts:
        want += [(a + at, n, q) for a, n, q in brute(t, least)]
        at += len(t)
    assert listed(texts, least) == sorted(want, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("unit", ["a", "ab", "abaab", "aabaabb"])
def test_powers_and_fibonacci_words(unit):
    texts = [[ord(c) for c in unit * 30 + "x" + unit * 7]]
    a, b = "a", "ab"
    for _ in range(10):
        a, b = b, b + a
    texts.append([ord(c) for c in b])
    want = brute(texts[0]) + [(s + len(texts[0]), n, q) for s, n, q in brute(texts[1])]
    assert listed(texts, 12) == sorted(want, key=lambda r: (r[0], r[2]))


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = op13_periodic_runs(spark, SF001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    some = 0
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id])
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        runs = brute(words) if n < 3000 or h % 10 == 0 else [(s, k, q) for s, k, q in listed([[hash(w) for w in words]], 12)]
        some += len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{k},{q}\n" for s, k, q in runs))
        assert r.collapsed_sha256 == sha(collapse(words, runs))
    assert some > 5


def test_nulls_empty_repeats_and_clashing_names(spark):
    rows = [(None, "x " * 12), (1, None), (1, ""), (2, " \t\n\x0b\x0c\r"), (2, "a b é é é é é é é é é é é é"), (2, "x\x00y " * 13)]
    df = spark.createDataFrame([(i, t, 1, "r", 0) for i, t in rows], "doc_id long, text string, _row int, runs string, _text int")
    out = {(r.doc_id, r.n_words, r.collapsed): [tuple(x) for x in r.runs] for r in periodic_runs(df).collect()}
    assert out == {(None, 12, "x"): [(0, 12, 1)], (1, 0, ""): [], (2, 0, ""): [], (2, 13, "a b é"): [(1, 12, 1)], (2, 13, "x\x00y"): [(0, 13, 1)]}
    assert periodic_runs(df.limit(0)).count() == 0


def test_blocks_do_not_matter(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    small, large = (sorted(map(tuple, periodic_runs(df, block=b).collect())) for b in (1, 1 << 20))
    assert small == large
    assert all([tuple(x) for x in r[2]] == brute(texts[r[0]].split()) for r in small)


@pytest.mark.parametrize("make", [lambda n: [1] * n, lambda n: [i % 1000 for i in range(n)], lambda n: [(i * i) % 97 for i in range(n)]])
def test_one_long_text_takes_time_in_proportion(make):
    took = []
    for n in (200_000, 400_000):
        each = []
        for _ in range(3):
            t = time.process_time()
            runs = listed([make(n)], 12)
            each.append(time.process_time() - t)
        took.append(min(each))
        assert len(runs) >= 1 and max(k for _, k, _ in runs) == n
    assert took[1] < 3.5 * took[0]
