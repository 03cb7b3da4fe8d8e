import hashlib
import random

import numpy as np
import pytest

from evhist.llm.suffix_dedup import RunLengthIndex, cut_repeats, kept_windows, repeated_bytes

from .conftest import SF01


def brute(texts, length):
    """{key: (n_bytes, n_removed, n_spans, sha)} for texts in document order."""
    seen, out = set(), {}
    for key, text in texts:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                gone[i : i + length] = True
            seen.add(w)
        edge = np.diff(np.concatenate([[0], gone[:-1].astype(int), [0]]))
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out[key] = (len(raw), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(left).hexdigest())
    return out


def got(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def sample(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 5)))
    passages = [" ".join(word() for _ in range(rng.randint(10, 60))) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages)[rng.randint(0, 30) :] if rng.random() < 0.5 else " ".join(word() for _ in range(20)) for _ in range(4)]
        rows.append((i, " ".join(parts)))
    rows += [(n, None), (n + 1, ""), (n + 2, "a" * 700), (n + 3, "ab" * 300), (n + 4, rows[3][1]), (n + 5, rows[3][1]), (n + 6, "a\x00" * 120)]
    return rows


@pytest.mark.parametrize("split", [20_000, 2])
def test_matches_brute_force(spark, split):
    rows = sample(1)
    df = spark.createDataFrame([(i, t, "r") for i, t in random.Random(0).sample(rows, len(rows))], "doc_id long, text string, runs string")
    assert got(repeated_bytes(df, length=20, gram=8, split=split)) == brute(rows, 20)


def test_sample_table(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet").where("doc_id < 600")
    rows = sorted((r.doc_id, r.text) for r in df.collect())
    want = brute(rows, 100)
    assert got(repeated_bytes(df)) == want
    assert any(v[1] for v in want.values())
    cut = cut_repeats(df)
    assert cut.columns == df.columns and cut.count() == len(rows)
    assert {r.doc_id for r in cut.collect() if len((r.text or "").encode()) < want[r.doc_id][0]} == {k for k, v in want.items() if v[1]}


def test_null_and_repeated_ids(spark):
    a, b = "xy" * 3 + "q" * 40 + "end of the first text", "other words and " + "q" * 40
    df = spark.createDataFrame([(5, a), (5, a), (None, b), (5, b), (9, "short")], "doc_id long, text string")
    rows = repeated_bytes(df, length=30, gram=10).collect()
    assert len(rows) == 5 and all(r.n_bytes - r.n_removed >= 0 for r in rows)
    first = next(r for r in rows if r.doc_id is None)
    assert first.n_removed == brute([(0, b)], 30)[0][1]
    twice = [r for r in rows if r.doc_id == 5 and r.n_bytes == len(a)]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert repeated_bytes(df.limit(0)).count() == 0


def test_long_text_in_slices(spark, monkeypatch):
    from evhist.llm import suffix_dedup

    rng = random.Random(4)
    text = "".join(rng.choice("abcd") for _ in range(3000))
    rows = [(0, text + text[500:1500]), (1, text[100:2000])]
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t) for _, t in rows])
    whole = suffix_dedup.scan(data, offsets, 50, 20)
    monkeypatch.setattr(suffix_dedup, "SLICE", 400)
    parts = suffix_dedup.scan(data, offsets, 50, 20)
    windows = lambda x: sorted((r, s + i, h) for r, s, n, h in zip(*(c.tolist() for c in x)) for i in range(n))
    assert windows(whole) == windows(parts)


def test_index_links_and_compresses():
    rng = random.Random(2)
    base = bytes(rng.choice(b"abcd") for _ in range(120))
    pieces = sorted({bytes(rng.choice(b"ab") for _ in range(3)) + base[: rng.randint(60, 120)] for _ in range(30)})
    index = RunLengthIndex(pieces)
    link, shared = index.matches()
    text = b"\0".join(pieces) + b"\0"
    for p in range(index.n):
        if link[p] >= 0 and shared[p]:
            assert text[p : p + shared[p]] == text[link[p] : link[p] + shared[p]]
    assert index.runs < index.n / 3
    places = {p: (i, 0) for i, p in enumerate(pieces)}
    seen, want = set(), set()
    for p, (d, s) in places.items():
        for i in range(len(p) - 50 + 1):
            if p[i : i + 50] not in seen:
                want.add((d, i))
            seen.add(p[i : i + 50])
    d, s, n = kept_windows(places, 50)
    assert {(x, y + i) for x, y, m in zip(d.tolist(), s.tolist(), n.tolist()) for i in range(m)} == want


def test_texts_are_shuffled_deflated_and_opened_in_bounded_groups(monkeypatch):
    import pyarrow as pa

    from evhist.llm import suffix_dedup

    texts = [b"", b"a" * 50_000, "naïve text 你好 ".encode() * 40, b"", bytes(range(256)) * 3, b"a" * 900] * 5
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], names=["_d", "_text"])
    packed = next(suffix_dedup._packed(iter([batch])))
    assert sum(map(len, packed.column("_text").to_pylist())) < sum(map(len, texts)) / 10
    monkeypatch.setattr(suffix_dedup, "OPEN_BYTES", 2000)
    groups = list(suffix_dedup._unpacked(iter([packed, packed.slice(0, 0)])))
    assert [t for _, g in groups for t in g] == texts
    assert [d for b, _ in groups for d in b.column("_d").to_pylist()] == list(range(len(texts)))
    assert all(len(g) == 1 or sum(map(len, g)) <= 2000 for _, g in groups)
