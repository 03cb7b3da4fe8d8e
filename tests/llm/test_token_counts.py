import random
import re
import zlib

import pytest

import public_tokenizers as P
from evhist.llm.token_counts import Counter, Tree, apply, build, edit, masks, update, update_by_id

from .conftest import SF01

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def counter():
    return Counter(RANKS)


def full(counter, raw):
    return len(counter.encoding.encode_ordinary(raw.decode()))


def test_random_edits_equal_a_full_count(counter):
    rng = random.Random(5)
    bits = ["a", "it's", "'", "re", "ll", " ", "  ", "\n", "\n\n ", "12", "é", "你", "!!", "?", " the", "ing", "\t", "x" * 9, "'v", "e", " 'd"]
    for trial in range(120):
        raw = "".join(rng.choice(bits) for _ in range(rng.choice([0, 3, 40, 600, 4000]))).encode()
        tree = Tree(*counter.leaves(raw.decode()))
        for _ in range(8):
            borders = [i for i in range(len(raw) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80]
            a, b = sorted((rng.choice(borders), rng.choice(borders)))
            if rng.random() < 0.7:
                b = min((x for x in borders if x >= a + rng.choice([0, 0, 1, 4])), default=a)
            new = "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 2, 5, 300]))).encode()
            raw = edit(tree, raw, a, b, new, counter)
            assert tree.total == full(counter, raw)
            flat = [x for leaf in tree.sizes for x in leaf]
            assert flat == counter.leaves(raw.decode())[0]
            assert tree.bytes[-1][0] == len(raw)
            assert Tree.unpack(tree.pack()).total == tree.total


def test_an_edit_encodes_a_small_part(counter):
    raw = ("some words, and more of them. " * 5000).encode()
    tree = Tree(*counter.leaves(raw.decode()))
    counter.encoded = 0
    raw = edit(tree, raw, 70_000, 70_004, b"other", counter)
    assert counter.encoded < 20 and tree.total == full(counter, raw)


def test_bad_edits_raise(counter):
    tree = Tree(*counter.leaves("abc"))
    with pytest.raises(ValueError):
        apply(tree, b"abc", [(0, 2, b""), (1, 3, b"")], counter)
    with pytest.raises(ValueError):
        edit(tree, b"abc", 2, 9, b"", counter)


def test_masks_over_a_table(spark, counter):
    texts = [None, "", "call 12345", "é 2024 and 99999é1234", "no digits 12"] + [r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").limit(400).collect()]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(2, texts[2], 1), (None, "1111", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = update(build(df, edits=masks())).collect()
    assert len(out) == len(rows) and any(r.n_edits for r in out)
    by = {r._id: r for r in out}
    for i, t in enumerate(texts):
        new = re.sub("[0-9]{4,}", "<num>", t or "")
        r = by[i]
        assert (r._text, r.n_tokens, r.n_before) == (new, full(counter, new.encode()), full(counter, (t or "").encode()))
        assert r.text_crc32 == zlib.crc32(new.encode())
    assert update(build(df.limit(0), edits=masks())).count() == 0


def test_edit_table_by_id(spark, counter):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four five")], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 4, 7, "2"), (1, 0, 3, "1")], "_id long, start long, end long, new string")
    got = {r._id: (r._text, r.n_tokens) for r in update_by_id(build(docs), edits).collect()}
    assert got == {1: ("1 2 three", full(counter, b"1 2 three")), 2: ("four five", full(counter, b"four five"))}


def test_many_edits_of_one_text_take_time_in_proportion(counter):
    """Every run of digits masked: the text is put together once, leaves are cut once."""
    import time

    took = []
    for n in (20_000, 40_000):
        raw = " ".join(f"w{i % 7} {10_000 + i}" for i in range(n)).encode()
        edits = [(m.start(), m.end(), b"<num>") for m in re.finditer(rb"[0-9]{4,}", raw)]
        tree = Tree(*counter.leaves(raw.decode()))
        t = time.process_time()
        out = apply(tree, raw, edits, counter)
        took.append(time.process_time() - t)
        assert out == re.sub(rb"[0-9]{4,}", b"<num>", raw) and tree.total == full(counter, out)
        assert max(map(len, tree.sizes)) <= 128
    assert len(edits) == 40_000 and took[1] < 3 * took[0]


def test_one_long_text_through_spark(spark, counter):
    raw = " ".join(f"w{i % 7} {10_000 + i}" for i in range(30_000))
    df = spark.createDataFrame([(1, raw), (2, "x 1234")], "doc_id long, text string")
    out = {r._id: r for r in update(build(df, edits=masks())).collect()}
    new = re.sub("[0-9]{4,}", "<num>", raw)
    assert out[1]._text == new and out[1].n_edits == 30_000 and out[1].n_tokens == full(counter, new.encode())
