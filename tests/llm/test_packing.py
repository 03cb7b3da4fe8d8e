import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from evhist.llm.packing import best_fit, cut, encoder, pack, plan, sequences

import public_tokenizers as P

VOCAB = P.path("byte_bpe_50k.json")
TEXTS = [None, "", "hello world", "a" * 5000, "it's <|endoftext|> here", "naïve  \n\n café 123", " " * 3000 + "x", "word " * 3000, "dup", "dup"]


def test_every_token_has_one_place(spark):
    rows = list(enumerate(TEXTS)) + [(50 + i, "ab " * (i * 17 % 900)) for i in range(60)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, piece int, length int")
    packed = pack(df, with_ids=True)
    got = packed.collect()
    full = Tokenizer.from_file(VOCAB)
    docs = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(docs.setdefault(r.doc_id, []))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) <= 1024
        docs[r.doc_id] += r.ids
    for i, t in rows:
        assert docs[i] == full.encode(t or "", add_special_tokens=False).ids + [2]
    seqs = {r.sequence_id: r.ids for r in sequences(packed).collect()}
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    for k, v in by.items():
        v.sort(key=lambda r: r.offset)
        assert [r.offset for r in v] == list(np.cumsum([0] + [r.length for r in v])[:-1])
        assert sum(r.length for r in v) <= 1024 and seqs[k] == [x for r in v for x in r.ids]


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_piece_once_and_is_tight(seed):
    rng = random.Random(seed)
    hist = {rng.randint(1, 1024): rng.randint(1, 500) for _ in range(300)}
    used = {}
    patterns = plan(hist)
    for n, lengths in patterns:
        assert n > 0 and 0 < sum(lengths) <= 1024
        for x in lengths:
            used[x] = used.get(x, 0) + n
    assert used == hist
    assert sum(n for n, _ in patterns) <= sum(n for n, _ in best_fit(Counter(hist), 1024))


def test_exact_complements_leave_no_gap():
    assert sum(n for n, _ in plan({1000: 10, 20: 10, 4: 10, 500: 10, 524: 10, 512: 6, 300: 4, 700: 2, 24: 4})) <= 26


def test_cut_puts_the_short_piece_first():
    assert cut(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)]
    assert cut(2048, 1024) == [(0, 1024), (1024, 1024)] and cut(1024, 1024) == [(0, 1024)]


def test_fast_ids_are_the_files_ids():
    full, fast = Tokenizer.from_file(VOCAB), encoder(VOCAB)
    for t in [*TEXTS[1:], "你好 мир x \t\n  y", "'re'VE I'll 's ''"]:
        assert fast(t) == full.encode(t, add_special_tokens=False).ids
