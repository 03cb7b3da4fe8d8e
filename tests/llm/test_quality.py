import numpy as np
import pytest

from evhist.llm.quality import FEATURES, accept, classify, features, fit

from .conftest import SF01


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    out = classify(docs, labels)
    assert out.count() == docs.count()
    rows = out.where("held_out").join(labels, "doc_id").collect()
    hit = np.mean([r.predicted == r.quality for r in rows])
    bad = [r.score for r in rows if r.quality == 0]
    good = [r.score for r in rows if r.quality == 1]
    auc = np.mean([[g > b for b in bad] for g in good])
    assert len(rows) > 80 and hit >= 0.93 and auc >= 0.95
    kept = {r.doc_id for r in accept(docs, labels).collect()}
    assert kept == {r.doc_id for r in out.where("predicted = 1").collect()}


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 9, 0.0), (2, "", 9, 0.0), (2, "", 9, 0.0), (None, "x " * 200_000, 9, 0.0)], "doc_id long, text string, _x int, _score double")
    none = spark.createDataFrame([(1, None), (5, 7)], "doc_id long, quality int")
    rows = classify(docs, none).collect()
    assert len(rows) == 4 and all(r.predicted == 1 and 0 <= r.score <= 1 for r in rows)
    one = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, quality int")
    assert all(r.predicted == 0 for r in classify(docs, one).collect())
    assert accept(docs, none).columns == docs.columns and accept(docs, none).count() == 4
    assert classify(docs.limit(0), none).count() == 0


def test_features_match_plain_counting():
    texts = ["The THE the | !! 12", "", "a a a b", "é è"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(t) for t in raw])
    x = dict(zip(FEATURES, features(data, offsets).T))
    assert x["repeat_word"].tolist() == pytest.approx([2 / 4, 0, 2 / 4, 0])
    assert x["distinct_words"].tolist() == pytest.approx([2 / 4, 0, 2 / 4, 1])
    assert x["pipe"][0] == pytest.approx(1 / 19) and x["upper"][0] == pytest.approx(4 / 9)
    assert x["top_word"].tolist() == pytest.approx([3 / 4, 0, 3 / 4, 1 / 2])


def test_pairs_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    with_pairs, without = fit(x, y, rounds=40), fit(x, y, rounds=40, pairs=0)
    acc = lambda m: np.mean((m.score(x) > 0.5) == (y > 0.5))
    assert acc(with_pairs) > 0.95 > 0.7 > acc(without)
