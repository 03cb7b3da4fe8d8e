import numpy as np

from evhist.llm.lang_id import FTRL, counts, identify, softmax, temperature

from .conftest import SF01


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    out = identify(docs, per_class=200)
    assert out.count() == docs.count()
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    known = [r for r in rows if r.lang_pred != "und"]
    assert len(known) > 200 and np.mean([r.lang_pred == r.lang for r in known]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert abs(np.mean([r.score for r in known]) - np.mean([r.lang_pred == r.lang for r in known])) < 0.05


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !!", None), (4, "the cat", "en"), (4, "the cat", "en"), (None, "the dog " * 50_000, "en"), (6, "x", None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    got = identify(df).collect()
    assert len(got) == 7
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" for i in (1, 2, 3))
    assert by[4].lang_pred == by[6].lang_pred == "en" and by[4].score == 1.0
    assert {r.lang_pred for r in identify(df.where("lang IS NULL")).collect()} == {"und"}
    assert identify(df.limit(0)).count() == 0


def test_counts_cover_whole_texts():
    raw = ["abcd", "", "zé" * 5000]
    data = np.frombuffer("".join(raw).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(x.encode()) for x in raw])
    got = list(counts(data, offsets))
    assert len(got[0][0]) <= 10 and len(got[1][0]) == 0
    assert np.exp(got[2][1] - 1).sum() > 4 * (offsets[3] - offsets[2]) - 7
    alone = list(counts(data[:4], offsets[:2]))
    assert alone[0][0].tolist() == got[0][0].tolist()


def test_elastic_net_leaves_zeros_and_temperature_calibrates():
    rng = np.random.default_rng(0)
    model = FTRL(2, size=51, l1=0.5)
    for _ in range(2000):
        y = int(rng.integers(2))
        model.step(np.array([y, 2 + int(rng.integers(48)), 50]), np.array([1.0, 0.05, 1.0]), y)
    w = model.weights()
    assert np.abs(w[:2]).min() > 0.5 and (w[2:50] == 0).mean() > 0.5
    logits = rng.normal(size=(4000, 3))
    y = np.array([rng.choice(3, p=p) for p in softmax(logits)])
    assert abs(temperature(logits * 4, y) - 4) < 0.5
