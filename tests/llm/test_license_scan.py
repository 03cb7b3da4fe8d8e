import random
import re

from evhist.llm.license_scan import BASE, TEMPLATES, scan_licenses

from .conftest import SF01


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text):
    w = words(text)
    places = sorted((i, label) for phrase, label in BASE.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def rows_of(df):
    return [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in scan_licenses(df).collect()]


def test_sample_table(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(rows_of(df)) == sorted((i, *brute(t)) for i, t in docs)
    assert sum(1 for i, t in docs if brute(t)[1]) > 5


def test_planted_and_odd_texts(spark):
    rng = random.Random(0)
    vocabulary = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "MIT", "É", "x1", "the"]
    texts = [None, "", "--- !!", "cc by", "CC-BY cc by cc by", "mit mit license license", "gnu general public", "x" * 10, "apache\nlicense" * 3000]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 300))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(3, "cc by"), (None, "mit license")]
    df = spark.createDataFrame([(i, t, "q", 5) for i, t in rows], "doc_id long, text string, label string, t int")
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    assert sorted(rows_of(df), key=key) == sorted([(i, *brute(t)) for i, t in rows], key=key)
    assert scan_licenses(df.limit(0)).count() == 0


def test_templates_add_labels_despite_small_edits(spark):
    notice = TEMPLATES["bsd"].split()
    edited = notice[:6] + ["any"] + notice[6:12] + notice[13:]
    texts = {1: " ".join(notice), 2: "foo " * 40 + " ".join(edited) + " bar", 3: " ".join(notice[:8]), 4: " ".join(reversed(notice)), 5: "Licensed under the Apache License, Version 2.0.", 6: "Licensed under CC BY-NC 4.0."}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in scan_licenses(df).collect()}
    assert got[1].labels == "bsd" and got[1].score == 1.0 and got[1].base_labels == ""
    assert got[2].labels == "bsd" and 0.8 <= got[2].score < 1
    assert got[3].labels == got[4].labels == "" and got[3].score == 0.0
    assert got[5].labels == "apache" and got[5].base_labels == "apache" and got[5].first_word == 3
    assert got[6].labels == "cc-by,cc-by-nc" and got[6].base_labels == "cc-by"


def test_no_python_in_the_plan(spark):
    plan = scan_licenses(spark.read.parquet(f"{SF01}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


def test_one_long_text_takes_time_in_proportion_and_only_ascii_is_folded(spark):
    import time

    took = []
    for n in (100_000, 200_000):
        text = "cc by " + "word " * n + "mit license"
        df = spark.createDataFrame([(1, text), (2, "GNU General public licenſe K\u212a mit licen\u017fe")], "doc_id long, text string")
        t = time.time()
        got = sorted(rows_of(df))
        took.append(time.time() - t)
        assert got[0] == (1, n + 4, 2, 0, n + 2, "cc-by,mit")
        assert got[1][2] == 0
    assert took[1] < 3 * took[0]
