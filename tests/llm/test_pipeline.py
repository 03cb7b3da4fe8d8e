
from tokenizers import Tokenizer

import public_tokenizers as P

from .conftest import SF01
from .test_minhash import brute as near_classes
from .test_minhash import sentence
from .test_suffix_dedup import brute as cut_of

import corpus_pipeline as C


def rows_of(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("doc_id < 400")
    names = docs.columns
    kept = C.keep(C.quality(spark, docs, SF01), "t1")
    before, after = dict(rows_of(docs)), rows_of(kept)
    assert kept.columns == names and all(before[i] == t for i, t in after)
    from evhist.llm.quality import classify

    want = {r.doc_id for r in classify(docs, spark.read.parquet(f"{SF01}/labels.parquet")).where("predicted = 1").collect()}
    assert {i for i, _ in after} == want

    exact = C.keep(C.exact(spark, kept, SF01), "t2")
    last = {}
    for i, t in after:
        last[t] = max(i, last.get(t, -1))
    assert exact.columns == names and rows_of(exact) == sorted((i, t) for t, i in last.items())

    near = C.keep(C.near(spark, exact, SF01), "t3")
    classes = near_classes(rows_of(exact))
    assert rows_of(near) == [(i, t) for i, t in rows_of(exact) if classes[i] == i]

    cut = C.keep(C.repeats(spark, near, SF01), "t4")
    want = cut_of(rows_of(near), 100)
    assert cut.columns == names and cut.dtypes == docs.dtypes and cut.count() == near.count()
    for r in cut.collect():
        n, gone, _, _ = want[r.doc_id]
        assert n - gone - 6 * want[r.doc_id][2] <= len(r.text.encode()) <= n - gone and r.n_chars == len(r.text)

    packed = C.packing(spark, cut, SF01).collect()
    full = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    lengths = {r.doc_id: len(full.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in cut.collect()}
    got = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == lengths
    seqs = {}
    for r in packed:
        seqs[r.sequence_id] = seqs.get(r.sequence_id, 0) + r.length
    assert max(seqs.values()) <= 1024 and len(seqs) <= 1.05 * sum(lengths.values()) / 1024 + 1


def test_odd_rows_pass_through(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    rows = [(1, None, None, None, None), (2, "", "x", "y", 0), (None, "a b c", None, None, 5), (None, "d e f", None, None, 5), (3, "a b c", "", "", 5), (4, "t t t", "", "", 5), (4, "t t t", "", "", 5), (4, "a b c", "", "", 5)]
    docs = spark.createDataFrame(rows, schema)
    got = sorted((r.doc_id or -1, r.text or "") for r in C.exact(spark, docs, SF01).collect())
    assert got == [(-1, "d e f"), (2, ""), (4, "a b c"), (4, "t t t")]
    out = docs
    for _, stage in C.STAGES[1:4]:
        out = C.keep(stage(spark, out, SF01), "odd")
        assert out.columns == docs.columns
    assert C.packing(spark, out, SF01).count() == 4
    out = docs.limit(0)
    for _, stage in C.STAGES:
        out = C.keep(stage(spark, out, SF01), "empty")
    assert out.count() == 0


def test_near_stage_tells_rows_of_one_id_apart(spark):
    x, y, z = sentence(1), sentence(2), sentence(3)
    rows = [(3, x + " z"), (4, x), (4, y), (5, z), (5, z.upper()), (5, z + " z"), (6, z + " y"), (7, ""), (7, "!"), (8, y + " z"), (None, "d e f")]
    docs = spark.createDataFrame([(i, t, "x", None, len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    out = C.near(spark, docs, SF01)
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == docs.columns
    fives = [t for i, t in got if i == 5]
    assert len(fives) == 1 and fives[0] in (z.upper(), z + " z")
    assert sorted((i or -1, t) for i, t in got if i != 5) == [(-1, "d e f"), (3, x + " z"), (4, y), (7, ""), (7, "!")]


def test_ids_are_taken_out_alike_replicated_or_sorted(spark, monkeypatch):
    from evhist.llm import common

    docs = spark.createDataFrame([(i % 90 if i % 7 else None, f"t{i}") for i in range(200)], "doc_id long, text string")
    ids = C.keep(spark.createDataFrame([(i,) for i in range(0, 90, 2)] + [(None,)], "doc_id long"), "t-ids")
    want = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None and r.doc_id % 2)
    assert common.light(ids) and rows_of(C._without(docs, ids)) == want
    monkeypatch.setattr(common, "REPLICATED", 0)
    out = C._without(docs, ids)
    assert rows_of(out) == want and "Broadcast" not in out._jdf.queryExecution().sparkPlan().toString()


def test_a_table_is_light_by_its_rows_and_strings_not_its_files(spark):
    from evhist.llm import common

    same = C.keep(spark.range(500_000).selectExpr("1L AS doc_id"), "t-same")  # a few KB of files
    wide = C.keep(spark.range(1000).selectExpr("repeat('a', 20000) AS doc_id"), "t-wide")
    assert not common.light(same) and not common.light(wide)
    assert common.light(same.limit(100_000)) and common.light(wide.limit(100)) and common.light(same.limit(0))
