import random

import sentencepiece

import public_tokenizers as P
from evhist.llm.pieces import MARK, decode_documents, encode_documents, encode_units, merge, piece_table, units_of

from .conftest import SF01

MODEL = P.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ODD = [None, "", " ", "   two   spaces ", "tab\tnew\n\nline", "naïve café 你好 🎉", "a" * 5000, "x" + " " * 70 + "y", "<s> </s> <0x41> <unk>", "\x00\x01", ";\r\n{\r", f"mark{MARK}mark"]


def test_lattice_fold_gives_the_librarys_ids(spark):
    rng = random.Random(1)
    letters = "etaoinshr dlué;\r{1你"
    units = {MARK * rng.randint(1, 6) + "".join(rng.choice(letters) for _ in range(rng.randint(0, 14))).replace(" ", "") for _ in range(400)}
    units |= {u for t in spark.read.parquet(f"{SF01}/documents.parquet").limit(20).collect() for u in units_of(t.text) if len(u) <= 40}
    got = {r.unit: r.ids for r in encode_units(spark.createDataFrame([(u,) for u in units], "unit string"), MODEL).collect()}
    usable, of_byte, _ = piece_table(MODEL)
    score = {p: (s, i) for p, i, s in usable}
    assert len(got) == len(units) > 1000
    for u in units:
        want = LIB.encode(u[1:].replace(MARK, " ")) if u[1:] else [score[MARK][1]]
        assert got[u] == merge(u, score, of_byte) == want, u


def test_documents_match_the_library_and_come_back(spark):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").limit(300).collect()]
    rows = [(i, t, 3) for i, t in enumerate(texts)] + [(3, texts[3], 3), (None, "no id", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_pieces int")
    enc = encode_documents(df, common=500, with_ids=True)
    out = enc.collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    for i, t in enumerate(texts):
        assert by[i].ids == LIB.encode(t or ""), t
        assert by[i].n_pieces == len(by[i].ids) and by[i].round_trip
    back = {r.doc_id: r.text for r in decode_documents(enc).collect()}
    assert all(back[i] == (t or "").replace(MARK, " ") for i, t in enumerate(texts))
    assert encode_documents(df.limit(0)).count() == 0


def test_a_unit_met_again_costs_a_lookup(spark):
    """Documents of repeated words take little longer than cutting them into units."""
    import time

    import pyarrow as pa

    from evhist.llm.pieces import _encode

    text = " ".join(f"word{i % 100}" for i in range(200_000))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["_id", "_text"])

    def least(job):
        times = []
        for _ in range(3):
            t = time.process_time()
            job()
            times.append(time.process_time() - t)
        return min(times)

    cut = least(lambda: units_of(text))
    out = next(_encode(MODEL, {}, False)(iter([batch])))
    assert out.column("n_pieces").to_pylist() == [len(LIB.encode(text))] and out.column("round_trip").to_pylist() == [True]
    assert least(lambda: list(_encode(MODEL, {}, False)(iter([batch])))) < 2.8 * cut


def test_short_units_without_a_queue(spark):
    from evhist.llm.pieces import merge_short

    rng = random.Random(2)
    usable, of_byte, _ = piece_table(MODEL)
    score, rank, id_of = {p: (s, i) for p, i, s in usable}, {p: s for p, _, s in usable}, {p: i for p, i, _ in usable}
    for _ in range(3000):
        u = MARK * rng.randint(1, 4) + "".join(rng.choice("etaoinshr;\n{1你🎉\x00") for _ in range(rng.randint(0, 30)))
        assert merge_short(u, rank, id_of, of_byte) == merge(u, score, of_byte), u
