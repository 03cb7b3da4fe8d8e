import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import SF001

from evhist.llm import divergence
from evhist.llm.divergence import audit, group_totals, ranked_pairs, skyband, term_counts
from evhist.llm.queries import SQL, op11_source_divergence


def brute(rows, k=200, least=3):
    """The whole report in Python integers; rows are (lang, source, text)."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups[lang].add(source)
        n[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, c in docs[lang].items() if c >= least]
        total = {s: sum(n[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (n[lang, s][t] + 1) // (total[s] + len(kept)) for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (sum(n[lang, s][t] for s in sources) + 1) // (sum(total.values()) + len(kept)) for t in kept}
        f = lambda x, y: (x - y) ** 2 // y
        for s in sources:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources - {s}]
            term = [(t, f(p[s][t], q[t])) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items) if part == "pair" or i < k}
    return out


def got(df):
    rows = [(r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(n, seed=1):
    rng = random.Random(seed)
    words = ["w" + "".join(rng.choice("abcé") for _ in range(3)) for _ in range(60)] + ["İ", "ſ", "Éa", "Z"]
    rows = []
    for _ in range(n):
        source = rng.choice(["a", "a", "a", "b", "c", "d", None])
        mine = words[: 30 if source == "a" else 64]
        rows.append((rng.choice(["x", "x", "y", None]), source, rng.choice([" ", "1", "-"]).join(rng.choices(mine, k=rng.randrange(40)))))
    return rows + [("z", "a", "one two"), ("z", "b", None), ("lone", "only", "t t")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, source string, text string, n int, term int")


def test_against_brute_force(spark):
    rows = made(300)
    assert got(audit(frame(spark, rows))) == brute(rows)
    assert got(audit(frame(spark, rows), k=5, least=1)) == brute(rows, 5, 1)


def test_query_against_sql_and_brute_force(spark):
    rows = got(op11_source_divergence(spark, SF001))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    con.execute(f"SELECT lang, source, part, item, value, rank FROM ({SQL['op11_source_divergence']})")
    assert rows == set(con.fetchall())
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert rows == brute([(r.lang, r.source, r.text) for r in docs])


@pytest.mark.parametrize("held", [1, 40])
def test_small_portions_and_tiles_give_the_same(spark, monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD", held)
    rows = made(120, 2)
    df = frame(spark, rows).repartition(5)
    assert got(audit(df, k=3, least=1)) == brute(rows, 3, 1)
    counts = term_counts(df, 1)
    pairs = ranked_pairs(counts, group_totals(counts), block_terms=7, tile=2)
    assert got(pairs) == {r for r in brute(rows, 3, 1) if r[2] == "pair"}


@pytest.mark.parametrize("k", [1, 3, 50])
def test_skyband_is_the_terms_with_few_dominators(k):
    rng = np.random.default_rng(k)
    n = rng.integers(1, 12, 700)
    lang_n = n + rng.integers(0, 30, 700)
    spell = rng.permutation(700)
    beats = (n[:, None] >= n) & (lang_n[:, None] <= lang_n) & (spell[:, None] < spell)
    assert sorted(skyband(n, lang_n, spell, k)) == np.flatnonzero(beats.sum(0) < k).tolist()


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    total = 20_000_000_000_000
    big = spark.createDataFrame([(total // 3, total, 1000), (0, total, 1000), (0, 0, 0)], "n long, total long, terms long")
    rows = [r[0] for r in big.select(divergence.share(F.col("n"), F.col("total"), F.col("terms"))).collect()]
    assert rows == [1 + 10**9 * (total // 3 + 1) // (total + 1000), 1, None]


def test_empty_table_and_no_terms(spark):
    df = frame(spark, made(3))
    assert audit(df.limit(0)).count() == 0
    rows = [("en", "a", "1 2"), ("en", "b", None), ("en", "c", "")]
    assert got(audit(frame(spark, rows))) == brute(rows)
    assert len(brute(rows)) == 6
