import random
import re

import numpy as np
import pytest

from evhist.llm.components import components
from evhist.llm.minhash import THRESHOLD, dart_minhash, forest, near_duplicates, similarity

from .conftest import SF01


def grams(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in w]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, threshold=0.8):
    sets = {i: grams(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and len(sets[x] & sets[y]) / len(sets[x] | sets[y]) >= threshold:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: find(i) for i in ids}


def check(spark, rows):
    df = spark.createDataFrame([(i, t, 0, "k") for i, t in rows], "doc_id long, text string, w int, key string")
    out = near_duplicates(df).collect()
    want = brute(rows)
    assert {r.doc_id: r.class_id for r in out} == want
    sizes = {c: list(want.values()).count(c) for c in want.values()}
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in out)
    return out


def test_chains_copies_and_odd_texts(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, n = [(0, None), (1, ""), (2, "!!! ..."), (3, "one two"), (4, "One, TWO"), (5, "one")], 6
    shared = [word() for _ in range(60)]
    for _ in range(6):
        base = [word() for _ in range(rng.randint(40, 200))]
        text = base
        for step in range(8):  # a chain: each differs from the one before, less and less like the first
            rows.append((n, " ".join(text)))
            text = list(text)
            text[rng.randrange(len(text))] = word()
            n += 1
        rows += [(n, " ".join(base)), (n + 1, " ".join(base).upper() + " ...")]
        n += 2
    for _ in range(12):  # texts that share a passage but are no copies
        rows.append((n, " ".join([word() for _ in range(40)] + shared + [word() for _ in range(30)])))
        n += 1
    rng.shuffle(rows)
    check(spark, rows)


def test_sample_table_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").where("doc_id < 500").collect()]
    out = check(spark, rows)
    assert any(r.n_links for r in out)


def test_repeated_rows_null_id_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.class_id or -1, r.class_size) for r in near_duplicates(df).collect())
    assert got == [(-1, -1, 1), (1, 1, 3), (1, 1, 3), (2, 1, 3)]
    assert near_duplicates(df.limit(0)).count() == 0


def sentence(seed, n=40):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))


def test_different_texts_that_share_an_id(spark):
    x, y = sentence(1), sentence(2)
    ask = lambda rows: sorted((r.doc_id, r.class_id, r.class_size, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    # 4 is near 3 with one of its texts only
    assert ask([(3, x + " z"), (4, x), (4, y)]) == [(3, 3, 2, True), (4, 3, 2, False), (4, 4, 1, True)]
    # both texts of 1 have a copy and a near copy under other ids
    rows = [(1, x), (1, y), (2, x + " z"), (3, y + " z"), (4, x.upper()), (5, y.upper())]
    assert ask(rows) == [(1, 1, 3, True)] * 2 + [(i, 1, 3, False) for i in (2, 3, 4, 5)]
    # near copies under one id: one stays
    assert ask([(7, x), (7, x + " z"), (8, x)]) == [(7, 7, 3, False), (7, 7, 3, True), (8, 7, 3, False)]


def test_links_that_only_shared_differences_show(spark):
    """Families of changes to one text: links between them that no star around the first text finds."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    rows, n = [(0, " ".join(base))], 1
    for _ in range(25):
        family = list(base)
        for _ in range(rng.randint(3, 7)):  # far enough from the first text, near each other
            family[rng.randrange(len(family))] = word()
        for _ in range(rng.randint(1, 5)):
            text = list(family)
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = word()
            rows.append((n, " ".join(text)))
            n += 1
    rng.shuffle(rows)
    out = check(spark, rows)
    assert 2 < len({r.class_id for r in out}) < len(rows)


def families(rng, n_families=14, length=120):
    """Changes to one text: families far from it, near each other."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(length)]
    out = [base]
    for _ in range(n_families):
        family = list(base)
        for _ in range(rng.randint(2, 7)):
            family[rng.randrange(length)] = word()
        for _ in range(rng.randint(1, 5)):
            text = list(family)
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(length)] = word()
            out.append(text)
    return out


@pytest.mark.parametrize("bounds", [(0, 0), (6, 1 << 18), (4096, 150)])
def test_groups_beyond_one_task(spark, bounds):
    """Groups dealt anew by differences give the classes of groups searched as a whole."""
    rows = list(enumerate(" ".join(t) for t in families(random.Random(17))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = near_duplicates(df, group_texts=bounds[0], group_differences=bounds[1]).collect()
    want = brute(rows)
    assert {r.doc_id: r.class_id for r in out} == want and 1 < len(set(want.values())) < len(rows)


@pytest.mark.parametrize("seed", range(12))
def test_forest_against_all_pairs(seed):
    rng = random.Random(seed)
    sets = [frozenset(hash(tuple(t[i : i + 5])) for i in range(len(t) - 4)) for t in families(rng, 1 + seed, rng.choice([30, 60, 120]))]
    sets = list(dict.fromkeys(sets))
    # any set will do to compare with: a member, another member, none at all
    core = [sets[0], sets[-1], frozenset()][seed % 3]
    diff = [sorted(s ^ core) for s in sets]
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in diff])
    joined = np.array([0 if i < 2 and seed % 2 else i for i in range(len(sets))])
    links = forest(np.array([len(s) for s in sets], float), joined, np.array([e for x in diff for e in x], np.int64), owner, THRESHOLD)

    def classes(pairs):
        root = list(range(len(sets)))
        for a, b in pairs:
            a, b = root[a], root[b]
            root = [a if r == b else r for r in root]
        return [root.index(r) for r in root]

    alike = [(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets) if i < j and len(x & y) >= THRESHOLD * len(x | y)]
    before = [(0, int(i)) for i in np.flatnonzero(joined == 0)]
    assert set(tuple(sorted(p)) for p in links) <= set(alike)
    assert classes(links + before) == classes(alike + before)


def test_rows_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    """Copies of one text, each with changes of its own, that are no links of each other."""
    from evhist.llm import minhash as M

    def most(n):
        rng = random.Random(n)
        word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
        base = [word() for _ in range(60)]
        rows = []
        for i in range(n):
            text = list(base)
            for at in rng.sample(range(60), 3):
                text[at] = word()
            rows.append((i, " ".join(text)))
        sizes = {}

        def counted(df, name, keep=M.keep):
            out = keep(df, name)
            sizes[name] = max(sizes.get(name, 0), out.count())
            return out

        with monkeypatch.context() as m:
            m.setattr(M, "keep", counted)
            out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r.doc_id: r.class_id for r in out} == brute(rows)
        return sizes

    few, many = most(250), most(1000)
    for name, size in many.items():
        assert size <= 6 * max(few.get(name, 0), 1000), (name, few.get(name), size)


@pytest.mark.parametrize("weights", ["ones", "counts", "reals"])
def test_coordinates_agree_as_often_as_the_sets_are_alike(weights):
    rng = np.random.default_rng(5)
    el = np.sort(rng.integers(0, 2**63, 400).astype(np.uint64))
    draw = {"ones": lambda n: np.ones(n), "counts": lambda n: rng.integers(1, 9, n).astype(float), "reals": lambda n: rng.random(n) * 3}[weights]
    w = draw(400)
    a, b = (el[:330], w[:330]), (el[40:], w[40:] * (1 if weights == "ones" else rng.choice([1, 1, 2], 360)))
    doc = np.repeat([0, 1], [330, 360])
    sig = dart_minhash(np.concatenate([a[0], b[0]]), doc, np.concatenate([a[1], b[1]]), 2, 3000)
    assert abs(np.mean(sig[0] == sig[1]) - similarity(a, b)) < 0.035


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(300)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
