"""Near duplicates by DartMinHash signatures, banded joining and exact verification.

Every shingle of a text is an element with a weight.  Darts fall on the plane of weight
and rank as a Poisson process that depends on the element alone: layer by layer of the
weight axis, each layer's darts in ascending rank.  A text sees the darts below its
weights and below a rank that makes a few thousand of them likely, however long it is;
of the darts that hash to a coordinate the earliest is kept.  So two texts agree in a
coordinate with a probability equal to their weighted Jaccard similarity.

Joining: texts with equal shingle sets are collapsed first, and each distinct set gets a
number, in the order of its least id and then its fingerprint; everything below goes by
that number, so texts that share an id stay apart.  Texts that share a band form a group
around its centre, the least number, and the texts are read once, each with its centre's
(a star), to verify that pair and to write down the elements in which the two differ.

All other links are found from those differences alone.  For any set that all texts of a
group are compared with, let d(x) be the elements in which x and that set differ.  With
r = (1 - t) / (1 + t) and excess(x) = |d(x)| - r |x|, two texts are linked at threshold t
if and only if excess(x) + excess(y) <= 2 |d(x) & d(y)|.

A group of at most ``GROUP_TEXTS`` texts and ``GROUP_DIFFERENCES`` differences is one row
for one task: a search from text to text through an index of the differences meets each
text once and writes a forest of links (``forest``).

A larger group is dealt anew until its parts are that small.  Its core holds the elements
that more than half of its texts have, and d(x) is taken to the core.  Pairs for which the
sum of excesses is not above 0 are all linked to the text of least excess, so a second
star, around that one, joins them.  All others share a difference: the group is dealt by
the differences that texts of several components share, without those that no link can
rest on (``_partnered``), each text under its rarest ones only, as many as the bound asks
for, and parts of the same members are one.  A part has at most half of its group's texts,
as the core goes by majority; so there are few levels, every one costs rows of (text,
difference), never pairs of a group.  Either way no link that changes a class is lost.

36 bands of 6 rows find a pair of similarity 0.8 with probability 0.99998.

Defined results: null text is empty; a text without words is alone in its class; 1 to 4
words are one shingle; copies share a class; different texts that share an id are texts
of their own (so two classes may have the same class_id), and of a class's rows with the
least id those of one shingle set are kept;
rows with a null id take no part: each is alone in its class and kept; repeated rows appear each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import blocks, byte_view, keep, mix64, shingles, to_signed, words
from .components import components

BANDS, ROWS = 36, 6
SHINGLE, THRESHOLD = 5, 0.8
U = np.uint64
SAME = ["_w", "_f0", "_f1"]  # the fingerprint of a shingle set
GROUP_TEXTS, GROUP_DIFFERENCES = 4096, 1 << 18  # what one task takes as a whole: some MB, about a second


def elements(hashes: np.ndarray, doc: np.ndarray, weighting: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (element, doc) with their weight: 1 in a set, else the number of places."""
    if not len(hashes):
        return hashes, doc, np.zeros(0)
    key = hashes ^ mix64(doc.astype(U) + U(1))
    _, at, n = np.unique(key, return_index=True, return_counts=True)
    return hashes[at], doc[at], np.ones(len(at)) if weighting == "set" else n.astype(float)


def layers(element: np.ndarray, doc: np.ndarray, weight: np.ndarray):
    """Cut the weight axis at 0, 1, 2, 4, 8, ...: (element, doc, weight, layer start, layer width)."""
    parts = [(element, doc, weight, np.zeros(len(weight)), np.ones(len(weight)))]
    low = 1.0
    while (at := np.flatnonzero(weight > low)).size:
        parts.append((element[at], doc[at], weight[at], np.full(at.size, low), np.full(at.size, low)))
        low *= 2
    return [np.concatenate(x) for x in zip(*parts)]


def dart_minhash(element: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, k: int, seed: int = 1) -> np.ndarray:
    """(docs, k) signatures: rank and hash of the earliest dart per coordinate; all ones without elements."""
    sig = np.full((n_docs, k), ~U(0), U)
    total = np.bincount(doc, weight, n_docs)
    live = total > 0
    reach = np.where(live, k * (np.log(k) + 4) / np.where(live, total, 1), 0.0)  # ranks looked at
    el, owner, w, low, width = layers(element, doc, weight)
    base = mix64(el ^ mix64(np.full(1, seed, U) + low.astype(U)))
    while live.any():
        use = live[owner]
        _throw(base[use], owner[use], w[use], low[use], width[use], reach, sig, k)
        live &= (sig == ~U(0)).any(1)  # an empty coordinate: look twice as far
        reach *= 2
    return sig


def _throw(base, owner, w, low, width, reach, sig, k):
    rank, count = np.zeros(len(base)), 0
    flat = sig.reshape(-1)
    while len(base):
        chunk = 1 if len(base) > 4096 else 32  # few elements: many darts of each at a time
        j = np.arange(count + 1, count + chunk + 1, dtype=U)
        h = mix64(base[:, None] + j * U(0x9E3779B97F4A7C15))
        gap = -np.log(((h >> U(11)).astype(np.float64) + 0.5) / 2.0**53) / width[:, None]
        ranks = np.cumsum(np.concatenate([rank[:, None], gap], 1), 1)[:, 1:]  # left to right: the same sums for any chunk
        other = mix64(h + U(0xD1B54A32D192ED03))
        place = low[:, None] + width[:, None] * ((other >> U(40)).astype(np.float64) / 2.0**24)
        hit = (ranks < reach[owner][:, None]) & (place < w[:, None])
        e, d = np.nonzero(hit)
        if len(e):
            dart = other[e, d]
            coordinate = ((dart & U(0xFFFFF)) % U(k)).astype(np.int64)
            packed = (ranks[e, d].astype(np.float32).view(np.uint32).astype(U) << U(32)) | (mix64(dart) & U(0xFFFFFFFF))
            np.minimum.at(flat, owner[e] * k + coordinate, packed)
        rank, count = ranks[:, -1], count + chunk
        on = rank < reach[owner]
        base, owner, w, low, width, rank = base[on], owner[on], w[on], low[on], width[on], rank[on]


def _fingerprint(el, doc, w, n):
    """Weight and two sums of hashes that tell a text's weighted shingles from any other's."""
    one, two = np.zeros(n, U), np.zeros(n, U)
    np.add.at(one, doc, mix64(el + w.astype(U)))
    np.add.at(two, doc, mix64((el + w.astype(U)) ^ U(0xA5A5A5A5A5A5A5A5)))
    return np.bincount(doc, w, n).astype(float), one, two


def _signatures(bands, rows, k_shingle, weighting):
    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column("_text"))
            n_out, f0, f1, keys = [], [], [], []
            for i, j in blocks(offsets, 2 << 20):
                _, _, hashes, firsts = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                grams, n = shingles(hashes, firsts, k_shingle)
                el, doc, w = elements(grams, np.repeat(np.arange(j - i), n), weighting)
                sig = dart_minhash(el, doc, w, j - i, bands * rows)
                band = np.repeat(np.arange(bands, dtype=U)[None, :], j - i, 0)
                for r in range(rows):
                    band = mix64(band ^ sig[:, r::rows])
                weights, one, two = _fingerprint(el, doc, w, j - i)
                n_out.append(weights), f0.append(one), f1.append(two)
                keys += [band[r] if weights[r] else band[r, :0] for r in range(j - i)]
            cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
            sizes = np.array([len(x) for x in keys], np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(to_signed(cat(keys, U))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_h"), pa.array(cat(n_out, float)), pa.array(to_signed(cat(f0, U))), pa.array(to_signed(cat(f1, U))), lists],
                names=["_id", "_h", *SAME, "_bands"])

    return run


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two (sorted elements, weights)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    both = b[0][at] == a[0]
    common = np.minimum(a[1][both], b[1][at[both]]).sum()
    return float(common / (a[1].sum() + b[1].sum() - common))


def _weighed(column, k_shingle, weighting):
    data, offsets = byte_view(column)
    for i, j in blocks(offsets):
        _, _, hashes, firsts = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        grams, n = shingles(hashes, firsts, k_shingle)
        at = np.concatenate([[0], np.cumsum(n)])
        for r in range(j - i):
            el, c = np.unique(grams[at[r] : at[r + 1]], return_counts=True)
            yield el, (np.ones(len(el)) if weighting == "set" else c.astype(float))


def units(weighed: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The elements with one for every unit of their (whole) weights: a plain set."""
    el, n = weighed[0], weighed[1].astype(np.int64)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    el = np.repeat(el, n)
    return np.where(nth > 0, mix64(el ^ mix64(nth.astype(U))), el)


def _differences(k_shingle, weighting):
    """Similarity of a text and its centre, and the elements in which they differ."""

    def run(batches):
        for batch in batches:
            sims, rows = [], []
            for x, y in zip(*(_weighed(batch.column(c), k_shingle, weighting) for c in ("_ta", "_tb"))):
                sims.append(similarity(x, y))
                rows.append(to_signed(np.setxor1d(units(x), units(y), assume_unique=True)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sims, pa.float64()), pa.array(rows, pa.list_(pa.int64()))], names=["a", "b", "j", "d"])

    return run


def forest(weight: np.ndarray, root: np.ndarray, d: np.ndarray, owner: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links (i, j) that join a group's texts into classes; texts of one ``root`` are joined already.

    Text ``owner[k]`` differs from a common set in element ``d[k]``.  Each text is looked up
    once, and counts what it shares with those not reached yet.
    """
    n = len(weight)
    element, d = np.unique(d, return_inverse=True)
    most = np.flatnonzero(2 * np.bincount(d, minlength=len(element)) > n)
    if len(most):  # where most texts differ, the others shall
        turned = np.zeros((len(most), n), bool)
        at = np.isin(d, most)
        turned[np.searchsorted(most, d[at]), owner[at]] = True
        which, other = np.nonzero(~turned)
        d, owner = np.concatenate([d[~at], most[which]]), np.concatenate([owner[~at], other])
    excess = np.bincount(owner, minlength=n) - (1 - threshold) / (1 + threshold) * weight - 5e-10
    shared = np.bincount(d, minlength=len(element))[d] > 1 if len(d) else np.zeros(0, bool)
    d, owner = d[shared], owner[shared]
    posting = owner[np.argsort(d, kind="stable")]
    ends = np.cumsum(np.bincount(d, minlength=len(element)))
    own = d[np.argsort(owner, kind="stable")]
    first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    _, part = np.unique(root, return_inverse=True)
    members = np.split(np.argsort(part, kind="stable"), np.cumsum(np.bincount(part))[:-1])
    left, links = np.ones(n, bool), []
    for seed in np.argsort(excess, kind="stable"):
        if not left[seed]:
            continue
        queue = [int(i) for i in members[part[seed]]]
        left[queue] = False
        while queue and left.any():
            x = queue.pop()
            lists = [posting[(ends[e - 1] if e else 0) : ends[e]] for e in own[first[x] : first[x + 1]]]
            common = np.bincount(np.concatenate(lists), minlength=n) if lists else 0
            found = np.flatnonzero(left & (excess + excess[x] <= 2 * common))
            for p, at in zip(*np.unique(part[found], return_index=True)):
                links.append((x, int(found[at])))
                queue += [int(i) for i in members[p]]
                left[members[p]] = False
    return links


def _forests(threshold):
    """Links of whole groups, a row each."""

    def run(batches):
        for batch in batches:
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for texts in batch.column("texts"):
                texts = texts.values
                ids, weight, root = (texts.field(c).to_numpy(zero_copy_only=False) for c in ("id", "w", "root"))
                lists = texts.field("d")
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                links = forest(weight, root, lists.flatten().to_numpy(), np.repeat(np.arange(len(ids)), sizes), threshold)
                if links:
                    pairs = ids[np.array(links)]
                    a.append(pairs.min(1)), b.append(pairs.max(1))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return run


def _verify(k_shingle, weighting):
    def run(batches):
        for batch in batches:
            sides = (_weighed(batch.column(c), k_shingle, weighting) for c in ("_ta", "_tb"))
            sims = [similarity(x, y) for x, y in zip(*sides)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sims, pa.float64())], names=["a", "b", "j"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, weighting: str = "set", fingerprint: bool = False, group_texts: int = GROUP_TEXTS, group_differences: int = GROUP_DIFFERENCES) -> DataFrame:
    """id, class_id (least id of the class), class_size, n_links, kept of every row.

    ``weighting`` "set" weighs each distinct shingle 1 (plain Jaccard), "count" by its
    number of places.  ``n_links`` counts the links of the row's shingle set that were verified to find its
    class: pairs inside a component already found are not looked at, so it is no count
    of all partners at ``threshold``.
    ``fingerprint`` adds the columns ``SAME``, which tell apart rows that share an id.
    ``group_texts`` and ``group_differences`` bound what one task takes as a whole; the result
    does not depend on them, but for ``n_links``.
    """
    text = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text")).withColumn("_h", F.xxhash64("_text"))
    kind = dict(text.dtypes)["_id"]
    sig = keep(text.mapInArrow(_signatures(bands, rows, shingle, weighting), f"_id {kind}, _h bigint, _w double, _f0 bigint, _f1 bigint, _bands array<bigint>"), "signatures")
    same = SAME
    worded = sig.where("_w > 0 AND _id IS NOT NULL")
    reps = keep(worded.groupBy(*same).agg(F.min("_id").alias("_rep"), F.count(F.lit(1)).alias("_n")), "shingle-sets")
    # written once numbered: the numbers follow (least id, fingerprint), so a class's least number has its least id
    reps = keep(reps.orderBy("_rep", *same).withColumn("id", F.monotonically_increasing_id()), "representatives")
    kind = "bigint"
    chosen = worded.join(reps.select(*same, F.col("_rep").alias("_id"), "id"), [*same, "_id"]).dropDuplicates([*same, "_id"])
    member = chosen.select("id", F.col("_w").alias("w"), F.posexplode("_bands").alias("_b", "_k"))
    member = member.select("id", "w", F.xxhash64("_b", "_k").alias("key"))
    bucket = member.groupBy("key").agg(F.min("id").alias("c"), F.count(F.lit(1)).alias("_m")).where("_m > 1").drop("_m")
    meets = keep(_salt_join(member, bucket), "buckets")  # only buckets of two and more

    ids = chosen.select("_id", "_h", "id").join(meets.select("id").distinct().hint("merge"), "id")
    # texts of bucket members, once for all checks below; both sides grow with the data, so no broadcast
    texts = keep(text.join(ids.hint("merge"), ["_id", "_h"]).dropDuplicates(["id"]).select("id", "_text"), "bucket-texts")

    groups = meets.select(F.col("c").alias("g"), "c", "id", "w").distinct()
    links, roots = sig.sparkSession.createDataFrame([], "a bigint, b bigint"), None
    while not (rows := keep(_open(groups, roots), "open-groups")).isEmpty():
        apart = rows.where("id <> c").select(F.col("c").alias("a"), F.col("id").alias("b")).distinct()
        apart = _with_texts(apart, texts).mapInArrow(_differences(shingle, weighting), "a bigint, b bigint, j double, d array<bigint>")
        rows = keep(_to_centre(rows, apart), "differences-to-centre")
        size = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("d")).alias("m"))
        large = keep(size.where((F.col("n") > group_texts) | (F.col("m") > group_differences)).select("g"), "large-groups")
        whole = rows.where("n > 2").join(large, "g", "left_anti").groupBy("g").agg(F.collect_list(F.struct("id", "w", "root", "d")).alias("texts"))
        links = links.unionByName(whole.mapInArrow(_forests(threshold), "a bigint, b bigint"))
        last = large.isEmpty()
        star = rows.where("n = 2")
        if not last:
            rows = keep(_salt_join(rows.where("n > 2"), large, ["g"]), "large-differences")
            star = star.unionByName(rows)
        star = star.where(F.col("j") >= threshold)
        links = links.unionByName(star.select(F.least("c", "id").alias("a"), F.greatest("c", "id").alias("b")))
        if not last:
            rows = keep(_to_core(rows, threshold), "differences")
            middle = rows.groupBy("g").agg(F.min(F.struct("excess", "id")).alias("m")).select("g", F.col("m.id").alias("c"))
            star = _star(_salt_join(rows.select("g", "id", "w"), middle, ["g"]), roots, threshold)
            star = _with_texts(star, texts).mapInArrow(_verify(shingle, weighting), "a bigint, b bigint, j double").where(F.col("j") >= threshold)
            links = links.unionByName(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        links = keep(links.distinct(), "links")
        roots = keep(components(links), "components")
        if last:
            break
        groups = keep(_parts(rows, roots), "parts")
    if roots is None:
        roots = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("_links"))
    of_rep = reps.select(*same, "id", "_rep", "_n").join(roots, "id", "left").join(degree, "id", "left")
    of_rep = of_rep.select(*same, "id", "_rep", F.coalesce("root", "id").alias("_class"), "_n", F.coalesce("_links", F.lit(0)).cast("bigint").alias("_links"))
    of_rep = keep(of_rep, "classes")
    # a class is named by the least id of its first set
    sizes = of_rep.groupBy("_class").agg(F.sum("_n").alias("_size"), F.min_by("_rep", "id").alias("_name"))
    of_rep = of_rep.join(sizes, "_class").select(*same, "_name", "_size", "_links", (F.col("id") == F.col("_class")).alias("_first"))
    out = _salt_join(sig.drop("_bands", "_h"), of_rep, same, "left", "_id")
    alone = F.col("_first").isNull() | F.col("_id").isNull()
    cls = F.when(alone, F.col("_id")).otherwise(F.col("_name"))
    kept = alone | (F.col("_first") & F.col("_id").eqNullSafe(F.col("_name")))
    out = out.select(F.col("_id").alias(id_col), cls.alias("class_id"), F.when(alone, F.lit(1)).otherwise(F.col("_size")).cast("bigint").alias("class_size"), F.when(alone, F.lit(0)).otherwise(F.col("_links")).cast("bigint").alias("n_links"), kept.alias("kept"), *(same if fingerprint else []))
    return out


def _with_roots(groups: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return groups.withColumn("root", F.col("id"))
    return groups.join(roots.hint("merge"), "id", "left").withColumn("root", F.coalesce("root", "id"))


def _star(groups: DataFrame, roots: DataFrame | None, threshold: float) -> DataFrame:
    """Pairs (a, b) of a centre and a member of another component whose sizes allow a link."""
    rows = _with_roots(groups, roots)
    centre = rows.where("id = c").select("g", F.col("root").alias("rc"), F.col("w").alias("wc"))
    rows = _salt_join(rows, centre, ["g"]).where("id <> c AND root <> rc")
    rows = rows.where(F.least("w", "wc") >= threshold * F.greatest("w", "wc") - 1e-9)
    return rows.select(F.col("c").alias("a"), F.col("id").alias("b")).distinct()


def _open(groups: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Members of the groups that hold more than one component, with their number n and root."""
    rows = _with_roots(groups, roots)
    several = rows.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo <> hi").select("g", "n")
    return _salt_join(rows, several, ["g"]).select("g", "c", "id", "w", "n", "root")


def _to_centre(rows: DataFrame, apart: DataFrame) -> DataFrame:
    """``rows`` with similarity and differences to their centre (a pair's similarity says all)."""
    apart = apart.select(F.col("a").alias("c"), F.col("b").alias("id"), "j", "d")
    none = F.array().cast("array<bigint>")
    return rows.hint("merge").join(apart, ["c", "id"], "left").withColumn("d", F.when((F.col("n") == 2) | F.col("d").isNull(), none).otherwise(F.col("d")))


def _to_core(rows: DataFrame, threshold: float) -> DataFrame:
    """(g, id, w, d, excess): differences ``d`` to the group's core, from those to its centre."""
    # where most texts differ from the centre, the core does too; a group has few of these, as each stands for n / 2 rows
    most = rows.select("g", "n", F.explode("d").alias("e")).groupBy("g", "e").agg(F.count(F.lit(1)).alias("m"), F.first("n").alias("n"))
    most = most.where("2 * m > n").groupBy("g").agg(F.collect_list("e").alias("turned"))
    rows = _salt_join(rows, most, ["g"], "left")
    turned = F.concat(F.array_except("d", "turned"), F.array_except("turned", "d"))
    rows = rows.withColumn("d", F.when(F.col("turned").isNull(), F.col("d")).otherwise(turned))
    return rows.select("g", "id", "w", "d", (F.size("d") - (1 - threshold) / (1 + threshold) * F.col("w")).alias("excess"))


def _partnered(each: DataFrame) -> DataFrame:
    """Rows (text, difference) but those that no other text with this difference can be linked over.

    A text has at most the differences here in common with another one, so a link of x and y
    needs excess(x) <= offer(y) and excess(y) <= offer(x), where offer is twice their number
    less the excess.  Rows of a linked pair keep each other, however often this is applied.
    """
    here = F.count(F.lit(1)).over(Window.partitionBy("g", "id"))
    each = keep(each.withColumn("offer", 2 * here - F.col("excess")), "offers")
    per = each.groupBy("g", "e").agg(F.min("excess").alias("low"), F.max("offer").alias("high"), F.count(F.lit(1)).alias("n"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    per = per.where("r0 <> r1").select("g", "e", "low", "high", "n")
    both = _salt_join(each, per, ["g", "e"]).where("excess <= high + 1e-9 AND low <= offer + 1e-9")
    return keep(both, "partnered")


def _parts(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Groups (g, c, id, w) of texts that share a difference, wherever a link may still be missing."""
    each = _with_roots(rows, roots).select("g", "id", "w", "root", "excess", F.explode("d").alias("e"))
    names, before = each.columns, None
    each = _partnered(each)
    while (n := each.count()) and (before is None or n < 0.9 * before):
        before = n
        each = _partnered(each.select(*names))
    # no link needs less in common than this; differences from this one on, the rarest first
    own = Window.partitionBy("g", "id")
    rest = F.count(F.lit(1)).over(own.orderBy(F.desc("n"), F.desc("e")))
    rare = each.withColumn("need", (F.col("excess") + F.min("low").over(own)) / 2 - 1e-9).withColumn("rest", rest)
    rare = keep(rare.where("rest >= need").select(*names), "shared-differences")
    part = rare.groupBy("g", "e").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("r0"), F.max("root").alias("r1"), F.bit_xor(F.xxhash64("id")).alias("h1"),
                                      F.bit_xor(F.xxhash64("id", F.lit(1))).alias("h2"), F.min(F.struct((F.col("excess") / F.col("w")).alias("x"), "id")).alias("m")).where("r0 <> r1")
    part = part.groupBy("n", "h1", "h2").agg(F.min(F.struct("g", "e", F.col("m.id").alias("c"))).alias("p")).select("p.*")
    return _salt_join(rare, part, ["g", "e"]).select(F.xxhash64("g", "e").alias("g"), "c", "id", "w")


def with_fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, weighting: str = "set") -> DataFrame:
    """``docs`` with the columns ``SAME`` that ``near_duplicates`` finds for their texts."""

    def run(batches):
        for batch in batches:
            data, offsets = byte_view(batch.column(text_col))
            parts = [(np.zeros(0), np.zeros(0, U), np.zeros(0, U))]
            for i, j in blocks(offsets, 2 << 20):
                _, _, hashes, firsts = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                grams, n = shingles(hashes, firsts, shingle)
                parts.append(_fingerprint(*elements(grams, np.repeat(np.arange(j - i), n), weighting), j - i))
            w, one, two = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(w), pa.array(to_signed(one)), pa.array(to_signed(two))], names=[*batch.schema.names, *SAME])

    return docs.mapInArrow(run, StructType([*docs.schema, *StructType.fromDDL("_w double, _f0 bigint, _f1 bigint")]))


def _salt_join(big: DataFrame, small: DataFrame, keys=("key",), how: str = "inner", by: str = "id", salts: int = 8) -> DataFrame:
    """Join with a table of few rows per key, a hot key's rows spread over ``salts`` tasks."""
    small = small.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("_s", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).join(small.hint("merge"), [*keys, "_s"], how).drop("_s")


def _with_texts(pairs: DataFrame, texts: DataFrame, per_slot: int = 64) -> DataFrame:
    """(a, b, both texts); a centre ``a`` of many pairs has a slot, and its text, for about every ``per_slot``."""
    slots = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / per_slot).cast("int").alias("_n"))
    left = texts.select(F.col("id").alias("a"), F.col("_text").alias("_ta")).join(slots.hint("merge"), "a")
    left = left.select("a", "_ta", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_slot"))
    dealt = _salt_join(pairs, slots, ["a"], by="b").select("a", "b", F.pmod(F.xxhash64("b", F.lit(1)), F.col("_n")).cast("int").alias("_slot"))
    right = texts.select(F.col("id").alias("b"), F.col("_text").alias("_tb"))
    return dealt.hint("merge").join(left, ["a", "_slot"]).hint("merge").join(right, "b").select("a", "b", "_ta", "_tb")
