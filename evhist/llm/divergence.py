"""Source divergence audit: how far each source's words stray from its language's.

Every (lang, source) group and every lang give each kept term (one in at least ``least``
documents of the lang) a smoothed share p, in billionths.  ``pair`` compares a group with
the other sources of its lang over all kept terms; ``term`` lists the terms a group uses
most above its lang, found by a dominance skyband:

    f = (p - q)**2 / q grows with the group's count and falls with the lang's, and ties go
    to the earlier UTF-8.  So a term that k others beat in all three (group count not
    lower, lang count not higher, UTF-8 earlier) is behind all of them, whatever the
    totals are.  Each partition keeps its terms that fewer than k others dominate, the
    bands of all partitions are merged by the same rule, and only what stays is ranked
    exactly.  A band may be found on any part of the terms, since dominance is transitive.

Counting combines within each task, then by (lang, term); a hot source is spread over its
terms.  Pair sums run over blocks of terms, which hold the shares of about ``TERMS`` terms
for all sources at a time and give one partial sum per pair; a lang of many sources is cut
in tiles of ``TILE`` of them.  Nothing goes through the driver.

Shares and values are whole numbers: p in decimals of 31 digits, (p - q)**2 < 2**63.

Defined results: null text, lang and source are empty strings, groups like any other;
documents are rows, also where ids are null or repeat; a group without terms counts
0 everywhere; a lang without kept terms has pairs of value 0 and no terms; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, byte_view, keep, spans, spelled

K = 200
LEAST = 3
SCALE = 1_000_000_000
TERMS = 512  # terms of a block of pair sums
TILE = 256  # sources of a tile of pair sums
SALTS = 16  # tasks that merge one group's bands
HELD = 1 << 19  # rows a task combines at a time
BLOCK = 4 << 20  # bytes of text counted at a time

# FIXED VALUES: the bytes of a term (letters and all past ASCII), and A-Z as a-z.
_TERM = np.zeros(256, bool)
_TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

COUNTS = "lang string, source string, term string, n bigint, docs bigint"
BAND = "lang string, source string, term string, n bigint, lang_n bigint"


# ---- counts


def _count(data: np.ndarray, offsets: np.ndarray, lang: pa.Array, source: pa.Array) -> pa.Table:
    """Occurrences and documents of each (lang, source, term) of a block; '' stands for the group itself."""
    lang, source = pc.dictionary_encode(lang), pc.dictionary_encode(source)
    wide = len(source.dictionary)
    group = lang.indices.to_numpy().astype(np.int64) * wide + source.indices.to_numpy()
    data = _LOWER[data]
    starts, ends, firsts = spans(_TERM[data], offsets)
    terms = pc.dictionary_encode(spelled(data, starts, ends))
    v = max(1, len(terms.dictionary))
    text = np.repeat(np.arange(len(group)), np.diff(firsts))
    once, n = np.unique(text * v + terms.indices.to_numpy(), return_counts=True)  # a term of a text
    cell, at = np.unique(group[once // v] * v + once % v, return_inverse=True)
    seen = np.unique(group)
    owner = np.concatenate([cell // v, seen])
    names = pa.concat_arrays([terms.dictionary.cast(pa.string()).take(pa.array(cell % v)), pa.array([""] * len(seen), pa.string())])
    zero = np.zeros(len(seen), np.int64)
    return pa.table({
        "lang": lang.dictionary.take(pa.array(owner // wide)),
        "source": source.dictionary.take(pa.array(owner % wide)),
        "term": names,
        "n": np.concatenate([np.bincount(at, n, len(cell)).astype(np.int64), zero]),
        "docs": np.concatenate([np.bincount(at, minlength=len(cell)), zero]),
    })


def _combined(tables: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return out.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(["lang", "source", "term", "n", "docs"])


def _counter(batches):
    held, rows = [], 0
    for batch in batches:
        data, offsets = byte_view(batch.column("_text"))
        for i, j in blocks(offsets, BLOCK):
            a = int(offsets[i])
            held.append(_count(data[a : int(offsets[j])], offsets[i : j + 1] - a, batch.column("lang").slice(i, j - i), batch.column("source").slice(i, j - i)))
            rows += len(held[-1])
            if rows > HELD:
                held = [_combined(held)]
                rows = len(held[0])
                if rows > HELD // 2:  # little to combine: pass it on
                    yield from held[0].to_batches(max_chunksize=1 << 14)
                    held, rows = [], 0
    if held:
        yield from _combined(held).to_batches(max_chunksize=1 << 14)


def term_counts(docs: DataFrame, least: int = LEAST, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """n of each kept (lang, source, term), with the lang's; term '' for each group that occurs."""
    named = {"lang": lang, "source": source, "_text": text}
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in named.items()))
    counts = rows.mapInArrow(_counter, COUNTS).repartition("lang", "term")
    counts = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    over = Window.partitionBy("lang", "term")
    counts = counts.select("lang", "term", "source", "n", F.sum("n").over(over).alias("lang_n"), F.sum("docs").over(over).alias("lang_docs"), (F.min("source").over(over) == F.col("source")).alias("first"))
    counts = counts.where((F.col("lang_docs") >= least) | (F.col("term") == ""))
    return keep(counts.drop("lang_docs"), "term-counts")


def group_totals(counts: DataFrame) -> DataFrame:
    """n and place of every (lang, source), with the lang's n, number of kept terms and of sources."""
    one = F.when(F.col("first") & (F.col("term") != ""), 1).otherwise(0)
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(one).alias("_v"))
    over = Window.partitionBy("lang")
    groups = groups.withColumns({"place": F.row_number().over(over.orderBy("source")) - 1, "lang_total": F.sum("total").over(over), "terms": F.sum("_v").over(over), "sources": F.count(F.lit(1)).over(over)})
    return keep(groups.drop("_v"), "group-totals")


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms))."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.call_function("div", top, F.nullif(total + terms, F.lit(0).cast("bigint")).cast("decimal(20,0)")) + 1


# ---- term: the skyband


def skyband(n: np.ndarray, lang_n: np.ndarray, spell: np.ndarray, k: int) -> np.ndarray:
    """Places of the terms that fewer than k others dominate.

    In the order used here a term comes after all that dominate it.  A term with k
    dominators has k of them in the band, so it is enough to count those, and the ones
    of the block at hand.
    """
    order = np.lexsort((spell, lang_n, -n))
    low, late = lang_n[order], spell[order]
    band = np.zeros(0, np.int64)
    width = 256
    earlier = np.tri(width, k=-1, dtype=bool)
    for i in range(0, len(order), width):
        at = np.arange(i, min(i + width, len(order)))
        x, y = low[at][:, None], late[at][:, None]
        beaten = ((low[at] <= x) & (late[at] < y) & earlier[: len(at), : len(at)]).sum(1)
        for j in range(0, len(band), 1 << 14):
            part = band[j : j + (1 << 14)]
            beaten += ((low[part] <= x) & (late[part] < y)).sum(1)
        band = np.concatenate([band, at[beaten < k]])
    return order[band]


def _bands(k: int):
    def reduced(tables):
        table = pa.concat_tables(tables).combine_chunks()
        by = [pc.dictionary_encode(table.column(c).combine_chunks()) for c in ("lang", "source")]
        group = by[0].indices.to_numpy().astype(np.int64) * len(by[1].dictionary) + by[1].indices.to_numpy()
        spell = np.empty(len(table), np.int64)
        spell[pc.sort_indices(table.column("term").cast(pa.large_binary())).to_numpy()] = np.arange(len(table))
        n, lang_n = table.column("n").to_numpy(), table.column("lang_n").to_numpy()
        order = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1))
        use = [rows[skyband(n[rows], lang_n[rows], spell[rows], k)] for rows in (order[a:b] for a, b in zip(cuts[:-1], cuts[1:]))]
        return table.take(pa.array(np.sort(np.concatenate(use))))

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(pa.Table.from_batches([batch]))
                rows += batch.num_rows
            if rows > HELD:
                held = [reduced(held)]
                rows = len(held[0])
                if rows > HELD // 2:  # wide bands: pass them on, the merge sees them again
                    yield from held[0].to_batches()
                    held, rows = [], 0
        if held:
            yield from reduced(held).to_batches()

    return run


def ranked_terms(counts: DataFrame, groups: DataFrame, k: int = K) -> DataFrame:
    """The k terms of each group with the greatest f above the lang's share."""
    terms = counts.where("term <> '' AND n > 0").select("lang", "source", "term", "n", "lang_n")
    band = terms.mapInArrow(_bands(k), BAND)
    band = band.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(SALTS))).mapInArrow(_bands(k), BAND)
    rows = band.join(groups, ["lang", "source"])
    rows = rows.withColumn("_p", share(F.col("n"), F.col("total"), F.col("terms"))).withColumn("_q", share(F.col("lang_n"), F.col("lang_total"), F.col("terms")))
    rows = rows.where("_p > _q").withColumn("value", F.expr("(_p - _q) * (_p - _q) div _q"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    return rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", rank.alias("rank")).where(F.col("rank") <= k)


# ---- pair: sums over blocks of terms


def _pair_sums(tile_size: int):
    def sums(lang, tile, rows):
        """Partial sums of one block; its first rows are the lang's sources with their least share."""
        kind, place, p, name, term = (np.concatenate(x) for x in zip(*rows))
        sources = kind == 0
        names, least = np.empty(sources.sum(), object), np.empty(sources.sum(), np.int64)
        names[place[sources]], least[place[sources]] = name[sources], p[sources]
        # a change of the term begins a new row of the block's matrix
        line = np.cumsum(np.append(True, term[~sources][1:] != term[~sources][:-1])[: (~sources).sum()]) - 1
        shares = np.tile(least, (int(line[-1]) + 1 if len(line) else 0, 1))
        shares[line, place[~sources]] = p[~sources]
        own = np.arange(tile * tile_size, min((tile + 1) * tile_size, len(names)))
        for s in own:
            gap = shares[:, s : s + 1] - shares
            value = (gap * gap // shares).sum(0)
            other = np.arange(len(names)) != s
            if other.any():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * int(other.sum()), pa.string()), pa.array([names[s]] * int(other.sum()), pa.string()), pa.array(names[other].tolist(), pa.string()), pa.array(value[other], pa.int64())], names=["lang", "source", "item", "value"])

    def run(batches):
        at, held = None, []
        for batch in batches:
            lang = np.array(batch.column("lang").to_pylist(), object)
            block, tile, kind, place, p = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "tile", "kind", "place", "p"))
            name, term = (np.array(batch.column(c).to_pylist(), object) for c in ("source", "term"))
            new = np.ones(len(lang), bool)
            new[1:] = (lang[1:] != lang[:-1]) | (block[1:] != block[:-1]) | (tile[1:] != tile[:-1])
            cuts = np.append(np.flatnonzero(new), len(lang))
            for a, b in zip(cuts[:-1], cuts[1:]):
                key = (lang[a], int(block[a]), int(tile[a]))
                if key != at:
                    if held:
                        yield from sums(at[0], at[2], held)
                    at, held = key, []
                held.append((kind[a:b], place[a:b], p[a:b], name[a:b], term[a:b]))
        if held:
            yield from sums(at[0], at[2], held)

    return run


def ranked_pairs(counts: DataFrame, groups: DataFrame, block_terms: int = TERMS, tile: int = TILE) -> DataFrame:
    """Every other source of each group's lang with f summed over all kept terms."""
    n_blocks = F.floor(F.col("terms") / block_terms)
    tiles = F.explode(F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / tile).cast("int"))).alias("tile")
    p = lambda n: F.coalesce(share(n, F.col("total"), F.col("terms")), F.lit(1))
    heads = groups.select("lang", "source", "place", p(F.lit(0)).alias("p"), tiles, "terms")
    heads = heads.select("lang", F.explode(F.sequence(F.lit(0).cast("bigint"), n_blocks)).alias("block"), "tile", F.lit(0).alias("kind"), "place", "p", "source", F.lit("").alias("term"))
    cells = counts.where("term <> ''").select("lang", "source", "term", "n").join(groups, ["lang", "source"])
    block = F.pmod(F.xxhash64("term"), n_blocks + 1).alias("block")
    cells = cells.select("lang", block, tiles, F.lit(1).alias("kind"), "place", p(F.col("n")).alias("p"), F.lit("").alias("source"), "term")
    rows = heads.unionByName(cells).repartition("lang", "block", "tile").sortWithinPartitions("lang", "block", "tile", "kind", "term")
    pairs = rows.mapInArrow(_pair_sums(tile), "lang string, source string, item string, value bigint")
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def audit(docs: DataFrame, k: int = K, least: int = LEAST, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, part (pair or term), item, value and rank from 1 per group and part."""
    counts = term_counts(docs, least, lang, source, text)
    groups = group_totals(counts)
    return ranked_pairs(counts, groups).unionByName(ranked_terms(counts, groups, k))
