"""SentencePiece encoding and decoding over a relational lattice.

A text becomes units: a run of the space mark and what follows up to the next mark.  No
piece crosses a unit's border, so units are encoded one by one.

``encode_units`` is the lattice in DataFrame form: every substring of a unit up to the
longest piece is exploded and equi-joined to the piece table (a broadcast of known
size), the edges are grouped by unit, and a higher-order ``aggregate`` folds them.  The
model file holds merge ranks, not log probabilities: the path of greatest score sum is
not what its library returns.  So the fold does not add scores from left to right; it
starts from single characters and at every step takes the edge of greatest score that
spans two neighbouring segments, leftmost first.  This gives the library's ids.

Documents: the ``common`` most frequent units of all texts are encoded that way, a table
of bounded size that every task gets.  A join of all other units back to their documents
would move the whole corpus twice; tasks encode those themselves by the same rule, with
a bounded memory of units met before.

Defined results: null and empty texts have no pieces; characters without a piece become
their UTF-8 bytes; a space mark in the text decodes as a space; repeated rows are
encoded each; an empty table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

MARK = "▁"
COMMON = 50_000
LONGEST_UNIT = 40  # characters of a unit that the lattice takes; few are longer
MEMORY = 400_000  # units a task remembers
NO_EDGE = -1e30


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_table(model: str) -> tuple[list[tuple[str, int, float]], list[int], list[str]]:
    """Pieces that text can match (piece, id, score), ids of the 256 bytes, text of every id."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    n = sp.get_piece_size()
    names = [sp.id_to_piece(i) for i in range(n)]
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
    usable = [(names[i], i, float(sp.get_score(i))) for i in range(n) if not special[i]]
    of_byte = {names[i]: i for i in range(n) if sp.is_byte(i)}
    return usable, [of_byte[f"<0x{b:02X}>"] for b in range(256)], names


# ---- the lattice as a DataFrame


def encode_units(units: DataFrame, model: str) -> DataFrame:
    """(unit, ids) of every row of ``units(unit)``; units of 1 to LONGEST_UNIT characters."""
    usable, of_byte, _ = piece_table(model)
    spark = units.sparkSession
    longest = max(len(p) for p, _, _ in usable)
    table = spark.createDataFrame(usable, "piece string, id int, score double")
    n = F.length("unit")
    starts = units.select("unit", F.explode(F.sequence(F.lit(0), n - 1)).alias("a"))
    spans = starts.select("unit", "a", F.explode(F.sequence(F.col("a") + 1, F.least(n, F.col("a") + longest))).alias("b"))
    spans = spans.withColumn("piece", F.substring("unit", F.col("a") + 1, F.col("b") - F.col("a")))
    edges = spans.join(F.broadcast(table), "piece")  # one row a piece of the model file
    edges = edges.groupBy("unit").agg(F.map_from_entries(F.collect_list(F.struct((F.col("a") * 64 + F.col("b")).alias("k"), F.struct("score", "id").alias("e")))).alias("edges"))
    rows = units.join(edges, "unit", "left")

    def edge(cuts, i, j):
        return F.try_element_at("edges", F.get(cuts, i) * 64 + F.get(cuts, j))

    def step(cuts, _):
        pairs = F.transform(F.sequence(F.lit(0), F.size(cuts) - 3), lambda i: F.struct(F.coalesce(edge(cuts, i, i + 2)["score"], F.lit(NO_EDGE)).alias("s"), (-i).alias("i")))
        merged = F.transform(F.array(F.array_max(pairs)), lambda m: F.when(m["s"] > NO_EDGE, F.concat(F.slice(cuts, F.lit(1), F.lit(1) - m["i"]), F.slice(cuts, F.lit(3) - m["i"], F.size(cuts)))).otherwise(cuts))
        return F.when(F.size(cuts) < 3, cuts).otherwise(F.get(merged, F.lit(0)))

    cuts = F.aggregate(F.sequence(F.lit(1), n), F.sequence(F.lit(0), n), step)
    rows = rows.withColumn("cuts", cuts)
    bytes_of = F.array(*(F.lit(i) for i in of_byte))

    def ids(i):
        char = F.substring("unit", F.get("cuts", i) + 1, F.lit(1))
        code = F.hex(F.encode(char, "UTF-8"))
        single = F.transform(F.sequence(F.lit(0), (F.length(code) / 2 - 1).cast("int")), lambda k: F.get(bytes_of, F.conv(F.substring(code, 2 * k + 1, F.lit(2)), 16, 10).cast("int")))
        return F.when(edge("cuts", i, i + 1).isNotNull(), F.array(edge("cuts", i, i + 1)["id"])).otherwise(single)

    return rows.select("unit", F.flatten(F.transform(F.sequence(F.lit(0), F.size("cuts") - 2), ids)).alias("ids"))


# ---- the same rule for one unit


def merge(unit: str, score: dict[str, tuple[float, int]], of_byte: list[int]) -> list[int]:
    """Ids of a unit of any length: the best-scored merge first, the leftmost of equals."""
    n = len(unit)
    end, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    queue: list[tuple[float, int, int, int]] = []

    def offer(i):
        j = end[i]
        if j < n and (e := score.get(unit[i : end[j]])) is not None:
            heapq.heappush(queue, (-e[0], i, j, end[j]))

    for i in range(n - 1):
        offer(i)
    while queue:
        _, i, j, stop = heapq.heappop(queue)
        if not (alive[i] and end[i] == j and alive[j] and end[j] == stop):
            continue
        alive[j] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
            offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    out, i = [], 0
    while i < n:
        e = score.get(unit[i : end[i]])
        if e is None:
            out += [of_byte[b] for b in unit[i : end[i]].encode()]
        else:
            out.append(e[1])
        i = end[i]
    return out


def merge_short(unit: str, rank: dict[str, float], id_of: dict[str, int], of_byte: list[int]) -> list[int]:
    """``merge`` of a short unit without a queue: segments and scores of neighbours as plain lists."""
    parts, get = list(unit), rank.get
    pairs = [get(a + b, NO_EDGE) for a, b in zip(parts, parts[1:])]
    while pairs and (best := max(pairs)) > NO_EDGE:
        i = pairs.index(best)  # the leftmost of equals
        parts[i] = now = parts[i] + parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(now + parts[i + 1], NO_EDGE)
        if i:
            pairs[i - 1] = get(parts[i - 1] + now, NO_EDGE)
    out = []
    for p in parts:
        if p in id_of:
            out.append(id_of[p])
        else:
            out += [of_byte[b] for b in p.encode()]
    return out


UNITS = re.compile(f"{MARK}+[^{MARK}]*")


def units_of(text: str) -> list[str]:
    return UNITS.findall(MARK + text.replace(" ", MARK)) if text else []


def spelling(names: list[str], of_byte: list[int]) -> pa.Array:
    """The bytes that every id stands for, the mark as a space."""
    raw = [n.replace(MARK, " ").encode() for n in names]
    for b, i in enumerate(of_byte):
        raw[i] = bytes([b])
    return pa.array(raw, pa.large_binary())


def decoded(ids: np.ndarray, cuts: np.ndarray, spelt: pa.Array) -> list[bytes]:
    """The bytes of the ids of every row, which ``cuts`` parts; the first space is dropped."""
    _, offsets, data = spelt.take(pa.array(ids)).buffers()
    at = np.frombuffer(offsets, np.int64)[cuts].tolist() if len(ids) else [0] * len(cuts)
    data = data.to_pybytes() if data is not None else b""
    return [data[a + (data[a : min(a + 1, b)] == b" ") : b] for a, b in zip(at, at[1:])]


class Units(dict):
    """Ids of units as bytes (4 little-endian ones each): the common ones and up to MEMORY others."""

    def __init__(self, score, of_byte):
        self.score, self.of_byte, self.common = score, of_byte, {}
        self.rank, self.id_of = {p: s for p, (s, _) in score.items()}, {p: i for p, (_, i) in score.items()}

    def __missing__(self, unit):
        if len(self) >= MEMORY + len(self.common):
            self.clear()
            self.update(self.common)
        short = len(unit) <= LONGEST_UNIT
        ids = merge_short(unit, self.rank, self.id_of, self.of_byte) if short else merge(unit, self.score, self.of_byte)
        got = self[unit] = array("i", ids).tobytes()
        return got


_LOADED: dict = {}


def _load(model):
    if model not in _LOADED:
        usable, of_byte, names = piece_table(model)
        _LOADED[model] = (Units({p: (s, i) for p, i, s in usable}, of_byte), spelling(names, of_byte))
    return _LOADED[model]


def _encode(model, common, with_ids):
    def run(batches):
        units, spelt = _load(model)
        units.common = common
        units.update(common)
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            packed = [b"".join(map(units.__getitem__, units_of(t))) for t in texts]
            ids = np.frombuffer(b"".join(packed), "<i4")
            cuts = np.cumsum([0] + [len(p) // 4 for p in packed])
            same = [d == t.replace(MARK, " ").encode() for d, t in zip(decoded(ids, cuts, spelt), texts)]
            cols = {"_id": batch.column("_id"), "n_pieces": pa.array(np.diff(cuts), pa.int64()), "ids_crc32": pa.array(map(zlib.crc32, packed), pa.int64()), "round_trip": pa.array(same, pa.bool_())}
            if with_ids:
                cols["ids"] = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, common: int = COMMON, with_ids: bool = False) -> DataFrame:
    """id, n_pieces, ids_crc32, round_trip of every row, and its ids if asked."""
    model = model or _public("piece_bpe_32k.model")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    marked = F.concat(F.lit(MARK), F.translate("_text", " ", MARK))
    units = rows.where("_text <> ''").select(F.explode(F.regexp_extract_all(marked, F.lit(f"{MARK}+[^{MARK}]*"), F.lit(0))).alias("unit"))
    counted = units.groupBy("unit").count().where(F.length("unit") <= LONGEST_UNIT)
    frequent = keep(counted.orderBy(F.col("count").desc(), "unit").limit(common).select("unit"), "frequent-units")
    table = {r["unit"]: np.array(r["ids"], "<i4").tobytes() for r in encode_units(frequent.repartition("unit"), model).collect()}  # ``common`` rows at most
    schema = f"_id {dict(rows.dtypes)['_id']}, n_pieces bigint, ids_crc32 bigint, round_trip boolean" + ", ids array<int>" * with_ids
    return rows.mapInArrow(_encode(model, table, with_ids), schema).withColumnRenamed("_id", id_col)


def _decode(model):
    def run(batches):
        spelt = _load(model)[1]
        for batch in batches:
            rows = [x or () for x in batch.column("_ids").to_pylist()]
            ids = np.array([i for x in rows for i in x], np.int64)
            texts = [d.decode("utf-8", "replace") for d in decoded(ids, np.cumsum([0] + [len(x) for x in rows]), spelt)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(texts, pa.string())], names=["_id", "text"])

    return run


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """id, text of rows of piece ids; null ids give an empty text."""
    rows = encoded.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("_ids"))
    return rows.mapInArrow(_decode(model or _public("piece_bpe_32k.model")), f"_id {dict(rows.dtypes)['_id']}, text string").withColumnRenamed("_id", id_col)
