"""Edit-aware token counts on segment trees of pre-tokens.

The tokenizer splits a text into pre-tokens by a regular expression and encodes each by
itself, so a text's count is the sum over its pre-tokens.  A document's state is a
segment tree: leaves hold up to ``LEAF`` neighbouring pre-tokens (their byte lengths
and token counts), every inner node the bytes and tokens below it.  An edit replaces a
range of bytes.  The tree finds the touched leaves by byte sums; splitting starts again
a little before the edit and stops where a new pre-token ends on an old border behind
it, since from there the expression sees the same text; only what lies between is
encoded, and the sums on the touched paths are updated.

Boundary context: a pre-token's end depends on at most three bytes behind it (an
apostrophe with two letters, or one character of look-ahead), so splitting starts at the
last pre-token that ends more than ``CONTEXT`` bytes before the edit.  White space looks
ahead further only within its own run, which is one pre-token or two.

Defined results: null text is empty; edits are applied in order of their start, each on
the text as it came in; overlapping or out-of-range ones raise; null edit lists change
nothing; repeated rows are counted each; an empty table gives no rows; other columns are
ignored.  Very long texts are kept whole; a tree grows by one node for 64 pre-tokens.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF = 64  # pre-tokens in a leaf; one that grows past twice as many is split
CONTEXT = 8
MEMORY = 300_000
EDITS_SQL = "array<struct<start: bigint, end: bigint, new: string>>"
EDITS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("new", pa.string())]))


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Counter:
    """Pre-tokens of a text and the token count of each."""

    def __init__(self, ranks: str):
        import public_tokenizers
        import regex
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.encoding = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.memory: dict[str, int] = {}
        self.encoded = 0  # pre-tokens that were looked at

    def count(self, token: str) -> int:
        n = self.memory.get(token)
        if n is None:
            n = len(self.encoding.encode_ordinary(token))
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            self.memory[token] = n
        return n

    def leaves(self, text: str) -> tuple[list[int], list[int]]:
        """Bytes and token counts of all pre-tokens."""
        tokens = self.split.findall(text)
        self.encoded += len(tokens)
        sizes = list(map(len, tokens)) if text.isascii() else [len(t.encode()) for t in tokens]
        return sizes, list(map(self.count, tokens))


class Tree:
    """Segment tree over leaves of pre-tokens; ``sums[k]`` holds (bytes, tokens) of level k's nodes.

    Level 0 has the leaves; an edit that leaves a leaf too large cuts it in two there and
    then, and the levels above are summed again from that leaf on.
    """

    def __init__(self, sizes: list[int], counts: list[int]):
        self.sizes = [sizes[i : i + LEAF] for i in range(0, len(sizes), LEAF)]
        self.counts = [counts[i : i + LEAF] for i in range(0, len(counts), LEAF)]
        self.hold = False  # while many edits are made, large leaves wait for the last one
        self._build()

    def _build(self):
        self.bytes = [[sum(x) for x in self.sizes] or [0]]
        self.tokens = [[sum(x) for x in self.counts] or [0]]
        if not self.sizes:
            self.sizes, self.counts = [[]], [[]]
        while len(self.bytes[-1]) > 1:
            for levels in (self.bytes, self.tokens):
                last = levels[-1]
                levels.append([sum(last[i : i + 2]) for i in range(0, len(last), 2)])

    @property
    def total(self) -> int:
        return self.tokens[-1][0]

    def find(self, at: int) -> tuple[int, int]:
        """(leaf, its first byte) of the leaf that holds byte ``at``; the last one for the end."""
        node, start = 0, 0
        for level in range(len(self.bytes) - 1, 0, -1):
            node *= 2
            below = self.bytes[level - 1]
            if node + 1 < len(below) and at >= start + below[node]:
                start += below[node]
                node += 1
        return node, start

    def update(self, leaf: int) -> None:
        """Sum the path from a changed leaf to the root."""
        self.bytes[0][leaf], self.tokens[0][leaf] = sum(self.sizes[leaf]), sum(self.counts[leaf])
        for level in range(1, len(self.bytes)):
            leaf //= 2
            for levels in (self.bytes, self.tokens):
                levels[level][leaf] = sum(levels[level - 1][2 * leaf : 2 * leaf + 2])

    def replace(self, first: int, last: int, sizes: list[int], counts: list[int]) -> None:
        """Put new pre-tokens in the place of leaves first..last."""
        per = max(1, -(-len(sizes) // (last - first + 1)))
        if per <= 2 * LEAF or self.hold:  # the leaves stay, with other pre-tokens in them
            for k, leaf in enumerate(range(first, last + 1)):
                self.sizes[leaf], self.counts[leaf] = sizes[k * per : (k + 1) * per], counts[k * per : (k + 1) * per]
                self.update(leaf)
            return
        parts = range(0, len(sizes), LEAF)
        self.sizes[first : last + 1] = [sizes[i : i + LEAF] for i in parts]
        self.counts[first : last + 1] = [counts[i : i + LEAF] for i in parts]
        self._build()

    def settle(self) -> None:
        """Cut the leaves that have grown too large, all at once."""
        self.hold = False
        if any(len(x) > 2 * LEAF for x in self.sizes):
            cut = lambda leaves: [x[i : i + LEAF] for x in leaves for i in range(0, len(x), LEAF)]
            self.sizes, self.counts = cut(self.sizes), cut(self.counts)
            self._build()

    def pack(self) -> bytes:
        """Leaves as bytes: how many pre-tokens each holds, then all sizes and counts."""
        flat = [x for leaf in self.sizes for x in leaf], [x for leaf in self.counts for x in leaf]
        return b"".join(np.array(x, "<u4").tobytes() for x in ([len(self.sizes)], [len(x) for x in self.sizes], *flat))

    @classmethod
    def unpack(cls, raw: bytes) -> Tree:
        x = np.frombuffer(raw, "<u4").tolist()
        held = x[1 : 1 + x[0]]
        n, at = sum(held), 1 + x[0]
        tree = cls([], [])
        cuts = np.concatenate([[0], np.cumsum(held)]).tolist()
        tree.sizes = [x[at + a : at + b] for a, b in zip(cuts, cuts[1:])]
        tree.counts = [x[at + n + a : at + n + b] for a, b in zip(cuts, cuts[1:])]
        tree._build()
        return tree


class Text:
    """A text that is edited from its end to its start: what lies behind the last edit is kept in pieces."""

    def __init__(self, raw: bytes):
        self.raw, self.cut, self.size = raw, len(raw), len(raw)
        self.tail: list[bytes] = []  # the pieces after ``raw[:cut]``, last one first

    def replace(self, start: int, end: int, new: bytes) -> None:
        if end > self.cut:  # not in order: put the text together first
            self.raw, self.tail = self.whole(), []
            self.cut = self.size
        self.tail += [x for x in (self.raw[end : self.cut], new) if x]
        self.cut = start
        self.size += len(new) - (end - start)

    def part(self, start: int, end: int) -> bytes:
        """Bytes [start, end) of the text as it is now."""
        out, at, k = [self.raw[start : min(end, self.cut)]], self.cut, len(self.tail)
        while at < end and k:
            k -= 1
            piece = self.tail[k]
            if at + len(piece) > start:
                out.append(piece[max(0, start - at) : end - at])
            at += len(piece)
        return b"".join(out)

    def whole(self) -> bytes:
        return self.raw[: self.cut] + b"".join(reversed(self.tail))


def edit(tree: Tree, raw: bytes, start: int, end: int, new: bytes, counter: Counter) -> bytes:
    """Replace bytes [start, end) of ``raw`` by ``new``; updates the tree, returns the text."""
    text = Text(raw)
    _edit(tree, text, start, end, new, counter)
    return text.whole()


def _edit(tree: Tree, text: Text, start: int, end: int, new: bytes, counter: Counter) -> None:
    if not 0 <= start <= end <= text.size:
        raise ValueError(f"edit of bytes {start} to {end} in a text of {text.size}")
    text.replace(start, end, new)
    shift = len(new) - (end - start)
    first, first_at = tree.find(max(0, start - CONTEXT))
    while first and first_at > start - CONTEXT:
        first -= 1
        first_at -= tree.bytes[0][first]
    # the last border that ends CONTEXT bytes and more before the edit
    head, at = 0, first_at
    sizes = tree.sizes[first]
    while head < len(sizes) and at + sizes[head] <= start - CONTEXT:
        at += sizes[head]
        head += 1
    # old borders from the edit's end on, leaf by leaf, until splitting meets one
    last, last_at = tree.find(end)
    last, last_at = max(last, first), last_at if last >= first else first_at
    borders: dict[int, tuple[int, int]] = {}

    def admit(leaf, begin):
        for k, size in enumerate(tree.sizes[leaf]):
            if begin >= end:
                borders.setdefault(begin + shift, (leaf, k))
            begin += size
        if leaf == len(tree.sizes) - 1:
            borders[begin + shift] = (leaf, len(tree.sizes[leaf]))
        return begin

    known = admit(last, last_at)
    reach = last
    new_sizes, new_counts, pos = [], [], at
    low = at
    window = 512
    stop = None
    while stop is None:
        # split a window of the new text that starts on a border; its last pre-tokens may be cut short
        piece = text.part(low, low + window + 4)
        size = min(len(piece), window)
        while size < len(piece) and piece[size] & 0xC0 == 0x80:
            size += 1
        text_end = low + size
        piece = piece[:size].decode("utf-8", "surrogateescape")
        new_sizes, new_counts, pos, stop = [], [], low, None
        spans = [m.group() for m in counter.split.finditer(piece)]
        safe = len(spans) if text_end == text.size else max(0, len(spans) - 3)
        for token in spans[:safe]:
            size = len(token.encode("utf-8", "surrogateescape"))
            new_sizes.append(size)
            new_counts.append(token)
            pos += size
            while known + shift < pos and reach + 1 < len(tree.sizes):
                reach += 1
                known = admit(reach, known)
            if pos in borders and pos >= start + len(new):
                stop = borders[pos]
                break
        if stop is None and text_end == text.size:
            stop = borders.get(pos) or (len(tree.sizes) - 1, len(tree.sizes[-1]))
        window *= 4
    counter.encoded += len(new_counts)
    counts = [counter.count(t) for t in new_counts]
    leaf, k = stop
    leaf, k = (leaf, k) if leaf >= first else (first, len(tree.sizes[first]))
    tree.replace(first, leaf, tree.sizes[first][:head] + new_sizes + tree.sizes[leaf][k:], tree.counts[first][:head] + counts + tree.counts[leaf][k:])


def apply(tree: Tree, raw: bytes, edits: list[tuple[int, int, bytes]], counter: Counter) -> bytes:
    """All edits of a text, given on the text as it came in; last one first."""
    edits = sorted(edits, key=lambda e: (e[0], e[1]))
    if any(a[1] > b[0] for a, b in zip(edits, edits[1:])):
        raise ValueError("edits overlap")
    text, tree.hold = Text(raw), True
    for start, end, new in reversed(edits):
        _edit(tree, text, start, end, new, counter)
    tree.settle()
    return text.whole()


# ---- Spark

_LOADED: dict = {}


def _counter(ranks: str) -> Counter:
    if ranks not in _LOADED:
        _LOADED[ranks] = Counter(ranks)
    return _LOADED[ranks]


def _build(ranks, find):
    def run(batches):
        counter = _counter(ranks)
        for batch in batches:
            trees = [Tree(*counter.leaves(t or "")) for t in batch.column("_text").to_pylist()]
            cols = {n: batch.column(n) for n in batch.schema.names}
            if find is not None:
                cols["_edits"] = pa.array([find(t) for t in batch.column("_text").to_pylist()], EDITS)
            cols |= {"_tree": pa.array([t.pack() for t in trees], pa.binary()), "n_tokens": pa.array([t.total for t in trees], pa.int64())}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None, edits: Column | Callable | None = None) -> DataFrame:
    """State rows (_id, _text, _tree, n_tokens), with the ``edits`` if any are given.

    ``edits`` is a column, or a function from a text to its list of edits, which runs
    in the same pass.
    """
    find = edits if edits is not None and not isinstance(edits, Column) else None
    extra = [edits.alias("_edits")] if isinstance(edits, Column) else []
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), *extra)
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + f"{', _edits ' + EDITS_SQL if find else ''}, _tree binary, n_tokens bigint"
    return rows.mapInArrow(_build(ranks or _public("byte_bpe_50k.tiktoken"), find), schema)


def _apply(ranks):
    def run(batches):
        counter = _counter(ranks)
        for batch in batches:
            out = {"_text": [], "_tree": [], "n_before": [], "n_tokens": [], "n_edits": [], "n_encoded": [], "text_crc32": []}
            for text, raw_tree, edits in zip(*(batch.column(c).to_pylist() for c in ("_text", "_tree", "_edits"))):
                raw, tree = (text or "").encode(), None
                before = after = None
                counter.encoded = 0
                if edits:
                    tree = Tree.unpack(raw_tree)
                    before = tree.total
                    raw = apply(tree, raw, [(e["start"], e["end"], (e["new"] or "").encode()) for e in edits], counter)
                    after, raw_tree = tree.total, tree.pack()
                out["_text"].append(raw.decode("utf-8", "replace")), out["_tree"].append(raw_tree)
                out["n_before"].append(before), out["n_tokens"].append(after), out["n_edits"].append(len(edits or ()))
                out["n_encoded"].append(counter.encoded), out["text_crc32"].append(zlib.crc32(raw))
            old = batch.column("n_tokens").to_pylist()
            for name in ("n_before", "n_tokens"):
                out[name] = [o if x is None else x for o, x in zip(old, out[name])]
            kinds = {"_text": pa.string(), "_tree": pa.binary()}
            cols = {"_id": batch.column("_id")} | {n: pa.array(v, kinds.get(n, pa.int64())) for n, v in out.items()}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def update(state: DataFrame, ranks: str | None = None) -> DataFrame:
    """Apply ``_edits`` (array of start, end, new; bytes of the text) to state rows.

    Returns the new state with n_before, n_tokens, n_edits, n_encoded (pre-tokens
    encoded again) and text_crc32 of the edited text.
    """
    kind = dict(state.dtypes)["_id"]
    schema = f"_id {kind}, _text string, _tree binary, n_before bigint, n_tokens bigint, n_edits bigint, n_encoded bigint, text_crc32 bigint"
    return state.mapInArrow(_apply(ranks or _public("byte_bpe_50k.tiktoken")), schema)


def update_by_id(state: DataFrame, edits: DataFrame, ranks: str | None = None) -> DataFrame:
    """The same for an edit table (_id, start, end, new), joined to stored state by id."""
    per = edits.groupBy("_id").agg(F.collect_list(F.struct("start", "end", "new")).alias("_edits"))
    return update(state.join(per, "_id", "left"), ranks)


def masks() -> Callable[[str | None], list[dict]]:
    """Edits that mask every run of four digits and more as <num>, by one pass over a text."""
    runs = re.compile(rb"[0-9]{4,}").finditer
    return lambda text: [{"start": m.start(), "end": m.end(), "new": "<num>"} for m in runs((text or "").encode())]
