"""Language-model scores by prediction by partial matching over bytes.

The trie holds byte contexts of up to ORDER bytes with the counts of the bytes that follow them.  A
byte is coded in the longest context known; a byte not seen there costs an escape (method C: as
likely as the number of different bytes seen, and what followed the context without becoming a node)
and is sought in the next shorter context, without the bytes that the longer one would have coded
(exclusion).  Below order 0 all remaining bytes are equal.
Each text ends with the byte 0xFF, which UTF-8 never uses, so the scores are probabilities of texts.

Counts of contexts and words are gathered from all training texts by Spark, and every counted context
is a node.  The probability of a byte depends on its gram alone (the ORDER bytes before it and itself).
Grams and words that hold at least a fixed share of all counts are broadcast, so these tables have a
proven size at any input.  The others are dealt to slots by their last LOW context bytes, so a slot holds
all longer contexts of its grams; the nodes of the shorter ones, at most 256^LOW of an order, go to
every task.  What travels is packed: sorted, delta-coded and compressed counts of a slot, and the open
grams of a block of texts with their rows and times.  A slot's task answers with sums per row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekcast.llm.common import one_row, staged, unstage
from weekcast.session import ship_package

ORDER = 5
#: A gram is broadcast with its probability if it is at least 1 / NODES of all bytes: at most NODES grams.
NODES = 1 << 20
#: Context bytes by which grams are grouped; orders below LOW are in every task, as at most 256^LOW nodes
#: (16.8 million, 268 MB, if every three bytes occurred; text has far fewer).
LOW = 3
#: Most slots, a power of two; fewer for less text.
SLOTS = 1 << 14
#: A word is broadcast with its count if it is at least 1 / WORDS of all tokens: at most WORDS words.
WORDS = 1 << 20
#: Bytes handled at once, distinct keys that a counting task holds before it passes them on, and open
#: grams or words that a scoring task holds.
CHUNK = 1 << 19
HELD = 1_500_000
OPEN = 2_000_000
END = 0xFF
_GRAM, _WORD, _DOCS, _BASE, _ROW = range(5)
_MIX = np.uint64(0x9E3779B97F4A7C15)


# -- texts as byte arrays --------------------------------------------------------------------------

@dataclass
class Bytes:
    """Segments of texts laid end to end, each behind the ORDER bytes before it."""
    data: np.ndarray
    body: np.ndarray            # False on the context bytes
    doc: np.ndarray             # text of each segment
    start: np.ndarray           # first byte of each segment's body

    def grams(self) -> np.ndarray:
        """Per body byte, its context and itself in one number, the byte lowest."""
        code = np.zeros(len(self.data), np.uint64)
        wide = self.data.astype(np.uint64)
        for k in range(ORDER + 1):
            code[k:] |= wide[:len(wide) - k] << np.uint64(8 * k)
        return code[self.body]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, text) of every word, A-Z lower-cased."""
        low = _LOWER[self.data]
        part = _SPACE[low] | ~self.body
        part[self.data == END] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[True], part, [True]]).astype(np.int8)))
        begin, stop = edge[::2], edge[1::2]
        powers, inverse = _powers(len(low))
        sums = np.append(np.zeros(1, np.uint64), np.cumsum(_RANDOM[low] * powers[:len(low)], dtype=np.uint64))
        code = (sums[stop] - sums[begin]) * inverse[begin] + (stop - begin).astype(np.uint64)
        # the mixed hash spreads over both ends of the number
        code = (code ^ (code >> np.uint64(29))) * _MIX
        return code, self.doc[np.searchsorted(self.start, begin, side="right") - 1]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_RANDOM = np.random.default_rng(0xB0A7).integers(0, 1 << 64, 256, dtype=np.uint64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = int(_MIX)
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = [np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)]).cumprod(dtype=np.uint64)
                      for b in (base, pow(base, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def _segments(text: bytes) -> Iterator[bytes]:
    """A text in parts of about CHUNK bytes that end behind white space (a longer word stays whole)."""
    at = 0
    while len(text) - at > CHUNK:
        cut = max(text.rfind(c, at, at + CHUNK) for c in (b" ", b"\n"))
        if cut < at:
            cut = min((p for c in (b" ", b"\n") if (p := text.find(c, at + CHUNK)) >= 0), default=len(text) - 1)
        yield text[at:cut + 1]
        at = cut + 1
    yield text[at:]


def _chunks(texts: list[str | None]) -> Iterator[Bytes]:
    parts, body, doc, start, size = [], [], [], [], 0

    def done():
        lengths = np.array(body)
        keep = np.ones(size, bool)
        keep[(np.array(start)[:, None] - np.arange(1, ORDER + 1)).ravel()] = False
        assert lengths.sum() == keep.sum()
        return Bytes(np.frombuffer(b"".join(parts), np.uint8), keep, np.array(doc), np.array(start))
    for i, t in enumerate(texts):
        raw = (t or "").encode("utf-8", "replace")
        before = bytes([END]) * ORDER
        pieces = list(_segments(raw))
        for k, seg in enumerate(pieces):
            own = seg + bytes([END]) if k == len(pieces) - 1 else seg
            parts += [before, own]
            start.append(size + ORDER)
            body.append(len(own))
            doc.append(i)
            size += ORDER + len(own)
            before = (before + seg)[-ORDER:]
            if size >= CHUNK:
                yield done()
                parts, body, doc, start, size = [], [], [], [], 0
    if parts:
        yield done()


# -- counting --------------------------------------------------------------------------------------

def _tally(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    which, distinct = pd.factorize(code)
    return distinct, np.bincount(which, minlength=len(distinct))


class _Tallies:
    """Counts by key, merged while a task runs and passed on when there are many."""

    def __init__(self, kind: int):
        self.kind, self.keys, self.counts, self.size = kind, [], [], 0

    def add(self, code: np.ndarray):
        k, n = _tally(code)
        self.keys.append(k)
        self.counts.append(n)
        self.size += len(k)

    def merged(self):
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        which, distinct = pd.factorize(keys)
        total = np.bincount(which, weights=counts, minlength=len(distinct)).astype(np.int64)
        self.keys, self.counts, self.size = [distinct], [total], len(distinct)

    def rows(self, slots: int):
        """Packed counts of every slot."""
        if self.size:
            self.merged()
            yield from _blobs(self.kind, *_by_slot(self.kind, self.keys[0], slots, self.counts[0]))
        self.keys, self.counts, self.size = [], [], 0


def _slot(kind: int, code: np.ndarray, slots: int) -> np.ndarray:
    """Slot of each code: grams by their last LOW context bytes, words by their highest bits."""
    shift = np.uint64(64 - (slots - 1).bit_length()) if slots > 1 else np.uint64(63)
    if kind == _GRAM:
        code = (code >> np.uint64(8) & np.uint64((1 << 8 * LOW) - 1)) * _MIX
    return (code >> shift).astype(np.int64) if slots > 1 else np.zeros(len(code), np.int64)


def _by_slot(kind: int, code: np.ndarray, slots: int, *more: np.ndarray):
    """Codes sorted by slot and code, the rest in the same order (ties stay), and each slot's stretch."""
    slot = _slot(kind, code, slots)
    # 48 bits hold a gram; the slot of a word is its highest bits
    key = code | slot.astype(np.uint64) << np.uint64(48) if kind == _GRAM else code
    order = np.argsort(key, kind="stable")
    slot = slot[order]
    start = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, np.int64)
    return (code[order], *(m[order] for m in more)), slot[start], np.append(start, len(slot))


_PACKED = pa.schema([("kind", pa.int32()), ("slot", pa.int64()), ("blob", pa.binary())])


def _blobs(kind, columns, slot, edge):
    step = 256
    for lo in range(0, len(slot), step):
        blobs = [pack(*(c[edge[i]:edge[i + 1]] for c in columns)) for i in range(lo, min(lo + step, len(slot)))]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(blobs), kind, np.int32)), pa.array(slot[lo:lo + step]),
                                          pa.array(blobs, pa.binary())], schema=_PACKED)


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplanes(data: bytes, at: int, n: int, kind) -> tuple[np.ndarray, int]:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind), at + n * width


def pack(code: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending codes and their counts: differences, byte by byte, compressed."""
    raw = _planes(np.diff(code, prepend=np.zeros(1, np.uint64))) + _planes(n.astype(np.uint64))
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(blob[:8], "little")
    raw = pa.decompress(blob[8:], size, "zstd", asbytes=True)
    delta, at = _unplanes(raw, 0, size // 16, np.uint64)
    return np.cumsum(delta, dtype=np.uint64), _unplanes(raw, at, size // 16, np.uint64)[0].astype(np.int64)


def pack_open(code: np.ndarray, row: np.ndarray) -> bytes:
    """Open codes of a block, ascending, with the row of each (ascending per code, repeats allowed): the
    distinct codes, the rows of each, and how often each stands in the row."""
    new = np.append(True, code[1:] != code[:-1])
    first = np.flatnonzero(new | np.append(True, row[1:] != row[:-1]))
    times = np.diff(np.append(first, len(code)))
    begin = np.flatnonzero(new[first])
    raw = _planes(np.diff(code[first][begin], prepend=np.zeros(1, np.uint64))) \
        + _planes(np.diff(np.append(begin, len(first))).astype(np.uint32)) \
        + _planes(row[first].astype(np.uint32)) + _planes(times.astype(np.uint32))
    head = np.array([len(raw), len(begin), len(first)], "<u8").tobytes()
    return head + pa.compress(raw, "zstd", asbytes=True)


def unpack_open(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct codes, place of each entry's code, its row, its times)."""
    size, codes, entries = (int(x) for x in np.frombuffer(blob, "<u8", 3))
    raw = pa.decompress(blob[24:], size, "zstd", asbytes=True)
    delta, at = _unplanes(raw, 0, codes, np.uint64)
    rows, at = _unplanes(raw, at, codes, np.uint32)
    row, at = _unplanes(raw, at, entries, np.uint32)
    times, at = _unplanes(raw, at, entries, np.uint32)
    return np.cumsum(delta, dtype=np.uint64), np.repeat(np.arange(codes), rows), row.astype(np.int64), times.astype(np.float64)


def _count(slots: int):
    def run(batches):
        grams, words, docs = _Tallies(_GRAM), _Tallies(_WORD), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            docs += len(texts)
            for chunk in _chunks(texts):
                grams.add(chunk.grams())
                words.add(chunk.words()[0])
                for t in (grams, words):
                    if t.size > HELD:
                        t.merged()
                        if t.size > HELD // 2:
                            yield from t.rows(slots)
        for t in (grams, words):
            yield from t.rows(slots)
        one = pack(np.zeros(1, np.uint64), np.array([docs]))
        yield pa.RecordBatch.from_arrays([pa.array([_DOCS], pa.int32()), pa.array([0]), pa.array([one], pa.binary())], schema=_PACKED)
    return run


def _sum(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, and the sums of their counts."""
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    return code[first], np.add.reduceat(n, first)


def _merge(batches):
    """One packed row per slot; a slot's parts are added up whenever they hold many codes."""
    now, parts, held = None, [], 0

    def total():
        return _sum(*(np.concatenate(x) for x in zip(*parts)))

    def row():
        code, n = total()
        return pa.RecordBatch.from_pydict({"kind": [now[0]], "slot": [now[1]], "blob": [pack(code, n)],
                                           "total": [int(n.sum())], "distinct": [len(code)]}, schema=_MERGED)
    for batch in batches:
        for kind, slot, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if now is not None and now != (kind, slot):
                yield row()
                parts, held = [], 0
            now = kind, slot
            parts.append(unpack(blob))
            held += len(parts[-1][0])
            if held > 2 * HELD:
                parts = [total()]
                held = len(parts[0][0])
    if now is not None:
        yield row()


_MERGED = pa.schema([*_PACKED, ("total", pa.int64()), ("distinct", pa.int64())])


def slots_for(docs: DataFrame, text: str = "text") -> int:
    """Slots for a table: distinct contexts grow slower than the text, so the root of its bytes decides."""
    size = one_row(docs.agg(F.sum(F.octet_length(text))))[0] or 0
    return min(SLOTS, 1 << (int(size ** 0.5) >> 6).bit_length())


def packed(docs: DataFrame, text: str = "text", slots: int | None = None) -> DataFrame:
    """(kind, slot, blob, total, distinct): packed counts of byte contexts with their next byte, of words,
    and of texts; one row per kind and slot."""
    ship_package(docs.sparkSession)
    slots = slots or slots_for(docs, text)
    return docs.select(text).mapInArrow(_count(slots), "kind int, slot long, blob binary") \
        .repartition("kind", "slot").sortWithinPartitions("kind", "slot") \
        .mapInArrow(_merge, "kind int, slot long, blob binary, total long, distinct long")


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """(kind, code, n): counts of byte contexts with their next byte, of words, and of texts."""
    def run(batches):
        for batch in batches:
            for kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                code, n = unpack(blob)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), kind, np.int32)), pa.array(code.view(np.int64)),
                                                  pa.array(n)], names=["kind", "code", "n"])
    return packed(docs, text).select("kind", "blob").mapInArrow(run, "kind int, code long, n long")


# -- model -----------------------------------------------------------------------------------------

class Table:
    """Open addressing over unique 64-bit keys: the place of a key in the arrays it came with."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(4 * max(len(keys), 1) - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.place = np.full(1 << bits, -1, np.int32)
        self.key = np.zeros(1 << bits, np.uint64)
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = self.place[at] < 0
            self.place[at[free]] = left[free]
            self.key[at[free]] = keys[left[free]]
            lost = self.place[at] != left
            at, left = (at[lost] + 1) & self.mask, left[lost]

    def _home(self, keys):
        return ((keys * _MIX) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 if it is not there."""
        at = self._home(keys)
        out = self.place.take(at)
        todo = np.flatnonzero((out >= 0) & (self.key.take(at) != keys))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            out[todo] = self.place[at[todo]]
            todo = todo[(out[todo] >= 0) & (self.key[at[todo]] != keys[todo])]
        return out


class Level:
    """Nodes of one order with their counts, and the contexts that they follow."""

    def __init__(self, code: np.ndarray, n: np.ndarray, size: int, below: Level | None):
        order = 0 if below is None else below.order + 1
        self.order, self.code, self.n = order, code, n.astype(np.float64)
        self.ctx, self.where = np.unique(code >> np.uint64(8), return_inverse=True)
        self.held = np.bincount(self.where, self.n, len(self.ctx))
        self.kinds = np.bincount(self.where, minlength=len(self.ctx))
        # all that followed the context, nodes or not: its own count as a node one order lower
        if below is None:
            occurs = np.full(len(self.ctx), float(size))
        else:
            at = below.nodes.find(self.ctx)
            occurs = np.where(at >= 0, np.append(below.n, 0.0)[at], 0.0)
        self.total = np.maximum(self.held, occurs)
        self.nodes, self.contexts = Table(code), Table(self.ctx)
        self.log_n = np.log10(self.n)
        self.log_p = np.log10(self.n / (self.total + self.kinds)[self.where])
        self.log_escape = np.log10((self.total - self.held + self.kinds) / (self.total + self.kinds))
        if below is not None:
            self._exclude(below)

    def _exclude(self, below: Level):
        """What is left one order lower for each context here: the bytes coded here are excluded."""
        here = below.contexts.find(self.ctx & np.uint64((1 << 8 * below.order) - 1))
        same = below.nodes.find(self.code & np.uint64((1 << 8 * (below.order + 1)) - 1))
        taken = np.bincount(self.where, below.n[same], len(self.ctx))
        rest, more = below.total[here] - taken, below.kinds[here] - self.kinds
        novel = below.total[here] - below.held[here] + more
        self.below_all = np.log10(np.maximum(rest + more, 1))
        self.below_escape = np.where(novel > 0, np.log10(np.maximum(novel, 1) / np.maximum(rest + more, 1)), 0.0)


def levels_of(codes: list[np.ndarray], counts: list[np.ndarray], size: int, below: list[Level] = ()) -> list[Level]:
    """The levels of the given orders on top of those below."""
    out = list(below)
    for code, n in zip(codes, counts):
        out.append(Level(code, n, size, out[-1] if out else None))
    return out


def log10_of(levels: list[Level], grams: np.ndarray) -> np.ndarray:
    """log10 probability of each byte after its context."""
    out = np.zeros(len(grams))
    left = np.arange(len(grams))
    over = np.full(len(grams), -1, np.int64)           # place of the context above, if it is known
    for order in range(len(levels) - 1, -1, -1):
        level = levels[order]
        g = grams[left] & np.uint64((1 << 8 * (order + 1)) - 1) if order + 1 < 8 else grams[left]
        at = level.nodes.find(g)
        hit = at >= 0
        free, o = over[left] < 0, over[left]
        out[left[hit & free]] += level.log_p[at[hit & free]]
        if order + 1 < len(levels):
            up = levels[order + 1]
            ex = hit & ~free
            out[left[ex]] += level.log_n[at[ex]] - up.below_all[o[ex]]
            ex = ~hit & ~free
            out[left[ex]] += up.below_escape[o[ex]]
        miss = left[~hit]
        ctx = level.contexts.find(g[~hit] >> np.uint64(8))
        known = (ctx >= 0) & free[~hit]
        out[miss[known]] += level.log_escape[ctx[known]]
        over[miss] = ctx
        left = miss
    out[left] -= np.log10(max(256 - (len(levels[0].code) if levels else 0), 1))
    return out


@dataclass
class Model:
    """The trie by order: nodes (context and byte) and their counts; ``build`` derives the rest."""
    codes: list[np.ndarray]
    counts: list[np.ndarray]
    word_codes: np.ndarray
    word_counts: np.ndarray
    tokens: int = 0
    distinct: int = 0
    docs: int = 0
    size: int = 0                                      # bytes counted
    grams: tuple[np.ndarray, np.ndarray] | None = None  # frequent grams and log10 probabilities, in place of nodes
    levels: list = field(default_factory=list)
    word_table: Table | None = None
    gram_table: Table | None = None

    def __getstate__(self):
        return {**self.__dict__, "levels": [], "word_table": None, "gram_table": None}

    def build(self) -> Model:
        if self.word_table is None:
            self.word_table = Table(self.word_codes)
            if self.grams is not None:
                self.gram_table = Table(self.grams[0])
            self.levels = levels_of(self.codes, self.counts, self.size)
        return self

    def settled(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each byte, 0 where it is not known here, and where it is known."""
        if self.grams is None:
            return self.log10(grams), np.ones(len(grams), bool)
        at = self.gram_table.find(grams)
        return np.append(self.grams[1], 0.0)[at], at >= 0

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of each byte after its context."""
        return log10_of(self.levels, grams)


def _totals(sums: DataFrame) -> dict[int, tuple[int, int]]:
    """Sum and number of the counts of each kind, from (kind, s, k)."""
    return {r["kind"]: (r["s"], r["k"]) for r in
            sums.groupBy("kind").agg(F.sum("s").alias("s"), F.sum("k").alias("k")).collect()}  # three rows


def _model(total: dict, words: np.ndarray, word_n: np.ndarray, codes: list, sizes: list, **more) -> Model:
    docs = total.get(_DOCS, (0, 0))[0] or 0
    tokens, distinct = total.get(_WORD, (0, 0))
    return Model(codes, sizes, words, word_n, tokens + docs, distinct + (docs > 0), docs, total.get(_GRAM, (0, 0))[0], **more)


def fit(counts: DataFrame, nodes: int = NODES, words: int = WORDS) -> Model:
    """A model cut to the nodes with at least 1 / ``nodes`` of all bytes, from ``counted``.  The driver
    receives these, at most ``nodes`` per order, the words over their share, at most ``words``, and three sums."""
    counts = staged(counts, "counted")
    total = _totals(counts.select("kind", F.col("n").alias("s"), F.lit(1).alias("k")))
    grams = counts.where(F.col("kind") == _GRAM)
    orders = F.explode(F.array(*[F.struct(F.lit(k).alias("order"), F.col("code").bitwiseAND(
        F.lit((1 << 8 * (k + 1)) - 1)).alias("code")) for k in range(ORDER + 1)]))
    trie = grams.select("n", orders.alias("o")).groupBy("o.order", "o.code").agg(F.sum("n").alias("n")) \
        .where(F.col("n") * nodes >= total.get(_GRAM, (0, 0))[0]).toArrow()
    often = counts.where((F.col("kind") == _WORD) & (F.col("n") * words >= total.get(_WORD, (0, 0))[0])).select("code", "n").toArrow()
    unstage(counts)
    order, code = trie.column("order").to_numpy(), trie.column("code").to_numpy().view(np.uint64)
    n = trie.column("n").to_numpy()
    by = [np.flatnonzero(order == k) for k in range(ORDER + 1)]
    return _model(total, often.column("code").to_numpy().view(np.uint64), often.column("n").to_numpy(),
                  [code[i] for i in by], [n[i] for i in by])


def _log_p(code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log10 probability of counted grams, ascending: each is coded in its longest context."""
    ctx = code >> np.uint64(8)
    first = np.flatnonzero(np.append(True, ctx[1:] != ctx[:-1])) if len(ctx) else np.zeros(0, np.int64)
    kinds = np.diff(np.append(first, len(ctx)))
    return np.log10(n / np.repeat(np.add.reduceat(n, first) + kinds if len(first) else kinds, kinds))


def _frequent(least_gram: int, least_word: int):
    """(kind, code, n, log): the grams and words that are broadcast, and the nodes of order LOW - 1."""
    def run(batches):
        for batch in batches:
            for kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                code, n = unpack(blob)
                log = _log_p(code, n) if kind == _GRAM else np.zeros(len(code))
                often = n >= (least_gram if kind == _GRAM else least_word)
                out = [(kind, code[often], n[often], log[often])]
                if kind == _GRAM:
                    short, sums = _sum(code & np.uint64((1 << 8 * LOW) - 1), n)
                    out.append((_BASE, short, sums, np.zeros(len(short))))
                for kind_, c, k, g in out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), kind_, np.int32)), pa.array(c.view(np.int64)),
                                                      pa.array(k), pa.array(g)], names=["kind", "code", "n", "log"])
    return run


def whole(counts: DataFrame, nodes: int = NODES, words: int = WORDS) -> tuple[Model, tuple]:
    """The model of all counted contexts, from a staged ``packed`` table: frequent grams and words, and the
    nodes of order LOW - 1 for the other grams.  The driver receives at most ``nodes`` grams, ``words``
    words, 256^LOW nodes and three sums."""
    total = _totals(counts.select("kind", F.col("total").alias("s"), F.col("distinct").alias("k")))
    size, tokens = total.get(_GRAM, (0, 0))[0], total.get(_WORD, (0, 0))[0]
    got = counts.where(F.col("kind") != _DOCS).select("kind", "blob") \
        .mapInArrow(_frequent(max(1, -(-size // nodes)), max(1, -(-tokens // words))), "kind int, code long, n long, log double") \
        .groupBy("kind", "code").agg(F.sum("n").alias("n"), F.max("log").alias("log")).toArrow()
    kind, code = got.column("kind").to_numpy(), got.column("code").to_numpy().view(np.uint64)
    n, log = got.column("n").to_numpy(), got.column("log").to_numpy()
    base = np.flatnonzero(kind == _BASE)
    base = base[np.argsort(code[base])]
    model = _model(total, code[kind == _WORD], n[kind == _WORD], [], [], grams=(code[kind == _GRAM], log[kind == _GRAM]))
    return model, (size, code[base], n[base])


_LEVELS: dict[str, list[Level]] = {}


def _low_levels(low) -> list[Level]:
    """Levels of the orders below LOW, built once per worker and model."""
    name = low.value["name"]
    if name not in _LEVELS:
        size, code, n = low.value["base"]
        short = [_sum(code & np.uint64((1 << 8 * (k + 1)) - 1), n) for k in range(LOW)] if len(code) else []
        _LEVELS.clear()
        _LEVELS[name] = levels_of([c for c, _ in short], [k for _, k in short], size)
    return _LEVELS[name]


class _Slot:
    """Counts of a slot, and what it answers to a block's open codes."""

    def __init__(self, kind: int, code: np.ndarray, n: np.ndarray, low):
        self.kind, self.code, self.n, self.low = kind, code, n, low
        self.log = _log_p(code, n) if kind == _GRAM else np.log10(n + 1.0)
        self.levels = None

    def _novel(self, grams: np.ndarray) -> np.ndarray:
        if self.levels is None:
            size = self.low.value["base"][0]
            short = [_sum(self.code & np.uint64((1 << 8 * (k + 1)) - 1), self.n) if len(self.code) else (self.code, self.n)
                     for k in range(LOW, ORDER + 1)]
            self.levels = levels_of([c for c, _ in short], [k for _, k in short], size, _low_levels(self.low))
        return log10_of(self.levels, grams)

    def answer(self, blob: bytes):
        """(rows, words known, their logs, log10 probability) of a block's open codes."""
        code, which, row, times = unpack_open(blob)
        at = np.searchsorted(self.code, code)
        hit = at < len(self.code)
        hit[hit] = self.code[at[hit]] == code[hit]
        log = np.zeros(len(code))
        log[hit] = self.log[at[hit]]
        if self.kind == _GRAM and not hit.all():
            log[~hit] = self._novel(code[~hit])
        local, place = np.unique(row, return_inverse=True)
        sums = np.bincount(place, times * log[which], len(local))
        none = np.zeros(len(local))
        if self.kind == _GRAM:
            return local, none.astype(np.int64), none, sums
        return local, np.bincount(place, times * hit[which], len(local)).astype(np.int64), sums, none


# -- scoring ---------------------------------------------------------------------------------------

_DEALT = pa.schema([("kind", pa.int32()), ("slot", pa.int64()), ("part", pa.int32()), ("row", pa.int64()), ("blob", pa.binary()),
                    ("key", pa.int64()), ("n_words", pa.int64()), ("known", pa.int64()), ("logs", pa.float64()), ("score", pa.float64())])
_DEALT_DDL = ("kind int, slot long, part int, row long, blob binary, "
              "key long, n_words long, known long, logs double, score double")
_ROWS = ("row", "key", "n_words", "known", "logs", "score")


def _batch(n: int, **columns) -> pa.RecordBatch:
    """Rows of the dealt table; columns that are not given are null."""
    return pa.RecordBatch.from_arrays([
        c.cast(f.type) if isinstance(c := columns.get(f.name), pa.Array) else pa.nulls(n, f.type) if c is None else pa.array(c, f.type)
        for f in _DEALT], schema=_DEALT)


class _Open:
    """Codes of a kind that a block of texts leaves open, with their rows, until they are packed."""

    def __init__(self, kind: int, slots: int):
        self.kind, self.slots, self.codes, self.rows, self.size = kind, slots, [], [], 0

    def add(self, code: np.ndarray, row: np.ndarray):
        self.codes.append(code)
        self.rows.append(row)
        self.size += len(code)

    def packed(self):
        if self.size:
            row = np.concatenate(self.rows)
            first = int(row.min())
            (code, row), slot, edge = _by_slot(self.kind, np.concatenate(self.codes), self.slots, row - first)
            for lo in range(0, len(slot), 256):
                some = slot[lo:lo + 256]
                blobs = [pack_open(code[edge[i]:edge[i + 1]], row[edge[i]:edge[i + 1]]) for i in range(lo, lo + len(some))]
                n = len(some)
                yield _batch(n, kind=np.full(n, self.kind), slot=some, part=np.ones(n, np.int32), row=np.full(n, first), blob=blobs)
        self.codes, self.rows, self.size = [], [], 0


def _score(model, slots: int):
    """A row per text with what the broadcast tables settle, and packed rows of what they leave open."""
    def run(batches):
        m = model.value["model"].build()
        row = TaskContext.get().partitionId() << 33
        log_c = np.log10(m.word_counts + 1.0)
        grams_open, words_open = _Open(_GRAM, slots), _Open(_WORD, slots)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            n = len(texts)
            if not n:
                continue
            words, known = np.zeros(n, np.int64), np.zeros(n, np.int64)
            logs, score = np.zeros(n), np.zeros(n)
            for chunk in _chunks(texts):
                grams = chunk.grams()
                p, settled = m.settled(grams)
                cut = np.cumsum(np.append(0, np.diff(np.append(chunk.start - ORDER, len(chunk.data))) - ORDER))
                sums = np.append(0.0, np.cumsum(p))
                np.add.at(score, chunk.doc, sums[cut[1:]] - sums[cut[:-1]])
                left = np.flatnonzero(~settled)
                grams_open.add(grams[left], row + np.repeat(chunk.doc, np.diff(cut))[left])
                code, doc = chunk.words()
                at = m.word_table.find(code)
                hit = at >= 0
                words += np.bincount(doc, minlength=n)
                known += np.bincount(doc[hit], minlength=n)
                logs += np.bincount(doc[hit], log_c[at[hit]], n)
                words_open.add(code[~hit], row + doc[~hit])
                for o in (grams_open, words_open):
                    if o.size > OPEN:
                        yield from o.packed()
            ids = row + np.arange(n)
            yield _batch(n, kind=np.full(n, _ROW), slot=ids, part=np.ones(n, np.int32), row=ids, key=keys, n_words=words,
                         known=known, logs=logs, score=score)
            row += n
        for o in (grams_open, words_open):
            yield from o.packed()
    return run


def _answers(low):
    """Partial sums per row: the texts' own rows as they are, and what each slot answers to its blocks.
    A slot's counts come first, then its blocks one by one."""
    def run(batches):
        at, slot = None, None
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            own = np.flatnonzero(kind == _ROW)
            if len(own):
                yield batch.take(pa.array(own)).select(_ROWS)
            out, held = [], 0
            for i in np.flatnonzero(kind != _ROW).tolist():
                k, s, part, row, blob = (batch.column(c)[i].as_py() for c in ("kind", "slot", "part", "row", "blob"))
                if at != (k, s):
                    at = k, s
                    slot = _Slot(k, *(unpack(blob) if part == 0 else (np.zeros(0, np.uint64), np.zeros(0, np.int64))), low)
                if part:
                    local, known, logs, score = slot.answer(blob)
                    out.append((local + row, known, logs, score))
                    held += len(local)
                    if held > 100_000:
                        yield _partial(out)
                        out, held = [], 0
            if out:
                yield _partial(out)
    return run


def _partial(out: list) -> pa.RecordBatch:
    row, known, logs, score = (np.concatenate(c) for c in zip(*out))
    n = len(row)
    return pa.RecordBatch.from_arrays([pa.array(row), pa.nulls(n, pa.int64()), pa.array(np.zeros(n, np.int64)), pa.array(known),
                                       pa.array(logs), pa.array(score)], names=list(_ROWS))


def held_out(key: Column, parts: int = 7, part: int = 2) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % parts == part


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", nodes: int | None = None, words: int = WORDS) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    ``base_score``: add-one unigram log10 probability of the words and one end; ``score``: log10
    probability of the whole text by the byte model.  Both learn from the rows that are not held out.
    ``nodes`` asks for a smaller model of the contexts with at least 1 / ``nodes`` of all bytes.
    Null texts are empty: one token, the end.  Repeated rows are counted and scored one by one; null
    keys hash as an empty string; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    train = docs.where(~held_out(F.col(key).cast("long")))
    slots = slots_for(train, text)
    counts = staged(packed(train, text, slots), "counts")
    model, base = whole(counts, words=words) if nodes is None else (fit(counted(train, text), nodes, words), None)
    shared = spark.sparkContext.broadcast({"model": model, "base": base, "name": uuid.uuid4().hex})
    dealt = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(_score(shared, slots), _DEALT_DDL)
    none = [F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in _DEALT_DDL.split(", ")[5:]]
    known = counts.where(F.col("kind") != _DOCS).select("kind", "slot", F.lit(0).alias("part"), F.lit(0).cast("long").alias("row"), "blob", *none)
    order = ["kind", "slot", "part"]
    parts = dealt.unionByName(known).repartition("kind", "slot").sortWithinPartitions(*order) \
        .mapInArrow(_answers(shared), "row long, key long, n_words long, known long, logs double, score double")
    done = parts.groupBy("row").agg(F.max("key").alias("key"), *[F.sum(c).alias(c) for c in _ROWS[2:]])
    end = float(np.log10(model.docs + 1.0))
    total = float(np.log10(model.tokens + model.distinct + 1.0))
    tokens = F.col("n_words") + 1
    done = staged(done.select(
        F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), tokens.alias("n_tokens"),
        (F.col("known") + int(model.docs > 0)).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + end - tokens * total).alias("base_score"), "score"), "scores")
    unstage(counts)
    return done
