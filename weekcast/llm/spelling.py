"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

One edit changes a word's letter counts by a vector of squared length 2 (a replaced letter) or 1 (an
inserted or deleted one), and its length by at most 1.  Words of one length are cut into cells by how
many of their letters fall into each of CLASSES classes, and large cells into blocks of BLOCK words; an
edit leads to few other cells only.  For each pair of such blocks numpy multiplies the matrices of
letter counts, which gives all squared distances; pairs at most two apart are verified letter by letter.

Pairs never leave their task: a block pair answers with one row per word, the number of near words and
the most frequent of them, and Spark adds these up.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.llm.common import UPPER, staged, unstage, whole_groups
from weekcast.session import ship_package

#: Classes of letters (code point modulo CLASSES) whose counts tell cells apart, and words per block
#: (64 letters of a longer word count as one word).
CLASSES = 4
BLOCK = 2048
#: Letters of all words compared at once when candidates are verified.
CHECK = 1 << 24
#: Distinct words that a counting task holds, by their total length.
HELD = 1 << 24

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans(UPPER, UPPER.lower())


def variants_of(key: str, text: str, period: int) -> Counter:
    """The words of one text: lower-cased runs, one letter deleted where ``period`` divides the hash."""
    out: Counter = Counter()
    head = zlib.crc32(key.encode() + b":")
    for run, n in Counter(_RUN.findall(text.translate(_LOWER))).items():
        h = zlib.crc32(run.encode(), head)
        if h % period == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def _count(least: int, period: int):
    """(word, n) of a task's texts, written out whenever the words held grow too long."""
    def table(held):
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                          names=["word", "n"])

    def run(batches):
        held: Counter = Counter()
        size = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in variants_of(key, text, period).items():
                    if len(word) >= least:
                        if word not in held:
                            size += len(word) + 100
                        held[word] += n
                if size > HELD:
                    yield table(held)
                    held, size = Counter(), 0
        if held:
            yield table(held)
    return run


def words(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = 5, times: int = 3,
          period: int = 97) -> DataFrame:
    """(word, n): the distinct words of at least ``letters`` letters and ``times`` occurrences."""
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(text).cast("string")).where(F.col(text).isNotNull())
    return rows.mapInArrow(_count(letters, period), "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def _moves() -> list[tuple[int, ...]]:
    """Class count changes from the first cell of a pair to the second, each unordered pair of cells
    once: none, a letter of one class for one of another, a letter more."""
    unit = np.eye(CLASSES, dtype=int)
    same = [tuple(unit[j] - unit[i]) for i in range(CLASSES) for j in range(i + 1, CLASSES)]
    return [(0,) * CLASSES, *same, *map(tuple, unit)]


def _cells(spelt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(word, n, classes, blocks), the words with their cell's class counts and number of blocks, and
    (classes, blocks) of the cells."""
    def run(batches):
        for batch in batches:
            classes = [np.bincount(np.frombuffer(w.encode("utf-32-le"), np.uint32) % CLASSES, minlength=CLASSES).tolist()
                       for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(classes, pa.list_(pa.int64()))],
                                             names=["word", "n", "classes"])
    placed = staged(spelt.mapInArrow(run, "word string, n long, classes array<long>"), "words")
    sizes = staged(placed.groupBy("classes").agg(F.expr(f"cast(ceil(sum(greatest(1, length(word) div 64)) / {BLOCK}) as bigint)").alias("blocks")), "cells")
    return placed.join(sizes, "classes"), sizes


def _dealt(spelt: DataFrame) -> DataFrame:
    """One row per word and block pair that it belongs to: (cell, move, left, right, side, word, n).

    ``cell`` hashes the first cell's class counts.  The move, checked again per pair, tells two cells
    with one hash apart.
    """
    placed, sizes = _cells(spelt)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")))
    moves = F.array(*[F.array(*[F.lit(int(x)).cast("long") for x in m]) for m in _moves()])
    add = lambda sign: F.zip_with("classes", "delta", lambda a, d: a + sign * d)
    each = placed.select("*", F.posexplode(moves).alias("move", "delta"))
    # as the first of the pair it meets every block of the cell that the move leads to, as the second
    # every block of the cell that the move comes from; inside one cell each pair of blocks once
    far = sizes.select(F.col("classes").alias("other"), F.col("blocks").alias("others"))
    first = each.withColumn("other", add(1)).join(far, "other").select(
        F.xxhash64("classes").alias("cell"), "move", F.col("block").alias("left"),
        F.explode(F.expr("sequence(0, others - 1)")).alias("right"), F.lit(0).alias("side"), "word", "n")
    second = each.withColumn("other", add(-1)).join(far, "other").select(
        F.xxhash64("other").alias("cell"), "move", F.explode(F.expr("sequence(0, others - 1)")).alias("left"),
        F.col("block").alias("right"), F.lit(1).alias("side"), "word", "n")
    own = (F.col("move") > 0) | (F.col("left") < F.col("right"))
    return first.where(own | (F.col("left") == F.col("right"))).unionByName(second.where(own)) \
        .select("cell", F.col("move").cast("long").alias("move"), F.col("left").cast("long").alias("left"),
                F.col("right").cast("long").alias("right"), "side", "word", "n")


class _Block:
    """Letters and letter counts of the words of a block that have one length."""

    def __init__(self, words: list[str]):
        size = len(words[0])
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), size)
        # a to z, then the Latin-1 letters: 90 columns
        self.code = np.where(code < 0xC0, code - 0x61, code - 0xC0 + 26).astype(np.uint8)
        exact = np.float32 if size < 1 << 11 else np.int64  # products below 2^24 are exact in floats
        m = len(words)
        self.count = np.bincount((np.arange(m)[:, None] * 90 + self.code).ravel(), minlength=m * 90).reshape(m, 90).astype(exact)
        self.norm = (self.count * self.count).sum(1)


def _near(a: _Block, b: _Block) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` exactly one edit apart; words of ``b`` are as long or one letter longer."""
    kind = np.result_type(a.count, b.count)
    distance = a.norm[:, None] + b.norm[None, :] - 2 * (a.count.astype(kind) @ b.count.astype(kind).T)
    i, j = np.nonzero(distance <= 2)
    size = a.code.shape[1]
    step = max(1, CHECK // (size + 1))
    keep = [_edit(a.code[i[k:k + step]], b.code[j[k:k + step]]) for k in range(0, len(i), step)]
    ok = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[ok], j[ok]


def _edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    size = x.shape[1]
    if y.shape[1] == size:
        return (x != y).sum(1) == 1
    ahead = np.logical_and.accumulate(x == y[:, :size], axis=1).sum(1)
    behind = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + behind >= size


def _compare(batches):
    """(word, near, best_n, best) per word of every block pair: the number of near words in the other
    block and the most frequent of them."""
    moves = _moves()
    for rows, starts in whole_groups(batches, ["cell", "move", "left", "right"]):
        ends = [*starts[1:].tolist(), rows.num_rows]
        for lo, hi in zip(starts.tolist(), ends):
            group = rows.slice(lo, hi - lo)
            side = group.column("side").to_numpy()
            word, n = group.column("word").to_pylist(), group.column("n").to_numpy()
            same = group.column("move")[0].as_py() == 0 and group.column("left")[0].as_py() == group.column("right")[0].as_py()
            if not same and side.min() == side.max():
                continue
            # places of the words by frequency, then in code-point order
            rank = np.empty(len(word), np.int64)
            rank[sorted(range(len(word)), key=lambda k: (-n[k], word[k]))] = np.arange(len(word))
            size = np.array([len(w) for w in word])
            delta = np.array(moves[group.column("move")[0].as_py()])
            first = np.flatnonzero(side == 0)
            second = first if same else np.flatnonzero(side == 1)
            near, best = np.zeros(len(word), np.int64), np.full(len(word), len(word))
            # a cell has one length; more are here only if two cells share a hash
            for length in np.unique(size[first]).tolist():
                p = first[size[first] == length]
                q = second[size[second] == length + int(delta.sum())]
                if not len(q):
                    continue
                a = _Block([word[k] for k in p])
                b = a if same else _Block([word[k] for k in q])
                i, j = _near(a, b)
                if same:
                    ok = i < j
                else:
                    turn = _classes([word[k] for k in q])[j] - _classes([word[k] for k in p])[i]
                    ok = (turn == delta).all(1)
                i, j = p[i[ok]], q[j[ok]]
                for x, y in ((i, j), (j, i)):
                    np.add.at(near, x, 1)
                    np.minimum.at(best, x, rank[y])
            by_rank = np.argsort(rank)
            hit = np.flatnonzero(near)
            to = by_rank[best[hit]]
            yield pa.RecordBatch.from_arrays([
                pa.array([word[k] for k in hit], pa.string()), pa.array(near[hit]), pa.array(n[to], pa.int64()),
                pa.array([word[k] for k in to], pa.string())], names=["word", "near", "best_n", "best"])


def _classes(words: list[str]) -> np.ndarray:
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1) % CLASSES
    return np.stack([(code == c).sum(1) for c in range(CLASSES)], 1)


def near_words(spelt: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n): per word that has any, the number of words one edit away and the
    most frequent of them, the smallest in code-point order if several are."""
    keys = ["cell", "move", "left", "right"]
    parts = _dealt(spelt).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        _compare, "word string, near long, best_n long, best string")
    return parts.groupBy("word").agg(F.sum("near").alias("n_near"),
                                     F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")) \
        .select("word", "n_near", F.col("b.best").alias("form"), (-F.col("b.less")).alias("form_n"))


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of the chain word -> form of every word that has a form.  Chains double
    their step each round; n doubles along a chain, so it has at most 63 links and six rounds end it."""
    at = staged(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = staged(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                        F.col("next").isNotNull().alias("moved")), "roots")
        done = now.where("moved").isEmpty()
        unstage(at)
        at = now.select("word", "root")
        if done:
            return at


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = 5, times: int = 3,
             ratio: int = 2, period: int = 97) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word that occurs often enough, the spelling it is a
    variant of and the end of that chain.

    A word is a run of letters with A-Z lower-cased; where ``period`` divides the checksum of key and run,
    one letter is deleted first.  Its form is its most frequent near word, if that is at least ``ratio``
    (2 or more) times as frequent as the word.  Null and empty texts have no words; a null key counts as an empty one;
    repeated rows count as often as they stand there; an empty table gives no rows.  Words of any length are
    compared whole.  Only the named columns are read, so other names cannot clash.
    """
    ship_package(docs.sparkSession)
    spelt = staged(words(docs, key, text, letters, times, period), "spelt")
    near = staged(near_words(spelt), "near")
    all_ = spelt.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        *[F.when(F.col("form_n") >= ratio * F.col("n"), F.col(c)).alias(c) for c in ("form", "form_n")])
    all_ = staged(all_, "forms")
    roots = _roots(all_.where("form is not null"))
    return all_.join(roots, "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
