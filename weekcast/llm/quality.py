"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed where the texts are.  Trees are grown on the driver from a bounded sample of
labelled rows' statistics and flattened into arrays; scoring walks all rows of a batch down every
tree at once in numpy.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekcast.llm.common import sliced, staged
from weekcast.session import ship_package

#: Labelled rows that the trees are grown on, at most: those with the smallest hashes of their ids.
#: About 40 statistics of 8 bytes each, so the driver receives 7 MB.
TRAIN_ROWS = 20_000
CUT = 0.3

_END = (".", "!", "?", ":", ";", '"', "”", "…")
_MARKS = "!?#$%&*|<>{}[]\\^_=+~@/"
FEATURES = (["log_words", "word_len", "word_len_sd", "long_words", "short_words", "distinct", "top_word", "top3_words",
             "repeat_next", "repeat_two_on", "distinct_pairs", "upper_words", "title_words", "marked_words", "digit_words",
             "bare_marks", "lines", "line_words", "line_words_sd", "same_lines", "ended_lines", "sentences",
             "sentence_words", "upper", "digit", "space", "newline", "other_ascii", "high", "byte_entropy"]
            + [f"mark_{m}" for m in range(len(_MARKS))])
_BYTES = np.arange(256)
_GROUPS = {"upper": (_BYTES >= 65) & (_BYTES <= 90), "digit": (_BYTES >= 48) & (_BYTES <= 57), "space": _BYTES == 32,
           "newline": _BYTES == 10, "high": _BYTES >= 128}
_GROUPS["other_ascii"] = (_BYTES < 128) & ~((_BYTES >= 97) & (_BYTES <= 122)) & ~_GROUPS["upper"] & ~_GROUPS["digit"] \
    & ~_GROUPS["space"]
_STOPS = re.compile(r"[.!?]+(?:\s|$)")


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of FEATURES; empty texts give zeros."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = np.fromiter(map(len, words), np.float64, n)
    count = Counter(words)
    top = [c for _, c in count.most_common(3)]
    code = {w: i for i, w in enumerate(count)}
    seq = np.fromiter(map(code.__getitem__, words), np.int64, n)
    pairs = len(np.unique(seq[:-1] * len(code) + seq[1:])) if n > 1 else 1
    upper = title = marked = digit = bare = 0
    for w, c in count.items():                      # once per distinct word
        if w.isupper() and len(w) > 1:
            upper += c
        elif w[0].isupper():
            title += c
        if w.isalpha():
            continue
        if not any(map(str.isalnum, w)):
            bare += c
        elif w[-1] in _MARKS or w[0] in _MARKS:
            marked += c
        if any(map(str.isdigit, w)):
            digit += c
    lines = [x for x in text.split("\n") if x.strip()]
    per_line = np.array([len(x.split()) for x in lines], np.float64)
    stops = len(_STOPS.findall(text))
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    total = raw.sum()
    p = raw[raw > 0] / total
    marks = [raw[ord(m)] / total for m in _MARKS]
    return [np.log1p(n), size.mean(), size.std(), (size > 12).mean(), (size < 3).mean(), len(count) / n, top[0] / n,
            sum(top) / n, (seq[1:] == seq[:-1]).mean() if n > 1 else 0.0, (seq[2:] == seq[:-2]).mean() if n > 2 else 0.0,
            pairs / max(n - 1, 1), upper / n, title / n, marked / n, digit / n, bare / n, np.log1p(len(lines)),
            per_line.mean(), per_line.std(), 1 - len(set(lines)) / len(lines),
            sum(x.rstrip().endswith(_END) for x in lines) / len(lines), stops / n, n / (stops + 1),
            *[raw[_GROUPS[g]].sum() / total for g in ("upper", "digit", "space", "newline", "other_ascii", "high")],
            float(-(p * np.log2(p)).sum()), *marks]


@dataclass
class Trees:
    """Flat trees: node i of all trees goes to ``left[i]`` if x[feature[i]] <= cut[i], else to
    ``right[i]``; leaves point at themselves."""
    base: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
            out += self.value[at]
        return 1 / (1 + np.exp(-out))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.12, bins: int = 64,
         smooth: float = 1.0, least: float = 4.0) -> Trees:
    """Boosted trees for 0/1 labels: logistic loss, Newton gains from histograms of each level."""
    n, width = x.shape
    prior = (y.sum() + 1) / (n + 2)
    feature, cut, left, right, value, roots = [], [], [], [], [], []
    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
        code = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        raw = np.full(n, np.log(prior / (1 - prior)))
        flat = code + np.arange(width) * bins
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            g, h = p - y, p * (1 - p)
            roots.append(len(feature))
            spot = np.zeros(n, np.int64)               # node of each row on this level
            nodes = [len(feature)]
            _leaf(feature, cut, left, right, value, -g.sum() / (h.sum() + smooth) * rate)
            for _ in range(depth):
                k = len(nodes)
                cell = (flat + (spot * width * bins)[:, None]).ravel()
                live = np.repeat(spot >= 0, width)
                gs = np.bincount(cell[live], np.repeat(g, width)[live], k * width * bins).reshape(k, width, bins)
                hs = np.bincount(cell[live], np.repeat(h, width)[live], k * width * bins).reshape(k, width, bins)
                gl, hl = gs.cumsum(2), hs.cumsum(2)
                gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
                gain = gl**2 / (hl + smooth) + (gt - gl)**2 / (ht - hl + smooth) - gt**2 / (ht + smooth)
                gain[(hl < least) | (ht - hl < least)] = 0
                for f, e in enumerate(edges):
                    gain[:, f, len(e):] = 0
                best = gain.reshape(k, -1).argmax(1)
                new, after = [], np.full(n, -1)
                for i, node in enumerate(nodes):
                    f, b = divmod(int(best[i]), bins)
                    if gain[i, f, b] <= 1e-6:
                        continue
                    feature[node], cut[node] = f, float(edges[f][b])
                    sides = []
                    for gi, hi in ((gl[i, f, b], hl[i, f, b]), (gt[i, 0, 0] - gl[i, f, b], ht[i, 0, 0] - hl[i, f, b])):
                        sides.append(len(feature))
                        _leaf(feature, cut, left, right, value, -gi / (hi + smooth) * rate)
                    left[node], right[node] = sides
                    here = spot == i
                    go = code[:, f] <= b
                    after[here & go], after[here & ~go] = len(new), len(new) + 1
                    new += sides
                if not new:
                    break
                spot, nodes = after, new
            tree = Trees(0.0, np.array(roots[-1:]), *map(np.array, (feature, cut, left, right, value)), depth)
            s = tree.score(x)
            raw += np.log(s / (1 - s))
    return Trees(float(np.log(prior / (1 - prior))), np.array(roots, np.int64), np.array(feature, np.int64),
                 np.array(cut), np.array(left, np.int64), np.array(right, np.int64), np.array(value), depth)


def _leaf(feature, cut, left, right, value, v):
    at = len(feature)
    for column, x in ((feature, 0), (cut, 0.0), (left, at), (right, at), (value, float(v))):
        column.append(x)


def _describe(batches):
    for batch in batches:
        for few in sliced(batch):
            x = pa.array([statistics(t) for t in few.column(1).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([few.column(0), x], names=["key", "x"])


def described(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, x): the statistics of every row's whole text."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")) \
        .mapInArrow(_describe, "key long, x array<double>")


def sampled_labels(labels: DataFrame, keep: Column, rows: int = TRAIN_ROWS, key: str = "doc_id",
                   label: str = "quality") -> DataFrame:
    """(key, y): at most ``rows`` labelled ids, by smallest hash.  Null ids and labels are left out; an
    id with several labels has the lowest."""
    own = labels.select(F.col(key).cast("long").alias("key"), F.col(label).cast("double").alias("y")) \
        .where("key is not null and y is not null").where(keep).groupBy("key").agg(F.min("y").alias("y"))
    return own.orderBy(F.xxhash64("key"), "key").limit(rows)


def fit(stats: DataFrame, sample: DataFrame) -> Trees:
    """Trees for the sampled labels; ``stats`` has (key, x).  Ids without a document are ignored, and
    of rows that repeat an id one is used.  Without both labels the score is the smoothed prior."""
    # TRAIN_ROWS rows of 16 bytes: a proven bound
    got = stats.join(F.broadcast(sample), "key").groupBy("key").agg(F.max(F.struct("x", "y")).alias("r")) \
        .orderBy("key").select("r.x", "r.y").toArrow()
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return grow(x, (got.column("y").to_numpy() > 0).astype(np.float64))


def scored(stats: DataFrame, trees: Trees) -> DataFrame:
    """(key, score) for every row of the statistics."""
    ship_package(stats.sparkSession)
    model = stats.sparkSession.sparkContext.broadcast(trees)  # a few thousand numbers

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.value.score(x))], names=["key", "score"])
    return stats.select("key", "x").mapInArrow(run, "key long, score double")


def held_out(key: str = "doc_id", parts: int = 5) -> Column:
    """Rows that are never learned from: crc32 of the id as text divides by ``parts``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts == 0


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          rows: int = TRAIN_ROWS) -> Trees:
    """Trees learned from the labelled documents outside the held-out fifth; only the sampled
    documents are described."""
    sample = staged(sampled_labels(labels, ~held_out("key"), rows, key, label), "labels")
    few = docs.select(F.col(key).cast("long").alias(key), text) \
        .join(F.broadcast(sample.select(F.col("key").alias(key))), key)
    return fit(described(few, key, text), sample)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
             rows: int = TRAIN_ROWS) -> DataFrame:
    """(key, held_out, score, predicted) for every row.  Null and empty texts are scored from zeros;
    an empty table gives no rows; repeated rows get equal scores."""
    stats = staged(described(docs, key, text), "statistics")
    sample = staged(sampled_labels(labels, ~held_out("key"), rows, key, label), "labels")
    got = scored(stats, fit(stats, sample))
    return got.select(F.col("key").alias(key), held_out("key").alias("held_out"), "score",
                      (F.col("score") >= CUT).cast("int").alias("predicted"))


def _accepted(batches, at: int, trees: Trees, cut: float):
    """The accepted rows, scored a batch at once; texts and results are held a slice at a time."""
    for batch in batches:
        x, lo = np.empty((batch.num_rows, len(FEATURES))), 0
        for few in sliced(batch):
            x[lo:lo + few.num_rows] = [statistics(t) for t in few.column(at).to_pylist()]
            lo += few.num_rows
        good, lo = trees.score(x) >= cut, 0
        for few in sliced(batch):
            yield few.filter(pa.array(good[lo:lo + few.num_rows]))
            lo += few.num_rows


def keep_good(docs: DataFrame, trees: Trees, text: str = "text", cut: float = CUT) -> DataFrame:
    """The rows that the trees accept, columns as given: each batch is scored beside its texts, so
    nothing is joined or shuffled."""
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(trees)
    at = docs.columns.index(text)

    def run(batches):
        yield from _accepted(batches, at, model.value, cut)
    return docs.mapInArrow(run, docs.schema)
