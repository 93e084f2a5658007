"""Line deduplication by pairwise alignment.

Two documents are a pair if the alignment could delete something: every two that share a rare line;
and, for frequent lines, a document with the earliest holder of each of its runs of neighbouring lines
that just make a passage, and with the earliest holder of all its lines in a row if it is short.  Every
passage is covered by such runs (one from its first line on, one up to each later line), so nothing
hangs on who holds a single line first.  Each pair is aligned by patience diff: equal ends are taken,
lines that occur once on both sides are anchors, their longest increasing run is kept, and the gaps
between anchors are aligned in the same way; where no line is unique, the k-th occurrence of a line meets
the k-th.  A block is deleted from the later document if one of its lines is rare in the corpus; blocks
of frequent lines alone are deleted when they are a passage or the whole document.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.llm.common import staged, words
from weekcast.session import ship_package

#: A line in at most this many documents is rare.
RARE = 8
#: Words from which on a block of frequent lines is a repeated passage.
PASSAGE = 50


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, th, pos, h, n_words): the lines of each distinct (key, text) that hold a word; ``h``
    hashes the line without the white space around it."""
    # hashed and split before the lines are dealt out: once a text, not once a line
    src = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("th"), F.split(text, "\n").alias("l")) \
        .select("key", "th", F.posexplode("l").alias("pos", "line"))
    line = F.regexp_replace("line", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return src.withColumn("line", line).where("line <> ''") \
        .select("key", "th", "pos", F.xxhash64("line").alias("h"), F.size(words(F.col("line"))).alias("n_words"))


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of (pos, other) that increases on both sides; ``pairs`` is sorted by pos."""
    tails, ends, back = [], [], [-1] * len(pairs)
    for i, (_, q) in enumerate(pairs):
        k = bisect_left(tails, q)
        back[i] = ends[k - 1] if k else -1
        if k == len(tails):
            tails.append(q)
            ends.append(i)
        else:
            tails[k], ends[k] = q, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def match(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j), a[i] == b[j], increasing on both sides: patience diff with its recursion."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        left, right = defaultdict(list), defaultdict(list)
        for x in range(i, m):
            left[a[x]].append(x)
        for y in range(j, n):
            right[b[y]].append(y)
        anchors = [(x[0], right[h][0]) for h, x in left.items() if len(x) == 1 and len(right.get(h, ())) == 1]
        if not anchors:
            anchors = [pair for h, x in left.items() for pair in zip(x, right.get(h, ()))]
        anchors = _increasing(sorted(anchors))
        out += anchors
        if anchors:
            todo += [(x + 1, x2, y + 1, y2) for (x, y), (x2, y2) in zip([(i - 1, j - 1), *anchors], [*anchors, (m, n)])]
    return sorted(out)


def _runs(rare: int, passage: int):
    """(run, key, th, ask): hashes of the runs of frequent lines of a document.  With ``ask``: the runs
    that just make a passage, and all lines of a shorter document; without: what shorter ones may equal."""
    def of(doc, n):
        asked, offered = set(), set()
        at = 0
        while at < len(doc):
            stop = at
            while stop < len(doc) and doc[stop]["df"] > rare and doc[stop]["rank"] - doc[at]["rank"] == stop - at:
                stop += 1
            h, size = [s["h"] for s in doc[at:stop]], [s["n_words"] for s in doc[at:stop]]
            for i in range(len(h)):
                for step in (1, -1):
                    j, held = i, 0
                    while 0 <= j < len(h):
                        held += size[j]
                        lo, hi = min(i, j), max(i, j) + 1
                        if held >= passage:
                            asked.add(hash(tuple(h[lo:hi])))
                            break
                        if step > 0:
                            (asked if hi - lo == n else offered).add(hash(tuple(h[lo:hi])))
                        j += step
            at = max(stop, at + 1)
        return asked, offered - asked

    def run(batches):
        for batch in batches:
            rows = []
            for key, th, n, doc in zip(*(batch.column(c).to_pylist() for c in range(4))):
                asked, offered = of(doc, n)
                rows += [(r, key, th, True) for r in asked] + [(r, key, th, False) for r in offered]
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.bool_())],
                                                 names=["run", "key", "th", "ask"])
    return run


def _align_pairs(rare: int, passage: int):
    """(key, th, gone): lines of the later document deleted for one pair."""
    def run(batches):
        for batch in batches:
            lists = {name: (c.offsets.to_numpy(), c.values.to_numpy()) for name, c in
                     zip(batch.schema.names, batch.columns) if pa.types.is_list(c.type)}
            out = []
            for row, n in enumerate(batch.column("n").to_pylist()):
                rank, pos, h, size, df, other_rank, other_h = (v[o[row]:o[row + 1]] for o, v in (
                    lists[c] for c in ("rank", "pos", "h", "n_words", "df", "other_rank", "other_h")))
                both = np.intersect1d(h, other_h)
                own, other = np.flatnonzero(np.isin(h, both)), np.flatnonzero(np.isin(other_h, both))
                gone, block, last = [], [], None
                for i, j in [*match(h[own].tolist(), other_h[other].tolist()), (None, None)]:
                    here = None if i is None else (rank[own[i]], other_rank[other[j]])
                    if block and (here is None or here != (last[0] + 1, last[1] + 1)):
                        if (df[block] <= rare).any() or size[block].sum() >= passage or len(block) == n:
                            gone += pos[block].tolist()
                        block = []
                    if here is not None:
                        block.append(own[i])
                    last = here
                out.append(gone)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("th"), pa.array(out, pa.list_(pa.int32()))],
                                             names=["key", "th", "gone"])
    return run


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", rare: int = RARE,
                   passage: int = PASSAGE) -> DataFrame:
    """(key, th, gone): for each document that repeats earlier ones, the numbers of its lines (from 0)
    that lie in deleted blocks.  Earlier means a smaller key; null keys come first."""
    ship_package(docs.sparkSession)
    low = -(1 << 63)
    own = lines(docs, key, text).withColumn("key", F.coalesce("key", F.lit(low)))
    # identical rows are one document; a document's lines are bounded by its own text
    per_doc = own.groupBy("key", "th").agg(F.array_sort(F.collect_set(F.struct("pos", "h", "n_words"))).alias("l"))
    ranked = staged(per_doc.select("key", "th", F.size("l").alias("n"), F.posexplode("l").alias("rank", "l"))
                    .select("key", "th", "n", "rank", "l.*"), "lines")
    # written out: the join below then has plain exchanges, and a line of a third of all documents is split
    held = staged(ranked.select("key", "th", "h").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("df"))
                  .where("df > 1"), "shared-lines")
    shared = staged(ranked.join(held, "h").groupBy("key", "th")
                    .agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("rank", "pos", "h", "n_words", "df"))).alias("l")),
                    "shared")
    runs = staged(shared.select("key", "th", "n", "l").mapInArrow(_runs(rare, passage), "run long, key long, th long, ask boolean"), "runs")
    # written out as well: a run that a third of all documents hold is split by the join
    first = staged(runs.groupBy("run").agg(F.min(F.struct("key", "th")).alias("first")), "first-holders")
    doc = F.struct("key", "th")
    by_run = runs.where("ask").join(first, "run").where(F.col("first") < doc).select("key", "th", F.col("first").alias("other"))
    # at most ``rare`` holders of a line
    holders = shared.select("key", "th", F.explode("l").alias("l")).where(F.col("l.df") <= rare) \
        .groupBy("l.h").agg(F.collect_set(doc).alias("d"))
    by_line = holders.select("d", F.explode("d").alias("later")) \
        .select("later.*", F.explode(F.filter("d", lambda x: x < F.col("later"))).alias("other"))
    pairs = by_run.unionByName(by_line).select("key", "th", F.col("other.key").alias("other_key"), F.col("other.th").alias("other_th")).distinct()
    others = shared.select(F.col("key").alias("other_key"), F.col("th").alias("other_th"),
                           F.col("l.rank").alias("other_rank"), F.col("l.h").alias("other_h"))
    both = pairs.join(shared.select("key", "th", "n", *[F.col(f"l.{c}").alias(c) for c in ("rank", "pos", "h", "n_words", "df")]), ["key", "th"]).join(others, ["other_key", "other_th"])
    return both.drop("other_key", "other_th").mapInArrow(_align_pairs(rare, passage), "key long, th long, gone array<int>") \
        .where(F.size("gone") > 0).groupBy("key", "th") \
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def _between(x, i):
    """The lines of ``x`` after its deleted line number i (from 1; 0: the start) and before the next one."""
    start = F.when(i == 0, 0).otherwise(F.get(x["gone"], i - 1) + 1)
    end = F.coalesce(F.get(x["gone"], i), F.size(x["lines"]))
    return F.slice(x["lines"], start + 1, end - start)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", rare: int = RARE, passage: int = PASSAGE) -> DataFrame:
    """The rows of ``docs`` with repeated blocks deleted from the texts, and two more columns:
    ``_n_lines`` (lines that hold a word) and ``_n_removed``.

    Null texts stay null, texts without repeated lines stay byte for byte, a text that is repeated
    whole keeps only its blank lines.  Rows with equal key and text are one document and get equal
    results; rows with equal key and other texts are ordered by a hash of the text.  An empty table
    stays empty.  Columns of ``docs`` that have the names of the two new ones are replaced by them.
    """
    gone = staged(repeated_lines(docs, key, text, rare, passage), "gone")
    k, t = F.coalesce(docs[key].cast("long"), F.lit(-(1 << 63))), docs[text]
    # the deletions grow with the documents: a merge join at every size, which AQE may split
    got = docs.join(gone.hint("merge"), (k == gone["key"]) & (F.xxhash64(t) == gone["th"]), "left")
    split = F.split(t, "\n")
    # the stretches between deleted lines; the lines are split once, a text costs no more than its length
    part = F.array(F.struct(split.alias("lines"), gone["gone"].alias("gone")))
    kept = F.flatten(F.transform(part, lambda x: F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(x["gone"])), lambda i: _between(x, i)))))
    text_out = F.when(gone["gone"].isNull(), t).otherwise(F.array_join(kept, "\n"))
    n = F.coalesce(F.size(F.filter(split, lambda line: line.rlike(r"[^\x20\x09-\x0D]"))), F.lit(0))
    return got.select(*[text_out.alias(c) if c == text else docs[c] for c in docs.columns if c not in ("_n_lines", "_n_removed")],
                      F.when(t.isNull(), 0).otherwise(n).cast("long").alias("_n_lines"),
                      F.coalesce(F.size(gone["gone"]), F.lit(0)).cast("long").alias("_n_removed"))
