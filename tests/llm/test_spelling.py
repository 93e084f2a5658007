"""Spelling variants: against a plain comparison of all words, with small blocks, and with odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from weekcast.llm import queries, spelling


def words(rows, period=97):
    out = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % period == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def plain(n):
    """Near words share a word with one letter deleted, or with one letter masked at the same place."""
    by = defaultdict(set)
    for w in n:
        by[w, None].add(w)
        for i in range(len(w)):
            by[w[:i] + w[i + 1:], None].add((w,))
            by[w[:i] + w[i + 1:], i].add(w)
    near = defaultdict(set)
    for (rest, at), found in by.items():
        if at is None:
            for (long,) in [f for f in found if isinstance(f, tuple)] if rest in n else ():
                near[rest].add(long)
                near[long].add(rest)
        else:
            for w in found:
                near[w] |= found - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else 0) for w in n)


def rows_of(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


def test_op12_equals_the_plain_comparison(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = rows_of(queries.op12_spelling_variants(spark, SF_SMALL))
    assert got == plain(words(docs)) and any(g[1] for g in got)


@pytest.mark.parametrize("block", [3, 2048])
def test_random_words_in_small_blocks(spark, monkeypatch, block):
    """Few letters, so that most words have near words and cells are cut; ties and chains of forms."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abéÿ÷", k=rng.randint(4, 6))) for _ in range(500)]
    times = {w: rng.choice([1, 2, 5, 12, 30]) for w in vocabulary}
    docs = [(i, "-".join(w for w in rng.choices(vocabulary, k=60) for _ in range(times[w]))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = rows_of(spelling.variants(df))
    assert got == plain(words(docs))
    assert len({g[2] for g in got}) < len(got) and any(g[2] != g[1] and g[1] for g in got)


def test_edit_check_is_exact():
    rng = random.Random(8)
    for _ in range(3000):
        x = "".join(rng.choices("ab", k=rng.randint(1, 6)))
        y = "".join(rng.choices("ab", k=len(x) + rng.randint(0, 1)))
        one = any(x[:i] + x[i + 1:] == y[:i] + y[i + 1:] for i in range(len(x))) and x != y if len(x) == len(y) \
            else any(y[:i] + y[i + 1:] == x for i in range(len(y)))
        code = lambda w: np.frombuffer(w.encode(), np.uint8)[None]
        assert spelling._edit(code(x), code(y))[0] == one, (x, y)


def test_odd_rows(spark):
    """Null, empty and very long texts, words of 3,000 letters, null and repeated keys, clashing names, no rows."""
    long = "ab" * 1500
    docs = [(1, None), (1, ""), (None, "hello hello"), (None, "hello hello"), (2, "HELLO hallo hallo hallo ÀÉÎÕÜ ÀÉÎÕÜ ÀÉÎÕÜ àéîõü"),
            (3, f"{long} {long} {long}"), (4, " ".join([long + "c"] * 9)), (5, "other word " * 100_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string") \
        .withColumns({c: F.lit("x") for c in ("word", "n", "classes", "block", "cell", "form", "root", "n_near")})
    got = rows_of(spelling.variants(df))
    assert got == plain(words(docs))
    assert (long, long + "c", long + "c", 3, 1, 9) in got
    assert spelling.variants(df.limit(0)).count() == 0
    assert spelling.variants(df.where("doc_id = 1")).count() == 0
