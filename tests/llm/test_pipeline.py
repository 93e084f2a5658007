"""The pipeline against a brute-force version of its stages."""

import math
import re
from collections import defaultdict

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tests.llm.test_simhash import brute_components, brute_fp, low_words
from tests.llm.test_tokens import BYTE_BPE, brute_files

pipeline = pytest.importorskip("corpus_pipeline")
from weekcast.llm import mixing, pieces, quality, simhash  # noqa: E402


def brute_contaminated(text, windows):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low_words(text))
    return any(tuple(words[i:i + n]) in windows for n in {len(w) for w in windows} for i in range(len(words) - n + 1))


def brute_windows(items):
    out = set()
    for t in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low_words(t))
        out |= {tuple(w[i:i + 10]) for i in range(max(len(w) - 9, 1))} if w else set()
    return out


def brute_mix(rows):
    """(doc, text) as often as taken: targets by water filling, documents in the order of their keys."""
    import hashlib
    by = defaultdict(list)
    for d, t, s in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        u = (int(hashlib.md5(f"7:{d}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        clean = sum(c not in mixing.SYMBOLS for c in t) / len(t) if t else 1.0
        by[s].append((-math.log(u) / max(clean**2, 0.05), d, n, t))
    names = sorted((s for s in by if s is not None)) + [None] * (None in by)
    size = {s: sum(x[2] for x in by[s]) for s in names}
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, open_ = {}, sum(size.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * size[s] < level * weight[s]}
        for s in full or open_:
            target[s] = 3 * size[s] if full else level * weight[s]
        left -= sum(target[s] for s in full)
        open_ -= full or open_
    out = []
    for s in names:
        epochs = min(3, int(target[s] // size[s])) if size[s] else 0
        rest, at = target[s] - epochs * size[s], 0
        for _, d, n, t in sorted(by[s], key=lambda x: x[:3]):
            out += [(d, t)] * (epochs + (rest > 0 and at + n / 2 <= rest))
            at += n
    return out


def test_run_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    trees = quality.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    ok = trees.score(np.array([quality.statistics(t) for _, t, _ in rows])) >= quality.CUT
    rows = [r for r, good in zip(rows, ok) if good]
    comp = brute_components([r[0] for r in rows], [brute_fp(r[1]) for r in rows], 4)
    rows = [r for r, c in zip(rows, comp) if r[0] == c]
    windows = brute_windows(r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect())
    rows = [r for r in rows if not brute_contaminated(r[1], windows)]
    want = brute_files(brute_mix(rows), pieces.encoder(BYTE_BPE).tokenizer)
    got = sorted(map(tuple, pipeline.run(spark, SF_SMALL).collect()), key=lambda r: r[1])
    assert got == want and len({r[0] for r in got}) > 20


def test_stages_keep_the_columns_and_survive_odd_rows(spark):
    rows = [(1, "the words of a text", "en", "a", 5), (1, "the words of a text", "en", "a", 5), (None, None, None, None, None),
            (2, "", "en", "b", 0), (3, "x " * 20000, None, "a", 9), (1, "another text of that id", "en", None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.limit(0)):
        for name, stage in pipeline.STAGES[:-1]:
            got = stage(spark, some, SF_SMALL)
            assert got.columns == docs.columns, name
            assert got.count() <= 3 * len(rows)
        assert pipeline.STAGES[-1][1](spark, some, SF_SMALL).count() == some.count()


def test_one_row_of_each_group_stays(spark):
    rows = [(5, "a b c d e", "x"), (3, "a b c d e", "y"), (3, "a b c d e", "z"), (None, "a b c d e", "n"), (9, "other text here", "o"),
            (9, "other text here", "o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, th string")
    got = sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(docs).collect())
    assert got == [(3, "a b c d e"), (9, "other text here")]
