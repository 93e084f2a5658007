"""PPM scores against a plain implementation."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from weekcast.llm import ppm, queries


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, nodes=ppm.NODES):
    """Trie of dictionaries, escape method C with exclusion; add-one unigrams."""
    train = [t or "" for d, t in rows if zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2]
    trie = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    size = 0
    for t in train:
        raw = b"\xff" * ppm.ORDER + t.encode() + b"\xff"
        for i in range(ppm.ORDER, len(raw)):
            size += 1
            for k in range(ppm.ORDER + 1):
                trie[k][raw[i - k:i]][raw[i]] += 1
    trie = [{c: {b: n for b, n in f.items() if n * nodes >= size} for c, f in t.items()} for t in trie]

    def occurs(ctx):
        return size if not ctx else trie[len(ctx) - 1].get(ctx[:-1], {}).get(ctx[-1], 0)
    words = Counter(w for t in train for w in re.findall(r"[^\x20\x09-\x0D]+", low(t)))
    tokens, distinct = sum(words.values()) + len(train), len(words) + (len(train) > 0)

    def byte(ctx, b):
        p, skip = 0.0, set()
        for k in range(ppm.ORDER, -1, -1):
            nodes_ = trie[k].get(ctx[len(ctx) - k:], {})
            if not nodes_:
                continue
            follow = {x: n for x, n in nodes_.items() if x not in skip}
            lost = max(occurs(ctx[len(ctx) - k:]) - sum(nodes_.values()), 0)
            total = sum(follow.values()) + lost + len(follow)
            if b in follow:
                return p + math.log10(follow[b] / total)
            p += math.log10((lost + len(follow)) / total) if total else 0.0
            skip |= set(follow)
        return p - math.log10(256 - len(skip))
    out = []
    for d, t in rows:
        raw = b"\xff" * ppm.ORDER + (t or "").encode() + b"\xff"
        s = sum(byte(raw[i - ppm.ORDER:i], raw[i]) for i in range(ppm.ORDER, len(raw)))
        own = [words[w] for w in re.findall(r"[^\x20\x09-\x0D]+", low(t))] + [len(train)]
        base = sum(math.log10((c + 1) / (tokens + distinct + 1)) for c in own)
        out.append((d, len(own), sum(c > 0 for c in own), tokens, base, s))
    return out


@pytest.mark.parametrize("nodes, words", [(1 << 20, 1 << 20), (300, 20)])
def test_matches_plain_model(spark, monkeypatch, nodes, words):
    monkeypatch.setattr(ppm, "CHUNK", 300)
    base = ["the cat sat on the mat", "The Cat\tsat  on", "", None, "ñandú É é\x0bx", "a\x00b 日本語", "z" * 700,
            "the the the the " * 60, "　 x\x1cy"]
    rows = [(i, t) for i, t in enumerate(base * 3)] + [(2, "held twice"), (2, "held twice"), (None, "the mat")]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, row string, n int").repartition(3)
    got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
           for r in ppm.score(df, nodes=nodes, words=words).collect()]
    want = brute(rows, nodes)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], round(r[5], 6))
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=order), sorted(want, key=order)):
        assert g[:4] == w[:4]
        assert g[4:] == pytest.approx(w[4:], abs=1e-6)


def test_rare_contexts_stay_in_the_model(spark):
    # more than NODES bytes of training text: contexts met once or twice are below the broadcast share
    held_in = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 != 2]
    held_out = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = [(held_in[0], "abc " * 800_000), (held_in[1], "a rare quixotic phrase"), (held_in[2], "ñandú quixote"),
            (held_out[0], "the quixotic phrases, rarely"), (held_out[1], "ñandus ab c"), (held_out[2], None)]
    got = {r["doc_id"]: r["score"] for r in ppm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, _, _, _, _, s in brute(rows, nodes=1 << 60):
        assert got[d] == pytest.approx(s, rel=1e-9, abs=1e-6)


def test_byte_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, "abracadabra " * (i % 4 + 1)) for i in range(40)], "doc_id long, text string")
    model = ppm.fit(ppm.counted(docs), nodes=40).build()
    for ctx in (b"dabra", b"zzzzz", b"zzzra", b"\xff" * 5, b"zzzz "):
        grams = np.array([int.from_bytes(ctx + bytes([b]), "big") for b in range(256)], np.uint64)
        assert (10 ** model.log10(grams)).sum() == pytest.approx(1)


def test_op8_matches_plain_model(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in queries.op8_ppm_scores(spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for d, n, known, tokens, base, s in brute(rows):
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, tokens)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(s)
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 7 == 2)


def test_empty_table_and_no_training_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ppm.score(df).count() == 0
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    got = ppm.score(df.union(spark.createDataFrame([(i, "ab") for i in held], "doc_id long, text string"))).collect()
    for r in got:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (2, 0, 0, 0.0)
        assert r["score"] == pytest.approx(-3 * math.log10(256))


def test_clashing_names_and_packing(spark):
    df = spark.createDataFrame([(i, "the cat sat " * (i + 1)) for i in range(6)], "doc_id long, text string")
    plain = {r["doc_id"]: r["score"] for r in ppm.score(df).collect()}
    for c in ("kind", "slot", "part", "row", "blob", "key", "n_words", "known", "logs", "score", "code", "n", "n_tokens", "held_out"):
        df = df.withColumn(c, df["doc_id"] * 0)
    assert {r["doc_id"]: r["score"] for r in ppm.score(df).collect()} == pytest.approx(plain)
    rng = np.random.default_rng(1)
    code = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) >> rng.integers(0, 60, 5000).astype(np.uint64))
    n = rng.integers(1, 1 << 40, len(code))
    back = ppm.unpack(ppm.pack(code, n))
    assert (back[0] == code).all() and (back[1] == n).all()
    open_, row = np.repeat(code, 3), np.tile([4, 4, 9], len(code))
    codes, which, rows, times = ppm.unpack_open(ppm.pack_open(open_, row))
    assert (codes == code).all() and (which == np.repeat(np.arange(len(code)), 2)).all()
    assert (rows == np.tile([4, 9], len(code))).all() and (times == np.tile([2, 1], len(code))).all()
