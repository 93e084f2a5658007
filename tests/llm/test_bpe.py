"""Byte-level BPE: ids against the library and a plain merge loop, round trips, very long texts, odd rows."""

import base64
import hashlib
import random

import public_tokenizers
import regex
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from weekcast.llm import bpe, queries

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table():
    with open(RANKS, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


def plain(ranks, text):
    """Each match of the pattern: the pair of least rank is merged, the leftmost first, until none is left."""
    out = []
    for m in regex.finditer(public_tokenizers.PATTERN, text):
        p = [bytes([b]) for b in m.group().encode()]
        while len(p) > 1:
            best, i = min((ranks.get(p[i] + p[i + 1], 1 << 60), i) for i in range(len(p) - 1))
            if best == 1 << 60:
                break
            p[i:i + 2] = [p[i] + p[i + 1]]
        out += [ranks[x] for x in p]
    return out


def test_op13_equals_a_plain_merge_loop(spark):
    ranks = table()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op13_byte_bpe(spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        ids = plain(ranks, docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_cutting_changes_nothing(monkeypatch):
    """Small limits, so that short random texts are cut; against the library on the whole text."""
    monkeypatch.setattr(bpe, "PART", 7)
    monkeypatch.setattr(bpe, "RUN", 3)
    monkeypatch.setattr(bpe, "_RUN", regex.compile(r"\s{3,}"))
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(3)
    bits = ["a", "word", " ", "  ", "    ", "\n", "\t", "\x85", "\xa0", " ", "\x1c", "᠎", "'s", "'", "'ll", "7", "²", ".", "!?",
            "é", "é", "日本", "🙂", "‍", "<|endoftext|>", "\x00", "İ", "ß"]
    for _ in range(8000):
        t = "".join(rng.choices(bits, k=rng.randint(0, 25)))
        assert "".join(p for p, _ in bpe.parts(t)) == t
        assert bpe.encode_text(enc, t).tolist() == enc.encode_ordinary(t), repr(t)


def test_very_long_texts(spark):
    """Runs that the library's expression engine cannot take, long words, and a text of some MB."""
    enc = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    texts = [" " * 1_500_000, " " * 1_500_000 + "x", "a" + "\n" * 1_200_000 + "b c", "a" * 300_000, "日本" * 100_000,
             "some words, " * 250_000, "x " * 5000 + " " * 70_000 + "'s y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = bpe.decode(bpe.encode(df, RANKS), RANKS).collect()
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in rows} == dict(enumerate(texts))
    ids = {r["doc_id"]: r["ids"] for r in rows}
    assert ids[1] == enc._encode_single_piece(" " * 1_499_999) + enc.encode_ordinary(" x")
    for i in (3, 4, 5, 6):
        assert ids[i] == enc.encode_ordinary(texts[i])


def test_odd_rows(spark):
    """Null and empty texts, null and repeated keys, other columns of the same names, an empty table."""
    rows = [(1, None, "x"), (1, None, "x"), (None, "", "y"), (2, "<|endoftext|>", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string") \
        .withColumns({c: F.lit(0) for c in ("key", "bytes", "n_tokens")})
    got = bpe.decode(bpe.encode(df, RANKS), RANKS)
    assert got.columns == ["doc_id", "ids", "bytes"]
    assert sorted((r["doc_id"] or 0, len(r["ids"]), bytes(r["bytes"])) for r in got.collect())[:3] == [(0, 0, b"")] + [(1, 0, b"")] * 2
    assert bpe.encode(df.limit(0), RANKS).count() == 0
    assert bpe.decode(df.select("doc_id", F.lit(None).cast("array<int>").alias("ids")).limit(1), RANKS).first()["bytes"] == b""
