"""Token counts and token files against the tokenizer libraries."""

import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from weekcast.llm import pieces, queries, tokencount, wavelet  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402

BYTE_BPE, PIECE_BPE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "a ", "\n\n a", "don't we'll 'tis 's 'S '' ''s !'s a'sb", "<|endoftext|> x<|endoftext|>", "</s><s>",
       "日本語 テスト123", "a\x00b", "ab 'lx 'l '", "▁▁a▁", "é́ñ ²½ Ⅷ 🙂🙂", " " * 70 + "the", "x" * 3000, "ab" * 2000]


def noise(alphabet, n, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(1, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def sp():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


def test_transducer_counts_like_the_library(sp):
    texts = ODD + noise([*"     \n\tabcdethe ing19.,é日ﬁ'▁ß", "tion", "the"], 1500, 60, 1) + noise("abcdefgh", 4, 5000, 2)
    assert tokencount.Transducer(PIECE_BPE).counts(texts).tolist() == [len(x) for x in sp.encode(texts)]


def test_full_table_is_compiled_anew(sp, monkeypatch):
    monkeypatch.setattr(tokencount, "CELLS", 64 * 400)
    texts = ODD + noise([*"  abcdeé日", "tion", "the"], 200, 80, 3)
    assert tokencount.Transducer(PIECE_BPE).counts(texts).tolist() == [len(x) for x in sp.encode(texts)]


def test_op3_counts_every_row(spark, sp):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op3_token_counts(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        n = len(sp.encode(docs[r["doc_id"]]))
        assert (r["n_tokens"], r["n_bytes"]) == (n, len(docs[r["doc_id"]].encode()))
        assert r["over_limit"] == (n > 4096)


def test_token_counts_edge_rows(spark, sp):
    rows = [(1, None, "x"), (1, None, "x"), (None, "", "x"), (2, "a b", None)]
    got = tokencount.token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string"), PIECE_BPE)
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in got.collect()) == \
        [(-1, 0, 0), (1, 0, 0), (1, 0, 0), (2, 3, len(sp.encode("a b")))]
    assert tokencount.token_counts(spark.createDataFrame([], "doc_id long, text string"), PIECE_BPE).count() == 0


def test_piece_encoder_matches_the_library(monkeypatch):
    enc = pieces.PieceEncoder(BYTE_BPE)
    monkeypatch.setattr(pieces, "STORE", 300)
    texts = ODD + noise(" \n\t'stmdrevlla1!.,  é日 ", 3000, 30, 4)
    for lo in range(0, len(texts), 50):
        for t, got in zip(texts[lo:lo + 50], enc.encode(texts[lo:lo + 50])):
            assert got.tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids


def test_wavelet_matrix_round_trip():
    rng = np.random.default_rng(1)
    for ids in (rng.integers(0, 50257, 5000), np.zeros(7, int), np.array([], int), rng.integers(0, 3, 1000),
                rng.integers(0, 100_000, 600)):
        w = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids.astype(np.uint32)).to_bytes())
        assert w.decode().tolist() == ids.tolist()
        for i in range(0, len(ids), 97):
            assert w.access(i) == ids[i]
        for t in {*ids[:5].tolist(), 2, 99_999, 1 << 20}:
            where = np.flatnonzero(ids == t)
            assert w.occurrences(t).tolist() == where.tolist()
            assert w.rank(t) == len(where) and w.rank(t, len(ids) // 2) == (where < len(ids) // 2).sum()
            assert w.select(t, 0) == (where[0] if len(where) else -1)
            for k in {len(where) // 2, len(where) - 1, len(where)} - {-1}:
                assert w.select(t, k) == (where[k] if k < len(where) else -1)


def test_select_reads_stretches_by_the_stored_samples():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 3000, 200_000).astype(np.uint32)
    w = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes())
    for plane, ones in zip(w.planes, w.ones):
        bits = np.unpackbits(plane, count=w.n)
        assert ones.tolist() == [int(bits[:i * wavelet._STEP * 8].sum()) for i in range(len(ones))]
    for t in (0, 1, 1500, 2999):
        where = np.flatnonzero(ids == t)
        assert w.occurrences(t).tolist() == where.tolist()
        assert [w.select(t, k) for k in range(0, len(where), 9)] == where[::9].tolist()


def brute_files(rows, enc):
    at, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*enc.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_token_files_match_brute_force(spark):
    rows = [(5, "a b"), (3, None), (3, ""), (9, "x " * 900), (None, "y"), (7, "<|endoftext|>"), (5, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_files(rows, pieces.encoder(BYTE_BPE).tokenizer)
    for shard_tokens in (4, 1 << 22):
        got = wavelet.token_files(docs, BYTE_BPE, shard_tokens=shard_tokens).collect()
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert wavelet.token_files(docs.limit(0), BYTE_BPE).count() == 0


def test_find_tokens(spark, tmp_path):
    docs = spark.createDataFrame([(i, "the cat" if i % 3 else "the the") for i in range(60)], "doc_id long, text string")
    wavelet.write(docs, str(tmp_path / "w"), BYTE_BPE, shard_tokens=20)
    tok = pieces.encoder(BYTE_BPE).tokenizer
    flat = [t for _, x in sorted((r[0], r[1]) for r in docs.collect()) for t in [*tok.encode(x).ids, 0]]
    the = tok.encode("the").ids[0]
    got = sorted(r[0] for r in wavelet.find(spark, str(tmp_path / "w"), the).collect())
    assert got == [i for i, t in enumerate(flat) if t == the]


def test_op9_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op9_token_files(spark, SF_SMALL).collect()))
    assert got == brute_files(docs, pieces.encoder(BYTE_BPE).tokenizer)


def test_very_long_text_and_clashing_names(spark):
    """A text beyond a chunk of the encoder and beyond a shard; columns with the names used inside."""
    rows = [(2, "some words " * 150_000), (1, "a"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_files(rows, pieces.encoder(BYTE_BPE).tokenizer)
    for c in ("key", "head", "hash", "part", "shard", "ids", "sizes", "matrix", "start", "own", "n_tokens", "ids_crc32"):
        docs = docs.withColumn(c, docs["doc_id"] * 0)
    got = wavelet.token_files(docs, BYTE_BPE, shard_tokens=10_000).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
