"""SimHash near-duplicates against brute force."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from weekcast.llm import components, simhash


def low_words(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_fp(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", low_words(text))
    grams = [" ".join(words[i:i + k]) for i in range(max(len(words) - k, 0) + 1)] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_components(ids, fps, radius):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    a = np.array(fps, dtype=np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= radius):
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    best = {}
    for i in range(len(ids)):
        r = find(i)
        best[r] = min(best.get(r, ids[i]), ids[i])
    return [best[find(i)] for i in range(len(ids))]


TEXTS = ["one two three four five six", "One two three four five six", "", None, "  \t", "solo", "a b c", "Ñandú É x y z",
         "w " * 3000, "w " * 2999 + "v", "one two three four five seven", "日本 語 の テスト です ね"]


def test_matches_brute_force_on_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (99, None)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in rows)
    want = {i: brute_fp(t) for i, t in rows}
    assert {r["doc_id"]: r["fp"] & (2**64 - 1) for r in got} == want
    ids = list(want)
    comp = dict(zip(ids, brute_components(ids, [want[i] for i in ids], 4)))
    assert {r["doc_id"]: r["component_id"] for r in got} == comp


def test_query_matches_brute_force(spark):
    from tests.conftest import SF_SMALL
    from weekcast.llm import queries
    got = {r["doc_id"]: r for r in queries.op4_simhash_near_dedup(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    ids = [d["doc_id"] for d in docs]
    fps = [brute_fp(d["text"]) for d in docs]
    comp = brute_components(ids, fps, 4)
    for i, f, c in zip(ids, fps, comp):
        assert got[i]["fingerprint"] == f"{f:016x}"
        assert got[i]["component_id"] == c
    assert len(set(comp)) < len(ids)


def test_masks_cover_every_pair():
    rng = np.random.default_rng(3)
    ms = simhash.masks(4)
    for _ in range(3000):
        bits = rng.choice(64, size=rng.integers(0, 5), replace=False)
        diff = sum(1 << int(b) for b in bits)
        assert any(diff & m == 0 for m in ms)


def test_second_masks_cover_every_pair_of_a_bucket():
    rng = np.random.default_rng(4)
    for first in simhash.masks(4):
        second = simhash.masks(4, ~first)
        assert all(m & first == 0 for m in second) and min((m | first).bit_count() for m in second) >= 48
        free = [i for i in range(64) if not first >> i & 1]
        for _ in range(100):
            diff = sum(1 << int(b) for b in rng.choice(free, size=rng.integers(0, 5), replace=False))
            assert any(diff & m == 0 for m in second)


def test_hot_buckets_are_dealt_again_and_lose_no_link(spark):
    rng = np.random.default_rng(6)
    base = int(rng.integers(0, 2**63))
    fps = {base ^ sum(1 << int(b) for b in rng.choice(64, 5, replace=False)) for _ in range(1500)}
    signed = sorted(f - 2**64 if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    keyed = df.select(F.lit(3).alias("t"), F.lit(0).cast("long").alias("k"), "fp")
    assert simhash._dealt_again(keyed, 4).count() == 31 * len(signed)
    want = brute_components(signed, [f & (2**64 - 1) for f in signed], 4)
    for wide in (2, 10 ** 6):  # buckets beyond 8 are dealt again; none is
        got = dict(components.components(simhash.links(df, 4, 4, wide)).collect())
        assert [got.get(f, f) for f in signed] == want
    assert len(set(want)) > 3


@pytest.mark.parametrize("block", [4, 2048])
def test_links_connect_like_all_pairs(spark, block):
    rng = np.random.default_rng(5)
    centre = int(rng.integers(0, 2**63))
    fps = {centre} | {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (120, 2))}
    fps |= {int(x) for x in rng.integers(0, 2**63, 60)}
    signed = sorted(f - 2**64 if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = dict(components.components(simhash.links(df, 4, block)).collect())
    want = brute_components(signed, [f & (2**64 - 1) for f in signed], 4)
    assert [got.get(f, f) for f in signed] == want


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, fp string, n int, key int")
    assert simhash.near_duplicates(empty).count() == 0
    one = spark.createDataFrame([(5, "a b", "x", 1, 2)], "doc_id long, text string, fp string, n int, key int")
    assert [r["component_id"] for r in simhash.near_duplicates(one).collect()] == [5]


def test_long_chain_is_one_component(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components.components(links).collect()
    assert {r["component"] for r in got} == {0} and len(got) == 301
