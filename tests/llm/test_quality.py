"""Quality classifier: held-out accuracy, tree arithmetic, odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from weekcast.llm import quality, queries


def auc(score, y):
    rank = np.argsort(np.argsort(score))
    return (rank[y == 1].mean() - rank[y == 0].mean()) / len(y) + 0.5


def test_held_out_accuracy(spark):
    got = queries.op5_quality(spark, SF_MID)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    assert got.count() == docs.count()
    assert got.dtypes[1:] == [("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.join(spark.read.parquet(f"{SF_MID}/labels.parquet"), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    out = [r for r in rows if r["held_out"]]
    y = np.array([r["quality"] for r in out])
    assert auc(np.array([r["score"] for r in out]), y) > 0.95
    assert np.mean([r["predicted"] == r["quality"] for r in out]) > 0.95


def test_flat_trees_walk_like_nested_ones():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    t = quality.grow(x, y, trees=30)

    def walk(row):
        out = t.base
        for at in t.roots:
            while t.left[at] != at:
                at = t.left[at] if row[t.feature[at]] <= t.cut[at] else t.right[at]
            out += t.value[at]
        return 1 / (1 + np.exp(-out))
    assert np.allclose(t.score(x), [walk(r) for r in x])
    assert ((t.score(x) > 0.5) == y).mean() > 0.97


def test_odd_rows_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "a b", 2), (2, "", 3), (3, "x " * 9000, 4)],
                                 "doc_id long, text string, score int")
    for rows in ([], [(2, 1), (2, 0), (None, 1), (3, None)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        got = quality.classify(docs, labels).collect()
        assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
        assert len({r["score"] for r in got if r["doc_id"] == 1}) == 1
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_labels_sample_is_bounded_and_skips_held_out(spark):
    labels = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    got = quality.sampled_labels(labels, ~quality.held_out("key"), 50).collect()
    assert len(got) == 50
    assert all(zlib.crc32(str(r["key"]).encode()) % 5 for r in got)


def test_keep_good_returns_whole_rows(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    trees = quality.train(docs, labels)
    kept = quality.keep_good(docs, trees)
    assert kept.columns == docs.columns
    want = quality.classify(docs, labels).where("predicted = 1").select("doc_id")
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in want.collect())
