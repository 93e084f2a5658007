"""Two tables compared by key: against a plain comparison, with hot, null and repeated keys and all column types."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from weekcast.operators import diff


def plain(a, b, nkeys):
    sides = []
    for rows in (a, b):
        by = defaultdict(Counter)
        for r in rows:
            by[r[:nkeys]][r] += 1
        sides.append(by)
    out = {}
    for k in {*sides[0], *sides[1]}:
        x, y = sides[0].get(k, Counter()), sides[1].get(k, Counter())
        if x != y:
            out[k] = ("added" if not x else "removed" if not y else "changed", sum(x.values()), sum(y.values()))
    return out


def found(df, nkeys):
    rows = [tuple(r) for r in df.collect()]
    out = {r[:nkeys]: r[nkeys:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_equals_a_plain_comparison(spark):
    rng = random.Random(5)
    a = [(rng.randrange(2000) if i % 3 else 0, rng.choice(["x", "y", None]), rng.choice([None, 1.5, -2.0]), rng.choice(["p", "", None])) for i in range(6000)]
    b = [r for r in a if rng.random() > 0.002] + [(5000 + i, "x", 0.0, "new") for i in range(9)]
    b = [(*r[:2], r[2], "edit") if rng.random() < 0.002 else r for r in b] + a[1:4]
    rng.shuffle(b)
    make = lambda rows, n: spark.createDataFrame(rows, "k long, s string, v double, t string").repartition(n)
    want = plain(a, b, 2)
    assert 10 < len(want) < 60
    assert found(diff.table_diff(make(a, 3), make(b, 7).select("t", "k", "v", "s"), ["k", "s"]), 2) == want
    # partitioning and order change nothing
    assert diff.table_diff(make(a, 3), make(a[::-1], 11), ["k", "s"]).count() == 0


def test_nulls_in_other_columns_and_swapped_values(spark):
    schema = "k int, a string, b string"
    left = spark.createDataFrame([(1, None, "x"), (2, "x", "y"), (None, "q", None), (4, "", None)], schema)
    right = spark.createDataFrame([(1, "x", None), (2, "y", "x"), (None, "q", None), (4, None, "")], schema)
    assert found(diff.table_diff(left, right, ["k"]), 1) == {(k,): ("changed", 1, 1) for k in (1, 2, 4)}


def test_nested_columns_and_odd_names(spark):
    one = spark.range(20).selectExpr("id AS `k.x`", "array(id, null) AS l", "named_struct('a', null, 'b', id) AS s", "map('a', id, 'b', 2) AS _leaf")
    same = spark.range(20).selectExpr("id AS `k.x`", "array(id, null) AS l", "named_struct('a', null, 'b', id) AS s", "map('b', 2, 'a', id) AS _leaf")
    other = spark.range(20).selectExpr("id AS `k.x`", "if(id = 3, array(null, id), array(id, null)) AS l", "named_struct('a', null, 'b', id) AS s",
                                       "map('a', if(id = 7, 0, id), 'b', 2) AS _leaf")
    assert diff.table_diff(one, same, ["k.x"]).count() == 0
    assert set(found(diff.table_diff(one, other, ["k.x"]), 1)) == {(3,), (7,)}


def test_keys_named_like_inner_columns(spark):
    df = spark.range(50).selectExpr("id AS n", "id % 3 AS d1", "id AS _leaf", "id AS _side", "'v' AS _h1")
    edit = df.withColumn("_h1", F.when(F.col("n") == 9, "w").otherwise("v"))
    assert found(diff.table_diff(df, edit, ["n", "d1", "_leaf", "_side"]), 4) == {(9, 0, 9, 9): ("changed", 1, 1)}
    with pytest.raises(ValueError):
        diff.table_diff(df.withColumnRenamed("n", "change"), df.withColumnRenamed("n", "change"), ["change"])


def test_empty_tables_and_other_columns(spark):
    df = spark.range(5).withColumn("v", F.lit(1))
    none = df.limit(0)
    assert diff.table_diff(none, none, ["id"]).count() == 0
    assert found(diff.table_diff(none, df, ["id"]), 1) == {(i,): ("added", 0, 1) for i in range(5)}
    assert found(diff.table_diff(df, none, ["id"]), 1) == {(i,): ("removed", 1, 0) for i in range(5)}
    with pytest.raises(ValueError):
        diff.table_diff(df, df.withColumn("w", F.lit(1)), ["id"])
    with pytest.raises(ValueError):
        diff.table_diff(df, df.withColumn("v", F.lit("1")), ["id"])
    assert diff.table_diff(df, df.withColumn("w", F.lit(1)), ["id"], values=["v"]).count() == 0


def test_only_buckets_that_differ_are_searched(spark):
    df = spark.range(40000).withColumn("v", F.col("id") % 7)
    edit = df.withColumn("v", F.when(F.col("id").isin(17, 30303), -1).otherwise(F.col("v")))
    a, b = diff.signature(df, ["id"]), diff.signature(edit, ["id"])
    leaves = {r["bucket"] for r in diff.differing(a, b).collect()}
    want = {r["_leaf"] for r in diff.hashed(df, ["id"]).where("id IN (17, 30303)").collect()}
    assert leaves == want and len(leaves) == 2
    assert {r["level"]: r["n"] for r in a.groupBy("level").agg(F.sum("n").alias("n")).collect()} == dict.fromkeys(range(diff.LEVELS + 1), 40000)
    assert set(found(diff.table_diff(df, edit, ["id"], left_signature=a, right_signature=b), 1)) == {(17,), (30303,)}
    assert diff.differing(a, a).isEmpty()


def test_no_python_and_sums_before_the_shuffle(spark):
    df = spark.range(100).withColumn("v", F.lit(1))
    plan = diff.table_diff(df, df.where("id > 3"), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("HashAggregate") == 2 and "partial_sum" in plan
