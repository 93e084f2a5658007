"""Forests of many groups: against a plain grower, with hot and odd groups, and independent of partitioning."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from weekcast.operators import trees


def plain(cells, depth, bins, least):
    """Nodes of one tree from (bins..., y in units)."""
    out, level = {}, {1: cells}
    for d in range(depth + 1):
        below = {}
        for node, rows in level.items():
            n, s = len(rows), sum(r[-1] for r in rows)
            best = None
            for f in range(len(rows[0]) - 1) if d < depth else ():
                for b in range(bins):
                    left = [r[-1] for r in rows if r[f] <= b]
                    nl, sl = len(left), sum(left)
                    if nl < least or n - nl < least:
                        continue
                    gain = float(sl) * sl / nl + float(s - sl) * (s - sl) / (n - nl) - float(s) * s / n
                    # only bins that occur are split points
                    if gain > 0 and any(r[f] == b for r in rows) and (best is None or gain > best[0]):
                        best = (gain, f, b)
            out[node] = (best[1] if best else None, best[2] if best else None, n, s / n * 0.01)
            if best:
                _, f, b = best
                below[2 * node] = [r for r in rows if r[f] <= b]
                below[2 * node + 1] = [r for r in rows if r[f] > b]
        level = below
    return out


def data(n, groups, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        g = 0 if i % 3 == 0 else rng.randrange(groups)  # a third of the rows in one group
        a, b = rng.randint(0, 31), rng.uniform(-1, 1)
        rows.append((i, g, float(a), b, round(10 * (a > 15) + 5 * (b > 0) * (g % 2) + rng.gauss(0, 1), 2)))
    return rows


def test_equals_a_plain_grower_and_scores_like_it(spark):
    rows = data(3000, 8)
    df = spark.createDataFrame(rows, "id long, g int, a double, b double, y double").repartition(7)
    edges = [(min(r[i] for r in rows), max(r[i] for r in rows)) for i in (2, 3)]
    place = lambda v, lo, hi: max(0, min(int((v - lo) / (hi - lo) * 16), 15))
    nodes = trees.fit(df, "g", F.col("id") % 4, ["a", "b"], "y").cache()
    got = defaultdict(dict)
    for r in nodes.collect():
        got[r["g"], r["tree"]][r["node"]] = (r["feature"], r["bin"], r["n"], r["value"])
    want = {}
    for g in range(8):
        for t in range(4):
            cells = [(place(r[2], *edges[0]), place(r[3], *edges[1]), round(r[4] / 0.01)) for r in rows if r[1] == g and r[0] % 4 != t]
            want[g, t] = plain(cells, trees.DEPTH, trees.BINS, trees.LEAST)
    assert {k: {n: v[:3] for n, v in t.items()} for k, t in got.items()} == {k: {n: v[:3] for n, v in t.items()} for k, t in want.items()}
    for k, t in want.items():
        for n, v in t.items():
            assert got[k][n][3] == pytest.approx(v[3])

    def predict(r):
        out = []
        for t in range(4):
            node, tree = 1, want[r[1], t]
            while tree[node][0] is not None:
                f, b = tree[node][:2]
                node = 2 * node + (place(r[2 + f], *edges[f]) > b)
            out.append(tree[node][3])
        return sum(out) / 4
    scored = {r["id"]: r["prediction"] for r in trees.score(df, nodes, "g", ["a", "b"]).collect()}
    assert all(scored[r[0]] == pytest.approx(predict(r)) for r in rows)


def test_odd_rows_and_groups(spark):
    rows = [(i, 1, float(i % 5), 1.0, 2.0) for i in range(100)] + [(200, 2, 1.0, 1.0, 7.0), (201, 3, None, 1.0, 1.0),
                                                                    (202, 1, float("nan"), 1.0, 9.0), (203, 1, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "id long, g int, a double, b double, y double")
    nodes = trees.fit(df, "g", F.lit(0), ["a", "b"], "y", trees=1)
    by = {r["g"]: (r["n"], r["value"], r["feature"]) for r in nodes.collect()}
    assert by == {1: (100, 2.0, None), 2: (1, 7.0, None)}  # nothing to split, too small, and no complete row
    scored = {r["id"]: r["prediction"] for r in trees.score(df, nodes, "g", ["a", "b"]).collect()}
    assert scored[0] == 2.0 and scored[200] == 7.0 and scored[201] is None and scored[202] is None and scored[203] == 2.0
    assert trees.fit(df.limit(0), "g", F.lit(0), ["a", "b"], "y").count() == 0


def test_partitioning_changes_nothing_and_no_python(spark):
    df = spark.createDataFrame(data(900, 4, 9), "id long, g int, a double, b double, y double")
    fit = lambda d: trees.fit(d, "g", F.col("id") % 2, ["a", "b"], "y", trees=2)
    one, many = fit(df.coalesce(1)), fit(df.repartition(13, "y"))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    assert "Python" not in trees.score(df, one, "g", ["a", "b"])._jdf.queryExecution().executedPlan().toString()
