"""Lattice hashing against brute force."""

import numpy as np

from tests.conftest import SF_MID
from weekcast.llm import lattice, queries


def brute(ids, x, least=0.95):
    x = np.array(x, float)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    root = np.array(ids)
    while True:
        new = np.array([min([root[i], *root[near[i]]]) for i in range(len(ids))])
        if (new == root).all():
            return near.sum(1).tolist(), root.tolist()
        root = new


def planted(rng, n=150, dims=64):
    base = rng.normal(size=(n, dims))
    rows = [*base]
    for i in range(40):
        for noise in rng.uniform(0.01, 0.4, 3):
            rows.append(base[i] + noise * rng.normal(size=dims) * np.linalg.norm(base[i]) / np.sqrt(dims))
    rows += [base[50] * 3.0] * 5 + [base[51] + 0.02 * rng.normal(size=dims) for _ in range(120)]
    return rows


def test_decode_finds_the_nearest_lattice_point():
    rng = np.random.default_rng(2)
    y = rng.normal(size=(500, 8)) * 3
    c = lattice.decode(y)
    assert ((c * 2) % 2 == (c[:, :1] * 2) % 2).all() and (c.sum(1) % 2 == 0).all()
    step = ((y[:, None] - c[:, None] - lattice._roots()) ** 2).sum(2)
    assert (((y - c) ** 2).sum(1)[:, None] <= step + 1e-9).all()


def test_links_and_components_match_brute_force(spark):
    rng = np.random.default_rng(4)
    x = planted(rng)
    ids = [int(i) for i in rng.permutation(len(x)) * 7]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in zip(ids, x)], "vec_id long, embedding array<double>")
    links, comp = brute(ids, x)
    for block in (32, 1024):
        got = {r["vec_id"]: r for r in lattice.near_duplicates(df, block=block).collect()}
        assert [got[i]["component_id"] for i in ids] == comp
        assert [got[i]["n_links"] for i in ids] == links
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_every_length_among_its_own_kind(spark):
    rng = np.random.default_rng(9)
    sets = {d: planted(rng, 60, d) for d in (2, 3, 20, 64)}
    rows, want, at = [], {}, 0
    for x in sets.values():
        ids = list(range(at, at + len(x)))
        want |= dict(zip(ids, zip(*brute(ids, x))))
        rows += [(i, [float(v) for v in r]) for i, r in zip(ids, x)]
        at += len(x)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.near_duplicates(df, block=64).collect()}
    assert got == want


def test_recall_at_the_threshold():
    rng = np.random.default_rng(6)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    n = rng.normal(size=a.shape)
    n -= (n * a).sum(1, keepdims=True) * a
    n /= np.linalg.norm(n, axis=1, keepdims=True)
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * n
    met = np.zeros(len(a), bool)
    for t in lattice.directions(64):
        met |= (lattice.cells(a, t)[:, :, None] == lattice.cells(b, t)[:, None, :]).any((1, 2))
    assert met.mean() > 0.99


def test_op7_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()
    ids = [r["vec_id"] for r in rows]
    links, comp = brute(ids, [r["embedding"] for r in rows])
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in queries.op7_lattice_near_dedup(spark, SF_MID).collect()}
    assert [got[i] for i in ids] == list(zip(links, comp))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (2, None), (3, [0.0, 0.0, 0.0]), (4, [nan, 1.0, 0.0]), (5, [inf, 0.0, 0.0]),
            (6, [1.0, None, 0.0]), (7, []), (8, [1.0, 0.001, 0.0]), (8, [1.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]),
            (9, [1.0, 0.0]), (10, [1e-200, 0.0, 0.0]), (11, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "vec_id long, embedding array<double>, node string, n int")
    got = lattice.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"]))
    assert by[1] == [(4, 1)] and by[8] == [(4, 1), (4, 1)] and by[None] == [(4, 1)] and by[10] == [(4, 1)]
    assert all(by[i] == [(0, i)] for i in (2, 3, 4, 5, 6, 7, 9, 11))
    assert lattice.near_duplicates(df.limit(0)).count() == 0
