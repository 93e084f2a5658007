"""Search: arg-min rules, SQL forecasters against brute force."""

import datetime as dt

import numpy as np
import pytest

from weekcast.operators import search


def test_argmin_tie_goes_to_smallest_id(spark):
    df = spark.createDataFrame([("s", 0, 2.0), ("s", 1, 2.0), ("s", 2, 3.0)], "k string, cand_id int, loss double")
    r = search.arg_min(df, ["k"], "loss", "cand_id", ["cand_id", "loss"]).first()
    assert r["cand_id"] == 0


def test_argmin_skips_non_finite(spark):
    df = spark.createDataFrame([("s", 0, float("nan")), ("s", 1, 5.0), ("s", 2, None), ("s", 3, float("inf"))],
                               "k string, cand_id int, loss double")
    assert search.arg_min(df, ["k"], "loss", "cand_id", ["cand_id"]).first()["cand_id"] == 1


def test_best_order_is_read_by_name(spark):
    # fields deliberately out of p, d, q order
    df = spark.createDataFrame([("s", 7, 1, 0, 2, 1.0), ("s", 8, 0, 1, 1, 9.0)],
                               "k string, cand_id int, q int, d int, p int, loss double")
    best = search.arg_min(df, ["k"], "loss", "cand_id", ["q", "p", "d"]).first()
    assert (best["p"], best["d"], best["q"]) == (2, 0, 1)


def brute(ys, h):
    """Per forecaster: one-step fits of the history, forecasts of the tail, tail error."""
    n, nh = len(ys), len(ys) - h
    out = {}
    for cid, k in ((0, None), (1, 4), (2, 26), (3, 52), (4, None)):
        fit = []
        for t in range(nh):
            before = ys[:t]
            if not before:
                fit.append(None)
            elif k:
                fit.append(float(np.mean(before[-k:])))
            elif cid == 0:
                fit.append(before[-1])
            else:
                fit.append(before[-1] + ((before[-1] - before[0]) / (t - 1) if t > 1 else 0.0))
        hist = ys[:nh]
        slope = (hist[-1] - hist[0]) / (nh - 1) if nh > 1 else 0.0
        tail = [hist[-1] if cid == 0 else float(np.mean(hist[-k:])) if k else hist[-1] + (j + 1) * slope for j in range(h)]
        out[cid] = fit + tail, round(float(np.mean((np.array(ys[nh:n]) - np.array(tail)) ** 2)), 6)
    return out


@pytest.fixture(scope="module")
def several(spark):
    rng = np.random.default_rng(3)
    start = dt.date(2024, 1, 1)
    data = {key: [float(v) for v in rng.integers(0, 50, n)] for key, n in (("a", 70), ("b", 45), ("c", 12), ("d", 11), ("e", 10), ("f", 3))}
    rows = [(key, start + dt.timedelta(weeks=i), y) for key, ys in data.items() for i, y in enumerate(ys)]
    return data, spark.createDataFrame(rows, "k string, wk date, demand double").repartition(3)


def test_losses_match_brute_force_and_lose_no_series(several):
    data, df = several
    got = {(r["k"], r["cand_id"]): (r["loss"], r["status"]) for r in search.sql_forecaster_losses(df, ["k"], 10).collect()}
    assert len(got) == 5 * len(data)
    for key, ys in data.items():
        for cid in range(5):
            loss, status = got[key, cid]
            if len(ys) <= 10:
                assert (loss, status) == (None, "too_short")
            else:
                assert status == "ok" and loss == pytest.approx(brute(ys, 10)[cid][1], abs=1e-6)


def test_best_forecast_matches_brute_force(several):
    data, df = several
    rows = sorted(search.forecast_best(df, ["k"], 10).collect(), key=lambda r: (r["k"], r["wk"]))
    for key, ys in data.items():
        own = [r for r in rows if r["k"] == key]
        assert [r["demand"] for r in own] == ys
        if len(ys) <= 10:
            assert all(r["status"] == "too_short" and r["demand_fitted"] is None and r["cand_id"] is None for r in own)
            continue
        fits = brute(ys, 10)
        best = min(fits, key=lambda c: (fits[c][1], c))
        assert {r["cand_id"] for r in own} == {best}
        assert [r["is_history"] for r in own] == [True] * (len(ys) - 10) + [False] * 10
        for r, want in zip(own, fits[best][0]):
            assert (r["demand_fitted"] is None) == (want is None)
            assert want is None or r["demand_fitted"] == pytest.approx(want, abs=1e-6)
