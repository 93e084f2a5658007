"""Exponential smoothing and successive halving against plain loops."""

import datetime as dt
import random

import pytest

from weekcast.operators import smoothing

START = dt.date(2000, 1, 3)


def frame(spark, series):
    rows = [(k, START + dt.timedelta(7 * t), v) for k, values in series.items() for t, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, wk date, demand double").repartition(3)


def wave(n, seed, season=0.0):
    rng = random.Random(seed)
    return [50 + 0.1 * t + season * (t % 13) + rng.gauss(0, 3) for t in range(n)]


def plain(y, ahead, alpha, beta, phi, gamma, m):
    level, trend = sum(y[:m]) / m, 0.0
    seasons = [v - level for v in y[:m]]
    for t in range(m, len(y)):
        error = y[t] - (level + phi * trend + seasons[t - m])
        level, trend = level + phi * trend + alpha * error, phi * trend + alpha * beta * error
        seasons.append(seasons[t - m] + gamma * error)
    out, grown = [], 0.0
    for k in range(1, ahead + 1):
        grown += phi ** k
        out.append(level + grown * trend + seasons[len(y) - m + (k - 1) % m])
    return out


def plain_loss(y, tail, c):
    return sum((v - f) ** 2 for v, f in zip(y[-tail:], plain(y[:-tail], tail, *c))) / tail


@pytest.fixture(scope="module")
def several(spark):
    data = {"long": wave(300, 1), "seasonal": wave(180, 2, 4.0), "edge": wave(66, 3), "short": wave(65, 4), "one": [1.0]}
    return data, frame(spark, data)


def test_losses_and_forecasts_match_plain_loops(several):
    data, df = several
    got = {(r["k"], r["cand_id"]): (r["status"], r["loss"]) for r in smoothing.losses(df, ["k"], 40).collect()}
    assert len(got) == len(data) * len(smoothing.CANDIDATES) == len(data) * 16
    best = {}
    for key, y in data.items():
        for i, c in enumerate(smoothing.CANDIDATES):
            if len(y) < 66:
                assert got[key, i] == ("too_short", None)
                continue
            assert got[key, i] == ("ok", pytest.approx(plain_loss(y, 40, c), abs=1e-4))
            best[key] = min(best.get(key, (9e9, 0)), (got[key, i][1], i))
    assert best["seasonal"][1] >= 8
    ahead = {}
    for r in smoothing.forecast(df, ["k"], 40).orderBy("k", "wk").collect():
        ahead.setdefault((r["k"], r["cand_id"]), []).append((r["wk"], r["demand_forecast"]))
    assert {k: i for k, i in ahead} == {k: i for k, (_, i) in best.items()}
    for (key, i), rows in ahead.items():
        assert [w for w, _ in rows] == [START + dt.timedelta(7 * (len(data[key]) + t)) for t in range(40)]
        assert [v for _, v in rows] == pytest.approx(plain(data[key], 40, *smoothing.CANDIDATES[i]), abs=1e-4)


def test_halving_keeps_the_better_half(several):
    data, df = several
    rounds = {}
    for r in smoothing.halving(df, ["k"], 40).collect():
        rounds.setdefault((r["k"], r["rung"]), []).append(r)
    assert set(rounds) == {(k, g) for k in ("long", "seasonal", "edge") for g in range(4)} | {("short", 0), ("one", 0)}
    for key in ("short", "one"):
        assert [(r["status"], r["n_fits"], r["loss"], r["kept"]) for r in rounds[key, 0]] == [("too_short", 0, None, False)] * 16
    for key in ("long", "seasonal", "edge"):
        left = set(range(16))
        for rung, tail in enumerate((5, 10, 20, 40)):
            rows, y = rounds[key, rung], data[key]
            weeks = len(y) - tail if rung == 3 else min(len(y) - tail, 8 * tail)
            assert {r["cand_id"] for r in rows} == left and {(r["n_fits"], r["weeks"]) for r in rows} == {(len(left), weeks)}
            for r in rows:
                assert r["loss"] == pytest.approx(plain_loss(y[len(y) - weeks - tail:], tail, smoothing.CANDIDATES[r["cand_id"]]), abs=1e-4)
            ranked = [r["cand_id"] for r in sorted(rows, key=lambda r: (r["loss"], r["cand_id"]))]
            left = set(ranked[:1 if rung == 3 else len(ranked) // 2])
            assert {r["cand_id"] for r in rows if r["kept"]} == left
        assert len(left) == 1


def test_constant_null_and_empty(spark):
    df = frame(spark, {"flat": [7.0] * 120, "gap": [1.0] * 50 + [None] + [2.0] * 60})
    got = smoothing.losses(df, ["k"], 40).collect()
    assert {r["loss"] for r in got if r["k"] == "flat"} == {0.0}
    assert {(r["status"], r["loss"]) for r in got if r["k"] == "gap"} == {("ok", None)}
    kept = [r["cand_id"] for r in smoothing.halving(df, ["k"], 40).where("kept and rung = 3").collect()]
    assert kept == [0, 0]
    empty = df.limit(0)
    assert [f(empty, ["k"], 40).count() for f in (smoothing.losses, smoothing.forecast, smoothing.halving)] == [0, 0, 0]


def test_one_exchange_and_no_python(spark):
    plan = smoothing.losses(frame(spark, {"a": [1.0] * 80}), ["k"], 40)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange hashpartitioning") == 1
