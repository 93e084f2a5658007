"""Orders of differencing against a plain statistic."""

import datetime as dt
import random

import pytest

from weekcast.operators import stationarity

START = dt.date(2000, 1, 3)


def frame(spark, series):
    rows = [(k, START + dt.timedelta(7 * t), v) for k, values in series.items() for t, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, wk date, demand double").repartition(3)


def summed(values):
    out, total = [], 0.0
    for v in values:
        total += v
        out.append(total)
    return out


def plain(y):
    n, mean = len(y), sum(y) / len(y)
    e = [v - mean for v in y]
    run = sum(v * v for v in e) + sum(2 * (1 - j / 5) * sum(a * b for a, b in zip(e[j:], e)) for j in range(1, 5))
    return sum(s * s for s in summed(e)) / n / run if run > 1e-6 else None


def test_statistics_and_orders(spark):
    rng = random.Random(7)
    noise = [rng.gauss(0, 1) for _ in range(400)]
    data = {"noise": noise, "walk": summed(noise), "twice": summed(summed(noise)), "flat": [3.0] * 60,
            "line": [2.0 * t for t in range(60)], "edge": noise[:22], "short": noise[:21], "one": [1.0]}
    got = {r["k"]: r for r in stationarity.difference_order(frame(spark, data), ["k"]).collect()}
    assert got.keys() == data.keys()
    for k, y in data.items():
        r = got[k]
        assert r["n"] == len(y) and r["status"] == ("ok" if len(y) >= 22 else "too_short")
        for d in range(3):
            want = plain(y) if r["status"] == "ok" else None
            assert r[f"kpss{d}"] == (None if want is None else pytest.approx(want, abs=1e-5)), (k, d)
            y = [b - a for a, b in zip(y, y[1:])]
    assert {k: r["d"] for k, r in got.items()} == {"noise": 0, "walk": 1, "twice": 2, "flat": 0, "line": 1,
                                                   "edge": got["edge"]["d"], "short": None, "one": None}


def test_one_exchange_no_python_and_empty(spark):
    df = frame(spark, {"a": [1.0] * 30})
    got = stationarity.difference_order(df, ["k"])
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert stationarity.difference_order(df.limit(0), ["k"]).count() == 0
