"""Autoregressive moving averages: known coefficients, short and constant series, no Python in the plan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from weekcast import queries
from weekcast.operators import arma, models

START = dt.date(2000, 1, 3)


def frame(spark, series):
    rows = [(k, START + dt.timedelta(7 * t), float(v)) for k, values in series.items() for t, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, wk date, demand double")


def walk(phi, theta, n, seed=1, level=50.0):
    rng = random.Random(seed)
    out, y, e = [], 0.0, 0.0
    for _ in range(n):
        new = rng.gauss(0, 1)
        y, e = phi * y + theta * e + new, new
        out.append(level + y)
    return out


def test_the_right_order_fits_best(spark):
    n = 3000
    df = frame(spark, {"ar": walk(0.9, 0.0, n), "ma": walk(0.0, 0.8, n), "noise": walk(0.0, 0.0, n)})
    got = arma.fits(df, ["k"], 40)
    one_step = got.select("k", "p", "q", arma.mean_error("11", "greatest(nh - 10, 1)").alias("mse"))
    mse = {(r["k"], r["p"], r["q"]): r["mse"] for r in one_step.collect()}
    assert mse["ar", 0, 0] > 4 and mse["ar", 1, 0] == pytest.approx(1, abs=0.1)
    assert mse["ma", 0, 0] > 1.5 and mse["ma", 0, 1] == pytest.approx(1, abs=0.1)
    assert mse["noise", 2, 1] == pytest.approx(mse["noise", 0, 0], abs=0.05)


def test_forecasts_decay_to_the_mean(spark):
    got = arma.fits(frame(spark, {"ar": walk(0.9, 0.0, 2000)}), ["k"], 40).where("p = 1 and q = 0").first()
    tail = [v - 50 for v in got["fitted"][-40:]]
    ratio = [(b - tail[-1]) / (a - tail[-1]) for a, b in zip(tail[:8], tail[1:9])]
    assert all(0.8 < r < 0.97 for r in ratio)


def test_short_and_constant_series(spark):
    df = frame(spark, {"short": range(50), "flat": [7.0] * 120, "edge": walk(0.5, 0, 64)})
    by = {}
    for r in arma.losses(df, ["k"], 40).collect():
        by.setdefault(r["k"], []).append((r["status"], r["loss"]))
    assert by["short"] == [("too_short", None)] * 6
    assert by["flat"] == [("ok", 0.0)] * 6
    assert len(by["edge"]) == 6 and ("ok" in {s for s, _ in by["edge"]})
    rows = arma.forecast(df, ["k"], 40).collect()
    assert len(rows) == 50 + 120 + 64
    assert all(r["demand_fitted"] is None and not r["is_history"] for r in rows if r["k"] == "short")
    assert all(r["demand_fitted"] == 7.0 for r in rows if r["k"] == "flat")


def test_plan_has_no_python_and_one_exchange_for_all_orders(spark):
    plan = arma.losses(frame(spark, {"a": [1.0] * 80}), ["k"], 40)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert queries.arma_losses(spark, SF_SMALL).columns == ["product", "sku", "p", "q", "status", "loss"]


def test_solve_twelve_unknowns(spark):
    rng = random.Random(4)
    k = 12
    rows = [[rng.gauss(0, 1) for _ in range(k)] for _ in range(300)]
    coef = [rng.uniform(-3, 3) for _ in range(k)]
    data = [("g", *r, 5 + sum(c * x for c, x in zip(coef, r))) for r in rows]
    names = [f"x{i}" for i in range(k)]
    df = spark.createDataFrame(data, "g string, " + ", ".join(f"{n} double" for n in names) + ", y double")
    fit = models.fit_ols(df, "g", names, "y")
    r = fit.first()
    assert r["coef"] == pytest.approx(coef) and r["intercept"] == pytest.approx(5) and r["mse"] == pytest.approx(0, abs=1e-9)
    assert len(fit._jdf.queryExecution().analyzed().toString()) < 200_000
    same = models.fit_ols(df.withColumn("x11", F.col("x0")), "g", names, "y").first()
    assert same["coef"][0] is None or same["coef"] is None
