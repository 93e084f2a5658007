"""Forecast job: shape, status, no series lost, regression on event features."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from weekcast.functions import calendar as cal
from weekcast.plans import forecast
from weekcast.sources import inputs

MON = dt.date(2000, 1, 3)


def test_no_series_is_lost(spark):
    weekly = inputs.weekly(spark, SF_SMALL)
    n = weekly.select("product", "sku").distinct().count()
    out = forecast.forecast_best(weekly).cache()
    assert out.select("product", "sku").distinct().count() == n
    ok = out.filter("status = 'ok' and not is_history")
    assert ok.filter("demand_fitted is null").count() == 0
    assert ok.groupBy("product", "sku").count().filter(F.col("count") != forecast.HORIZON).count() == 0
    frame = forecast.series_frame(weekly)
    cols = ["product", "sku", "wk", "demand", "is_history"]
    assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, frame.select(*cols).collect()))
    out.unpersist()


def test_gaps_are_weeks_without_demand(spark):
    rows = [("A", "s", MON + dt.timedelta(weeks=i), 5.0) for i in range(60) if i % 4]
    weekly = spark.createDataFrame(rows, "product string, sku string, wk date, demand double")
    out = sorted(forecast.forecast_best(weekly).collect(), key=lambda r: r["wk"])
    assert [r["wk"] for r in out] == [MON + dt.timedelta(weeks=i) for i in range(1, 60)]
    assert [r["demand"] for r in out] == [5.0 if i % 4 else 0.0 for i in range(1, 60)]
    assert forecast.dense(weekly, fill="null").filter("demand is null").count() == 14


def test_short_series_are_returned_unfitted(spark):
    rows = [("A", "long", MON + dt.timedelta(weeks=i), float(10 + i % 7)) for i in range(41)]
    rows += [("A", "short", MON + dt.timedelta(weeks=i), float(5 + i % 3)) for i in range(40)]
    weekly = spark.createDataFrame(rows, "product string, sku string, wk date, demand double")
    for out in (forecast.forecast_best(weekly), forecast.exo_gain(weekly)):
        st = {r["sku"]: r["status"] for r in out.select("sku", "status").distinct().collect()}
        assert st == {"long": "ok", "short": "too_short"}


def test_event_regression_matches_numpy(spark):
    rng = np.random.default_rng(8)
    event = MON + dt.timedelta(weeks=60)
    weeks = [MON + dt.timedelta(weeks=i) for i in range(150)]
    ys = [float(20 + (w >= event) * 15 + 6 * (w.isocalendar()[1] in (51, 52)) + rng.integers(0, 4)) for w in weeks]
    weekly = spark.createDataFrame([("A", "s", w, y) for w, y in zip(weeks, ys)],
                                   "product string, sku string, wk date, demand double")
    r = forecast.exo_gain(weekly, event).first()
    x = np.array([[w >= event, w.isocalendar()[1] in (51, 52), w.isocalendar()[1] <= 4] for w in weeks], float)
    y = np.array(ys)
    a = np.column_stack([np.ones(110), x[:110]])
    coef = np.linalg.lstsq(a, y[:110], rcond=None)[0]
    with_x = np.mean((y[110:] - np.column_stack([np.ones(40), x[110:]]) @ coef) ** 2)
    without = np.mean((y[110:] - y[:110].mean()) ** 2)
    assert r["loss_without"] == pytest.approx(without, abs=0.01) and r["loss_with"] == pytest.approx(with_x, abs=0.02)
    assert r["gain"] > 0


def test_flag_constant_in_the_history_adds_nothing(spark):
    rows = [("A", "s", MON + dt.timedelta(weeks=i), float(i % 5)) for i in range(60)]
    weekly = spark.createDataFrame(rows, "product string, sku string, wk date, demand double")
    r = forecast.exo_gain(weekly, cal.REFERENCE_EVENT).first()
    assert r["loss_with"] is not None and r["status"] == "ok"
