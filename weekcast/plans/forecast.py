"""Forecast every series: regularise -> split -> candidates -> arg-min -> fitted
history and forecast tail, as one Spark dataflow without a Python stage.

Series are made regular first (every Monday between a series' first and last
week); all windows share the series key, so the whole job is the weekly
aggregate plus one exchange.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekcast.functions import calendar as cal
from weekcast.operators import models, search, series

KEYS = ["product", "sku"]
FEATURES = ["covid", "christmas", "new_year"]
HORIZON = 40
#: Added to the variances of the event features: a flag that is constant in a history gets the
#: coefficient 0 instead of making the system singular.
RIDGE = 1e-6


def dense(weekly: DataFrame, fill: str = "zero") -> DataFrame:
    """Weekly demand on every Monday of each series.  ``fill``: the input is a
    sum of shipped quantity, so a missing week shipped nothing (``zero``);
    ``null`` keeps gaps open, ``ffill`` repeats the last value."""
    return series.regularise(weekly, KEYS, "demand", "wk", fill=fill)


def series_frame(weekly: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The frame that every forecast fills in: one row per series and week,
    with the hold-out flag and whether the series has any history."""
    rows = search.forecasts(dense(weekly), KEYS, horizon)
    return rows.select(*KEYS, "wk", "demand", "is_history", (F.col("status") == "ok").alias("eligible"))


def forecast_best(weekly: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Every series week by week with the fitted values and forecasts of its best forecaster."""
    return search.forecast_best(dense(weekly), KEYS, horizon)


def exo_gain(weekly: DataFrame, event: dt.date = cal.TEST_EVENT, horizon: int = HORIZON) -> DataFrame:
    """Tail error of a per-series regression without and with the event features.

    Without: the mean of the history.  With: least squares on the three flags,
    from window moments of the history and a 3 x 3 system solved by column
    expressions.  Series without history have status ``too_short`` and nulls.
    """
    by = Window.partitionBy(*KEYS)
    rows = dense(weekly).select("*", *[c.cast("double").alias(n) for n, c in cal.exo_columns(F.col("wk"), event).items()])
    nh = F.count(F.lit(1)).over(by) - F.lit(horizon)
    rows = rows.withColumn("_hist", F.row_number().over(by.orderBy("wk")) <= nh)

    def past(c):
        return F.when(F.col("_hist"), F.col(c))
    k = len(FEATURES)
    moments = [F.avg(past("demand")).over(by).alias("_my")]
    for i, a in enumerate(FEATURES):
        moments += [F.avg(past(a)).over(by).alias(f"_m{i}"), F.covar_pop(past(a), past("demand")).over(by).alias(f"_cy{i}")]
        moments += [F.covar_pop(past(a), past(FEATURES[j])).over(by).alias(f"_c{i}{j}") for j in range(i, k)]
    rows = rows.select("*", *moments)
    cxx = [[F.col(f"_c{min(i, j)}{max(i, j)}") + (RIDGE if i == j else 0.0) for j in range(k)] for i in range(k)]
    guess = F.col("_my")
    for i, b in enumerate(models.solve(cxx, [F.col(f"_cy{i}") for i in range(k)])):
        guess = guess + b * (F.col(FEATURES[i]) - F.col(f"_m{i}"))
    tail, y = ~F.col("_hist"), F.col("demand")
    got = rows.groupBy(*KEYS).agg(
        F.when(F.max("_hist"), "ok").otherwise("too_short").alias("status"),
        F.avg(F.when(tail, F.pow(y - F.col("_my"), F.lit(2)))).alias("_without"),
        F.avg(F.when(tail, F.pow(y - guess, F.lit(2)))).alias("_with"))
    return got.select(*KEYS, "status", F.round("_without", 2).alias("loss_without"), F.round("_with", 2).alias("loss_with"),
                      F.round(F.col("_without") - F.col("_with"), 2).alias("gain"))
