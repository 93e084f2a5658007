"""Model search as data: candidates are rows, losses are a column, the best
candidate per series is an arg-min aggregate.

Forecasters are column expressions over one window partitioning; split, loss
and arg-min are shared by all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Forecasters that SQL can express, as (cand_id, name, window length or None).
SQL_FORECASTERS = ((0, "last", None), (1, "mean4", 4), (2, "mean26", 26), (3, "mean52", 52),
                   (4, "drift", None))


def finite_or_inf(c) -> Column:
    """Null and NaN losses rank last in the arg-min."""
    inf = F.lit(float("inf"))
    return F.when(c.isNull() | F.isnan(c), inf).otherwise(c)


def arg_min(df: DataFrame, keys, loss: str, tie: str, carry) -> DataFrame:
    """Row with the smallest ``loss`` per group, ties broken by smallest ``tie``.

    ``min_by`` is an ordinary aggregate, so it is computed partially on the
    map side: a group holding a third of all rows is never gathered.
    """
    order = F.struct(finite_or_inf(F.col(loss)).alias("l"), F.col(tie).alias("t"))
    best = F.min_by(F.struct(*[F.col(c) for c in carry]), order)
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")


def forecasts(df: DataFrame, keys, horizon: int, value: str = "demand", order_col: str = "wk") -> DataFrame:
    """Every row of every series with each forecaster's value for it.

    Adds ``is_history``, ``status`` and one column ``f_<name>`` per forecaster:
    in the last ``horizon`` weeks its forecast from the history, before them
    its one-step forecast from the weeks before (the fitted history; null in
    the first week).  A series of no more than ``horizon`` weeks has no
    history: its rows stay, with status ``too_short`` and null forecasts.
    Input must be regular (one row per week).  One exchange on the series key.
    """
    by = Window.partitionBy(*keys)
    w = by.orderBy(order_col)
    y, rn, nh = F.col(value), F.col("_rn"), F.col("_nh")
    t = df.select(*keys, order_col, value, F.row_number().over(w).alias("_rn")) \
          .withColumn("_nh", F.count(F.lit(1)).over(by) - F.lit(horizon))
    hist = rn <= nh
    last, first = F.max(F.when(rn == nh, y)).over(by), F.max(F.when(rn == 1, y)).over(by)
    before = F.lag(value, 1).over(w)
    out = {"f_last": F.when(hist, before).otherwise(last)}
    for _, name, k in SQL_FORECASTERS:
        if k:
            recent = F.avg(y).over(w.rowsBetween(-k, -1))
            out[f"f_{name}"] = F.when(hist, recent).otherwise(F.avg(F.when(hist & (rn > nh - F.lit(k)), y)).over(by))
    t = t.select("*", last.alias("_last"), first.alias("_first"), before.alias("_before"),
                 *[c.alias(n) for n, c in out.items()])
    ahead = F.col("_last") + (rn - nh) * F.coalesce(F.try_divide(F.col("_last") - F.col("_first"), nh - 1), F.lit(0.0))
    step = F.col("_before") + F.coalesce(F.try_divide(F.col("_before") - F.col("_first"), rn - 2), F.lit(0.0))
    ok = nh >= 1
    t = t.withColumn("f_drift", F.when(hist, step).otherwise(ahead))
    return t.select(*keys, order_col, value, (hist & ok).alias("is_history"),
                    F.when(ok, "ok").otherwise("too_short").alias("status"),
                    *[F.when(ok, F.col(f"f_{name}")).alias(f"f_{name}") for _, name, _ in SQL_FORECASTERS])


def _tail_error(name: str, value: str) -> Column:
    return F.when(~F.col("is_history"), F.pow(F.col(value) - F.col(f"f_{name}"), F.lit(2)))


def sql_forecaster_losses(df: DataFrame, keys, horizon: int,
                          value: str = "demand", order_col: str = "wk", digits: int = 6) -> DataFrame:
    """(keys, cand_id, loss, status): mean squared tail error of each SQL
    forecaster; every series is there, too short ones with a null loss."""
    rows = forecasts(df, keys, horizon, value, order_col)
    per_series = rows.groupBy(*keys).agg(
        F.max("status").alias("status"),
        *[F.avg(_tail_error(name, value)).alias(f"l{cid}") for cid, name, _ in SQL_FORECASTERS])
    long = F.array(*[F.struct(F.lit(cid).alias("cand_id"), F.col(f"l{cid}").alias("loss")) for cid, _, _ in SQL_FORECASTERS])
    return per_series.select(*keys, "status", F.inline(long)).withColumn("loss", F.round("loss", digits))


def forecast_best(df: DataFrame, keys, horizon: int, value: str = "demand", order_col: str = "wk",
                  digits: int = 6) -> DataFrame:
    """Fitted history and forecast tail of each series by its best forecaster
    (smallest tail error, ties by id), with the loss.  The choice is a window
    over the same partitioning as the forecasts: no join, no second exchange."""
    by = Window.partitionBy(*keys)
    rows = forecasts(df, keys, horizon, value, order_col)
    losses = F.array(*[F.struct(finite_or_inf(F.round(F.avg(_tail_error(name, value)).over(by), digits)).alias("loss"),
                                F.lit(cid).alias("cand_id")) for cid, name, _ in SQL_FORECASTERS])
    best = F.when(F.col("status") == "ok", F.array_min("_losses"))
    rows = rows.withColumn("_losses", losses).withColumn("_best", best)
    fitted = F.lit(None).cast("double")
    for cid, name, _ in SQL_FORECASTERS:
        fitted = F.when(F.col("_best.cand_id") == cid, F.col(f"f_{name}")).otherwise(fitted)
    return rows.select(*keys, order_col, value, "is_history", "status", F.col("_best.cand_id").alias("cand_id"),
                       F.col("_best.loss").alias("loss"), F.round(fitted, digits).alias("demand_fitted"))
