"""Autoregressive moving-average models of every series at once, by two stages of least squares.

Each series is one row with its values packed in order, bounded by the weeks of the calendar.  A long
autoregression gives first residuals; then every order (p, q) is a regression on p values and q residuals
before.  Normal equations are sums over the array, solved by elimination in array expressions; residuals
and forecasts are folds over the array.  Series and orders are rows: no Python, no loop over either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.operators.models import solve_array

#: Lags of the long autoregression, the orders tried, what is added to the squares of the
#: normal equations, and the fewest weeks of history beyond the long lags.
LONG = 4
_P, _Q = 2, 1
ORDERS = tuple((p, q) for p in range(_P + 1) for q in range(_Q + 1))
RIDGE = 1e-6
LEAST = 20


def _normal(rows: str, k: int):
    """k x (k + 1) normal equations of an array of design rows (k regressors, then the value): one fold
    over the rows, which are evaluated once."""
    start = ", ".join("array(" + ", ".join(f"{RIDGE!r}D" if i == j else "0.0D" for j in range(k + 1)) + ")" for i in range(k))
    return F.expr(f"aggregate({rows}, array({start}), (m, r) -> "
                  "transform(m, (row, i) -> transform(row, (v, j) -> v + r[i] * r[j])))")


def _lag(array: str, t: str, k: int) -> str:
    return f"coalesce(get({array}, {t} - {k}), 0.0D)"


def fits(df: DataFrame, keys, horizon: int, value: str = "demand", order_col: str = "wk") -> DataFrame:
    """One row per series and order: (keys, p, q, status, wks, y, nh, mean, fitted).

    ``fitted`` holds, on the scale of the values, the one-step fit of the history and the forecasts of the last
    ``horizon`` weeks, in which unknown residuals are 0.  A series with too little history keeps its
    rows, with status ``too_short`` and null fits; so does an order whose fit is not stationary and invertible
    (``unstable``).  The order (0, 0) always has a fit.  Input must be regular; one exchange on the series key.
    """
    pts = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order_col, value))).alias("_pts"))
    s = pts.select(*keys, F.expr(f"_pts.{order_col}").alias("wks"), F.expr(f"transform(_pts.{value}, v -> cast(v as double))").alias("y"))
    s = s.withColumn("nh", F.size("y") - F.lit(horizon)).withColumn(
        "status", F.when(F.col("nh") >= LONG + LEAST, "ok").otherwise("too_short"))
    # short series are cut out of the array work by an empty history
    s = s.withColumn("nh", F.when(F.col("status") == "ok", F.col("nh")).otherwise(F.lit(0)))
    s = s.withColumn("mean", F.expr("IF(nh > 0, aggregate(slice(y, 1, nh), 0.0D, (a, v) -> a + v) / nh, NULL)"))
    s = s.withColumn("z", F.expr("IF(nh > 0, transform(y, v -> v - mean), array())"))
    lags = ", ".join(f"z[t - {k}]" for k in range(1, LONG + 1))
    s = s.withColumn("d", F.expr(f"IF(nh > 0, transform(sequence({LONG}, nh - 1), t -> array({lags}, z[t])), array())"))
    s = s.withColumn("m", _normal("d", LONG)).withColumn("a", solve_array(F.col("m")))
    guess = " - ".join(f"a[{k - 1}] * z[t - {k}]" for k in range(1, LONG + 1))
    s = s.withColumn("e", F.expr(f"IF(nh > 0, transform(sequence(0, nh - 1), t -> IF(t < {LONG}, 0.0D, z[t] - {guess})), array())"))
    order = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in ORDERS]))
    s = s.select(*keys, "wks", "y", "nh", "status", "mean", "z", "e", order.alias("o")).select("*", "o.p", "o.q").drop("o")
    # regressors beyond the order are 0 and get the coefficient 0
    own = [f"IF(p >= {k}, z[t - {k}], 0.0D)" for k in range(1, _P + 1)] + [f"IF(q >= {k}, e[t - {k}], 0.0D)" for k in range(1, _Q + 1)]
    first = LONG + _Q
    s = s.withColumn("d", F.expr(f"IF(nh > 0, transform(sequence({first}, nh - 1), t -> array({', '.join(own)}, z[t])), array())"))
    s = s.withColumn("m", _normal("d", _P + _Q)).withColumn("b", solve_array(F.col("m")))
    # a fit whose autoregression grows or whose residuals cannot be recovered has no forecast
    stable = "abs(b[2]) < 1 AND abs(b[1]) < 1 AND b[1] + b[0] < 1 AND b[1] - b[0] < 1"
    s = s.withColumn("status", F.expr(f"IF(nh = 0 OR ({stable}), status, 'unstable')")) \
        .withColumn("nh", F.expr("IF(status = 'unstable', 0, nh)"))
    ar = " + ".join(f"b[{k - 1}] * {_lag('z', 't', k)}" for k in range(1, _P + 1))
    ma = " + ".join(f"b[{_P + k - 1}] * {_lag('r', 't', k)}" for k in range(1, _Q + 1))
    s = s.withColumn("r", F.expr(f"IF(nh > 0, aggregate(sequence(0, nh - 1), cast(array() AS array<double>), (r, t) -> "
                                 f"array_append(r, z[t] - ({ar}) - ({ma}))), array())"))
    ahead = ar.replace("get(z,", "get(h,")
    s = s.withColumn("h", F.expr(f"IF(nh > 0, aggregate(sequence(nh, size(y) - 1), slice(z, 1, nh), (h, t) -> "
                                 f"array_append(h, ({ahead}) + ({ma}))), array())"))
    fitted = F.expr("IF(nh > 0, transform(concat(zip_with(slice(z, 1, nh), r, (v, e) -> v - e), slice(h, nh + 1, size(y) - nh)), "
                    "v -> v + mean), NULL)")
    return s.select(*keys, "p", "q", "status", "wks", "y", "nh", fitted.alias("fitted"))


def mean_error(first: str, weeks: str):
    """Mean squared error of ``fitted`` over some weeks from the ``first`` (1-based) on."""
    pairs = f"zip_with(slice(y, {first}, {weeks}), slice(fitted, {first}, {weeks}), (v, f) -> pow(v - f, 2))"
    return F.expr(f"aggregate({pairs}, 0.0D, (a, e) -> a + e) / ({weeks})")


def losses(df: DataFrame, keys, horizon: int, value: str = "demand", order_col: str = "wk", digits: int = 4) -> DataFrame:
    """(keys, p, q, status, loss): mean squared error of each order over the last ``horizon`` weeks."""
    error = mean_error("nh + 1", str(horizon))
    return fits(df, keys, horizon, value, order_col).select(
        *keys, "p", "q", "status", F.round(F.when(F.col("status") == "ok", error), digits).alias("loss"))


def forecast(df: DataFrame, keys, horizon: int, value: str = "demand", order_col: str = "wk", digits: int = 4) -> DataFrame:
    """Fitted history and forecast tail of each series by the order of smallest loss, ties by (p, q)."""
    error = mean_error("nh + 1", str(horizon))
    rows = fits(df, keys, horizon, value, order_col).withColumn(
        "loss", F.coalesce(F.round(F.when(F.col("status") == "ok", error), digits), F.lit(float("inf"))))
    best = rows.groupBy(*keys).agg(F.min_by(F.struct("p", "q", "status", "wks", "y", "nh", "fitted"),
                                            F.struct("loss", "p", "q")).alias("b")).select(*keys, "b.*")
    ok = F.col("status") == "ok"
    points = F.expr("transform(wks, (w, t) -> struct(w AS w, y[t] AS v, t < nh AS is_history, get(fitted, t) AS f))")
    return best.select(*keys, "status", F.when(ok, F.col("p")).alias("p"), F.when(ok, F.col("q")).alias("q"), F.inline(points)) \
        .select(*keys, F.col("w").alias(order_col), F.col("v").alias(value), "is_history", "status", "p", "q",
                F.round("f", digits).alias(f"{value}_fitted"))
