"""How often a series must be differenced before it is level-stationary, by the KPSS statistic.

Partial sums of the residuals around the mean are a window frame; the long-run variance takes lagged products
with Bartlett weights.  All windows and the final aggregate share the series key: one exchange for all series
and all orders, no Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekcast.operators import series

#: Highest order tried, lags of the long-run variance, fewest values of a difference, and
#: the statistic's critical value at 5 per cent.
MOST, LAGS, LEAST, CRITICAL = 2, 4, 20, 0.463


def difference_order(df: DataFrame, keys, value: str = "demand", order_col: str = "wk", digits: int = 6) -> DataFrame:
    """(keys, n, status, kpss0, kpss1, kpss2, d): the statistic of the series and its first and second
    differences, and the smallest order whose statistic is not above the critical value, ``MOST`` if all are.

    A difference without variance is stationary and has a null statistic.  A series with fewer than ``LEAST`` + ``MOST`` values is
    ``too_short``: no statistic, no order.  Input must be regular; null values are left out of sums and products.
    """
    by = Window.partitionBy(*keys)
    w = by.orderBy(order_col)
    t = series.differences(df.select(*keys, order_col, F.col(value).cast("double").alias("d0")), keys, "d0", order_col)
    for d in range(MOST + 1):
        t = t.withColumn(f"e{d}", F.col(f"d{d}") - F.avg(f"d{d}").over(by))
    t = t.select("*", *[F.sum(f"e{d}").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(f"s{d}") for d in range(MOST + 1)],
                 *[F.lag(f"e{d}", j).over(w).alias(f"e{d}l{j}") for d in range(MOST + 1) for j in range(1, LAGS + 1)])
    moments = []
    for d in range(MOST + 1):
        e = F.col(f"e{d}")
        run = F.sum(e * e)
        for j in range(1, LAGS + 1):
            run = run + F.lit(2 * (1 - j / (LAGS + 1))) * F.sum(e * F.col(f"e{d}l{j}"))
        moments += [F.count(e).alias(f"n{d}"), run.alias(f"v{d}"), F.sum(F.when(e.isNotNull(), F.pow(f"s{d}", F.lit(2)))).alias(f"q{d}")]
    got = t.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *moments)
    ok = F.col("n") >= LEAST + MOST
    stats = [F.when(ok & (F.col(f"v{d}") > 1e-6), F.round(F.col(f"q{d}") / F.col(f"n{d}") / F.col(f"v{d}"), digits)).alias(f"kpss{d}")
             for d in range(MOST + 1)]
    got = got.select(*keys, "n", F.when(ok, "ok").otherwise("too_short").alias("status"), *stats)
    order = F.lit(MOST)
    for d in range(MOST - 1, -1, -1):
        order = F.when(F.coalesce(F.col(f"kpss{d}"), F.lit(0.0)) <= CRITICAL, d).otherwise(order)
    return got.withColumn("d", F.when(F.col("status") == "ok", order))
