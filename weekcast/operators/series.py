"""Ordered-series operators on long-format series tables.

A series is the set of rows sharing ``keys`` ordered by the week column.  Its
length is bounded by the calendar (one row per week), never by the data
volume, so windows partitioned by the series key and one-row-per-series
packing are safe however many rows the source tables hold.

All windows here use the same ``partitionBy(keys)`` so that a chain of them
costs one exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekcast.functions.calendar import weekly_sequence


def _ordered(keys, order_col: str):
    return Window.partitionBy(*keys).orderBy(order_col)


def with_position(df: DataFrame, keys, order_col: str = "wk", name: str = "pos") -> DataFrame:
    """Zero-based position of each row inside its series."""
    return df.withColumn(name, F.row_number().over(_ordered(keys, order_col)) - 1)


def tail_split(df: DataFrame, keys, horizon: int, order_col: str = "wk") -> DataFrame:
    """Flag the last ``horizon`` rows of every series as not history.

    ``is_history = rn <= n - horizon``; both window functions share one
    partitioning so the plan has a single exchange.
    """
    w_all = Window.partitionBy(*keys)
    return (df.withColumn("_rn", F.row_number().over(_ordered(keys, order_col)))
              .withColumn("_n", F.count(F.lit(1)).over(w_all))
              .withColumn("is_history", F.col("_rn") <= F.col("_n") - F.lit(horizon))
              .drop("_rn", "_n"))


def bounds(df: DataFrame, keys, event_date, order_col: str = "wk") -> DataFrame:
    """First/last week, length, and first week on/after the event per series."""
    wk = F.col(order_col)
    return df.groupBy(*keys).agg(
        F.min(wk).alias("first_wk"), F.max(wk).alias("last_wk"),
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(wk >= F.lit(event_date), wk)).alias("first_after_event"),
    )


def differences(df: DataFrame, keys, value: str = "demand", order_col: str = "wk") -> DataFrame:
    """First and second differences; the first one/two rows stay null."""
    w = _ordered(keys, order_col)
    y, l1, l2 = F.col(value), F.lag(value, 1).over(w), F.lag(value, 2).over(w)
    return df.select(*df.columns, (y - l1).alias("d1"), (y - F.lit(2) * l1 + l2).alias("d2"))


def lags(df: DataFrame, keys, max_lag: int, value: str = "demand", order_col: str = "wk") -> DataFrame:
    """Autoregressive inputs lag1..lag{max_lag} (null where the series is too short)."""
    w = _ordered(keys, order_col)
    return df.select(*df.columns, *[F.lag(value, k).over(w).alias(f"lag{k}")
                                    for k in range(1, max_lag + 1)])


def pack(df: DataFrame, keys, order_col: str, value_cols, name: str = "pts") -> DataFrame:
    """One row per series: ``name`` = ARRAY<STRUCT<order_col, values...>> sorted by order_col.

    ``collect_list`` is bounded by the series length (weeks), not by data size.
    """
    fields = [order_col] + list(value_cols)
    return df.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def unpack(df: DataFrame, name: str = "pts") -> DataFrame:
    """Inverse of :func:`pack`: one row per array element."""
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.inline(F.col(name)))


def regularise(df: DataFrame, keys, value: str = "demand", order_col: str = "wk",
               fill: str = "null") -> DataFrame:
    """Insert every missing week between a series' first and last week.

    One pass: each observed week looks ahead to the next observed week of its
    series (``lead``) and emits itself plus the missing weeks in between.
    Linear in the output, one exchange on the series key, no join back to
    the input (which would scan the source twice).
    ``fill``: ``null`` (keep gaps null), ``zero``, or ``ffill``.
    """
    if fill not in ("null", "zero", "ffill"):
        raise ValueError(f"unknown fill policy {fill!r}")
    w = _ordered(keys, order_col)
    wk = F.col("_obs_wk")
    ahead = df.select(*keys, F.col(order_col).alias("_obs_wk"), F.col(value).alias("_obs"),
                      F.lead(order_col).over(w).alias("_next"))
    # greatest(): a repeated week (unaggregated input) yields just itself
    last_in_gap = F.greatest(F.coalesce(F.date_sub(F.col("_next"), 7), wk), wk)
    rows = ahead.select(*keys, "_obs_wk", "_obs",
                        F.explode(weekly_sequence(wk, last_in_gap)).alias(order_col))
    observed = F.col(order_col) == F.col("_obs_wk")
    filled = {"null": F.when(observed, F.col("_obs")),
              "zero": F.when(observed, F.col("_obs")).otherwise(F.lit(0.0)),
              "ffill": F.col("_obs")}[fill]
    return rows.select(*keys, order_col, filled.alias(value))


def packed_stats(packed: DataFrame, keys, name: str = "pts", value: str = "demand") -> DataFrame:
    """Read length, first, last and sum back from a packed array (proves order)."""
    arr = F.col(name)
    return packed.select(
        *keys,
        F.size(arr).cast("bigint").alias("n"),
        arr.getItem(0)[value].alias("first_demand"),
        F.element_at(arr, -1)[value].alias("last_demand"),
        F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x[value]).alias("sum_demand"),
    )

