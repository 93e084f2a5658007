"""Calendar, event features and demand shaping (all column expressions).

The calendar is derived from the data (first to last Monday with a shipment),
so its size grows only with the time span, never with the row count.  Global
bounds come from a two-value aggregate of the weekly table and enter as
literals: no join, no cross join, no single-partition window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.functions import calendar as cal
from weekcast.sources import inputs, sinks

KEYS = inputs.SERIES_KEY
WEEKLY_SCHEMA = "product string, sku string, wk date, demand double, year int"


def calendar_from_bounds(bounds: DataFrame) -> DataFrame:
    """Every Monday between the bounds row's ``first_wk`` and ``last_wk``."""
    return bounds.select(F.explode(cal.weekly_sequence(F.col("first_wk"), F.col("last_wk"))).alias("wk"),
                         "first_wk", "last_wk")


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_from_bounds(inputs.data_calendar_bounds(spark, sf_dir)).select("wk")


def factors(wk, last_wk, event: dt.date) -> dict:
    """Calendar factor columns of a week given the calendar's last week."""
    counter = cal.weeks_since_event(wk, event)
    max_counter = cal.weeks_since_event(last_wk, event)
    week = cal.iso_week(wk)
    return {"iso_week": week, "counter": counter,
            "shock_factor": cal.shock_factor(counter, max_counter),
            "season_factor": cal.season_factor(week)}


def calendar_factors(spark: SparkSession, sf_dir: str, event: dt.date = cal.TEST_EVENT,
                     digits: int = 6) -> DataFrame:
    c = calendar_from_bounds(inputs.data_calendar_bounds(spark, sf_dir))
    f = factors(F.col("wk"), F.col("last_wk"), event)
    return c.select("wk", f["iso_week"].alias("iso_week"), f["counter"].alias("counter"),
                    F.round(f["shock_factor"], digits).alias("shock_factor"),
                    f["season_factor"].alias("season_factor"))


def reference_calendar_factors(spark: SparkSession, digits: int = 6) -> DataFrame:
    """The given 157-week calendar (unit-test fixture, not a query)."""
    first, last = cal.reference_calendar_bounds()
    bounds = spark.range(1).select(F.lit(first).alias("first_wk"), F.lit(last).alias("last_wk"))
    c = calendar_from_bounds(bounds)
    f = factors(F.col("wk"), F.col("last_wk"), cal.REFERENCE_EVENT)
    return c.select("wk", cal.week_index(F.col("wk"), F.col("first_wk")).alias("pos"),
                    f["iso_week"].alias("iso_week"), f["counter"].alias("counter"),
                    F.round(f["shock_factor"], digits).alias("shock_factor"),
                    f["season_factor"].alias("season_factor"))


def _bounds(weekly: DataFrame):
    """First and last week of the weekly table as literals, from one two-value
    aggregate.

    ``weekly`` must be materialised (a checkpoint): the bounds then read the
    small weekly table, not lineitem.  Inlining the single row lets Catalyst
    fold every calendar factor to constants per week.
    """
    row = weekly.agg(F.min("wk").alias("first_wk"), F.max("wk").alias("last_wk")).first()
    return F.lit(row["first_wk"]).cast("date"), F.lit(row["last_wk"]).cast("date")


def exo_features(weekly: DataFrame, event: dt.date = cal.TEST_EVENT) -> DataFrame:
    """Row-wise event/season flags: no grouping, no Python, filters still push."""
    return weekly.select("wk", *KEYS, "demand",
                         *[c.alias(n) for n, c in cal.exo_columns(F.col("wk"), event).items()])


def weeks_since_event(weekly: DataFrame, event: dt.date = cal.TEST_EVENT) -> DataFrame:
    return weekly.select(*KEYS, "wk", cal.weeks_since_event(F.col("wk"), event).alias("counter"))


def series_calendar(weekly: DataFrame) -> DataFrame:
    """Every series paired with every calendar week (generator, not a join).
    ``weekly`` is materialised by the caller."""
    first, last = _bounds(weekly)
    return weekly.select(*KEYS).distinct().select(
        *KEYS, F.explode(cal.weekly_sequence(first, last)).alias("wk"))


def adjusted_demand(weekly: DataFrame, event: dt.date = cal.TEST_EVENT) -> DataFrame:
    """Demand shaping chain: x shock -> + 100*sqrt(pos) before the event ->
    x season -> round.  ``pos`` is the week's position in the calendar;
    ``weekly`` is materialised by the caller."""
    first, last = _bounds(weekly)
    wk = F.col("wk")
    f = factors(wk, last, event)
    pos = cal.week_index(wk, first)
    d = F.col("demand") * f["shock_factor"]
    d = F.when(f["counter"] == 0, d + F.lit(cal.TREND_FACTOR) * F.sqrt(pos)).otherwise(d)
    d = d * f["season_factor"]
    return weekly.select(*KEYS, "wk", F.round(d, 0).alias("demand"))


def refresh_weekly(li: DataFrame, part: DataFrame, path: str, since: int | None = None) -> DataFrame:
    """Bring the weekly table at ``path``, partitioned by the year of the Monday, up to date and read it.

    Only years from the stored table's last one on (or from ``since``, for late shipments) are read from ``li``, by a date
    filter that reaches the scan, and written; earlier years keep their files.  Without a table at ``path`` all
    years are built.  A year left without shipments keeps what it had; shipments without a date are in no week.
    """
    spark = li.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        # the year is the folder's name: no column is read for it
        last = spark.read.schema(WEEKLY_SCHEMA).parquet(path).agg(F.max("year")).first()[0]
        since = last if since is None else min(since, last or since)
    if since is not None:
        start = dt.date(since, 1, 1)
        li = li.where(F.col("l_shipdate") >= F.lit(start + dt.timedelta(-start.weekday() % 7)))
    rows = inputs.weekly_of(li, part).where("wk is not null").withColumn("year", F.year("wk"))
    sinks.overwrite_partitions(rows, path, "year")
    return spark.read.schema(WEEKLY_SCHEMA).parquet(path)
