"""Standing inputs derived from the given tables.

``weekly``   lineitem x part -> (product=p_type, sku=p_brand, wk, demand)
``sparse``   lineitem -> (s_key=l_suppkey, wk, demand): series with missing weeks
``devrows``  lineitem rows as labelled device rows (device = l_suppkey % 10)
``listing``  part as a priced listing (strings + numbers + label ``price``)
``runlog``   events read as a run log (run_id, end_time, tags, metric)

Plans are written so that a hot key (one part, one supplier, one device
holding a third of the rows) never lands in a single task unaggregated:
grouping is always partial (map-side) first, and the only big join
(lineitem x part) is an equi-join that AQE splits when skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.functions.calendar import monday
from weekcast.sources.tables import read_table

ROW_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
SERIES_KEY = ["product", "sku"]
N_DEVICES = 10


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly demand per (product, sku): sum of shipped quantity per Monday.

    Join first, aggregate after: the aggregate has few groups
    (series x weeks), so its partial aggregation collapses the join output
    before the only remaining exchange.  ``part`` is broadcast by Catalyst only
    when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``;
    otherwise it is a sort-merge join that AQE splits on skewed part keys.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_quantity", "l_shipdate"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type", "p_brand"])
    return weekly_of(li, part)


def weekly_of(li: DataFrame, part: DataFrame) -> DataFrame:
    """Weekly demand of some shipments; see ``weekly``."""
    return (
        li.join(part, li.l_partkey == part.p_partkey)
        .groupBy(F.col("p_type").alias("product"), F.col("p_brand").alias("sku"),
                 monday("l_shipdate").alias("wk"))
        .agg(F.sum("l_quantity").alias("demand"))
    )


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly demand per supplier; suppliers miss some weeks (gaps)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_suppkey", "l_quantity", "l_shipdate"])
    return (li.groupBy(F.col("l_suppkey").alias("s_key"), monday("l_shipdate").alias("wk"))
            .agg(F.sum("l_quantity").alias("demand")))


def devrows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem rows as labelled device rows; the 5-column row key is unique."""
    li = read_table(spark, sf_dir, "lineitem",
                    ROW_KEY + ["l_quantity", "l_discount", "l_tax", "l_extendedprice"])
    return li.select(
        *ROW_KEY,
        (F.col("l_suppkey") % N_DEVICES).alias("device_id"),
        F.col("l_quantity").alias("feature_1"),
        F.col("l_discount").alias("feature_2"),
        F.col("l_tax").alias("feature_3"),
        F.col("l_extendedprice").alias("label"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part rows as a listing: key, two string columns, one double, label price."""
    part = read_table(spark, sf_dir, "part",
                      ["p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"])
    return part.select(
        "p_partkey", "p_brand", "p_type",
        F.col("p_size").cast("double").alias("p_size"),
        F.col("p_retailprice").alias("price"),
    )


def device_tag(event_type, user_id):
    """Run-log ``device`` tag: user_id % 10 as text, absent for error runs."""
    return F.when(event_type == "error", F.lit(None).cast("string")).otherwise(
        (user_id % N_DEVICES).cast("string"))


def runlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a run log with MAP tags and a metric."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return ev.select(
        F.col("event_id").alias("run_id"),
        F.col("ts").alias("end_time"),
        F.create_map(F.lit("device"), device_tag(F.col("event_type"), F.col("user_id"))).alias("tags"),
        F.col("value").alias("metric"),
    )


def data_calendar_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: first and last Monday with any shipment (drives the calendar)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_shipdate"])
    return li.agg(monday(F.min("l_shipdate")).alias("first_wk"),
                  monday(F.max("l_shipdate")).alias("last_wk"))
