"""A key holding a third of all rows: results stay exact and the plans combine
map-side before the exchange (no task ever holds the hot group's raw rows)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekcast.operators import models
from weekcast.plans import runlog


@pytest.fixture(scope="module")
def hot(spark):
    n = 30000
    ids = spark.range(0, n, numPartitions=6)
    # device 0 owns a third of the rows, the rest spread over 1..9
    dev = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 9 + 1)
    x = (F.col("id") % 97).cast("double")
    return ids.select("id", dev.alias("device_id"), x.alias("feature_1"),
                      (F.lit(3.0) + F.lit(2.0) * x + (F.col("id") % 5).cast("double")).alias("label"))


def _plan(df):
    df.collect()  # run this DataFrame's own plan so AQE finalises it
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_device_model_exact_and_partial(spark, hot):
    m = models.fit_ols_one(hot, "device_id", "feature_1", "label")
    got = {r["device_id"]: r for r in m.collect()}
    pdf = hot.toPandas()
    sub = pdf[pdf.device_id == 0]
    slope, icpt = np.polyfit(sub.feature_1, sub.label, 1)
    assert got[0]["n_used"] == len(sub) == 10000
    assert got[0]["slope"] == pytest.approx(slope, rel=1e-9)
    assert got[0]["intercept"] == pytest.approx(icpt, rel=1e-9)
    p = _plan(m)
    assert "partial_regr_slope" in p or "partial_covar_pop" in p or "partial_" in p
    assert "Window" not in p


def test_hot_device_latest_run_without_window(spark, hot):
    log = hot.select(F.col("id").alias("run_id"),
                     F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("end_time"),
                     F.create_map(F.lit("device"), F.col("device_id").cast("string")).alias("tags"),
                     F.col("label").alias("metric"))
    latest = runlog.latest_per_device(log)
    got = {r["device"]: r["run_id"] for r in latest.collect()}
    # ids with id % 3 != 0 reach six devices (id % 9 in {1,2,4,5,7,8}), plus the hot device 0
    assert got["0"] == 29997 and len(got) == 7
    p = _plan(latest)
    assert "partial_max_by" in p and "Window" not in p


def test_weekly_join_splits_hot_part_key(spark):
    """One part key holds a third of lineitem: with part too big to broadcast
    (threshold off) AQE's skew join splits the hot partition; results exact."""
    import datetime as dt
    from weekcast.session import scratch_path
    from weekcast.sources import inputs

    d = scratch_path(spark, "skewed_tables", unique=True)
    n = 60000
    li = spark.range(0, n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997 + 100).alias("l_partkey"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        F.timestamp_seconds(F.lit(946684800) + (F.col("id") % 700) * 86400).cast("timestamp_ntz").alias("l_shipdate"))
    part = spark.range(0, 1200).select(F.col("id").alias("p_partkey"),
                                       F.concat(F.lit("T"), (F.col("id") % 6).cast("string")).alias("p_type"),
                                       F.concat(F.lit("B"), (F.col("id") % 25).cast("string")).alias("p_brand"))
    li.write.parquet(f"{d}/lineitem.parquet")
    part.write.parquet(f"{d}/part.parquet")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            # split target = max(advisory size, median): scale it down with the data
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        w = inputs.weekly(spark, d)
        got = sorted(map(tuple, w.collect()))
        plan = w._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    lp = spark.read.parquet(f"{d}/lineitem.parquet").join(
        spark.read.parquet(f"{d}/part.parquet"), F.col("l_partkey") == F.col("p_partkey"))
    want = sorted(map(tuple, lp.groupBy(
        F.col("p_type").alias("product"), F.col("p_brand").alias("sku"),
        F.date_sub(F.to_date("l_shipdate"), F.weekday(F.to_date("l_shipdate"))).alias("wk"))
        .agg(F.sum("l_quantity").alias("demand")).collect()))
    assert got == want
    assert "SortMergeJoin" in plan and "skew=true" in plan


def test_scoring_join_splits_hot_device(spark, hot):
    """Left join of rows to a model table that is not broadcast: the hot
    device's rows are salted over many join keys and every row keeps its
    prediction."""
    m = models.fit_ols_one(hot, "device_id", "feature_1", "label") \
        .select("device_id", F.array("slope").alias("coef"), "intercept", "n_used")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # broadcast_max_rows=0: take the path of a model table too big to broadcast
        scored = models.score(hot, m, "device_id", ["feature_1"], broadcast_max_rows=0,
                              hot_fraction=0.2, rows_per_salt=600)
        plain = models.score(hot, m, "device_id", ["feature_1"])
        got = sorted((r["id"], r["prediction"]) for r in scored.select("id", "prediction").collect())
        want = sorted((r["id"], r["prediction"]) for r in plain.select("id", "prediction").collect())
        # rows of the hot device (a third) per task of the salted join
        per_task = (scored.filter(F.col("device_id") == 0)
                    .groupBy(F.spark_partition_id().alias("t")).count().collect())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == want and len(got) == 30000 and all(p is not None for _, p in got)
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 10000
