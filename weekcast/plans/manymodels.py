"""Train one regressor per device, index the models as a table, score rows.

Rows never leave the JVM: training is a grouped aggregate (partial
aggregation, so a device with a third of all rows is no hotter than any
other), scoring is an equi-join to the one-row-per-device model table plus a
linear expression.  The model itself is solved by column expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.operators import models
from weekcast.session import scratch_path

DEVICE = "device_id"
ALL_FEATURES = ["feature_1", "feature_2", "feature_3"]


def model_index(rows: DataFrame, run_id: str) -> DataFrame:
    """device_id, n_used, slope, intercept, r2, mse, run_id (one-feature OLS)."""
    return models.fit_ols_one(rows, DEVICE, "feature_1", "label").withColumn("run_id", F.lit(run_id))


def model_index_multi(rows: DataFrame, run_id: str) -> DataFrame:
    """Same per device with all three features (moments, solved by column expressions)."""
    return models.fit_ols(rows, DEVICE, ALL_FEATURES, "label").withColumn("run_id", F.lit(run_id))


def many_model_score(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Every row with its own device's three-feature model (``model_index_multi``)."""
    return models.score(rows, index, DEVICE, ALL_FEATURES)


def routed_score(spark: SparkSession, rows: DataFrame, index: DataFrame,
                 drop_device: int | None = 0) -> DataFrame:
    """Score through a saved model bundle; ``drop_device`` is left out of the
    bundle on purpose to show the missing-model path (null prediction).  The
    bundle is the only copy of the model table that is written."""
    if drop_device is not None:
        index = index.filter(F.col(DEVICE) != F.lit(drop_device))
    path = scratch_path(spark, "model_bundle", unique=True)
    models.save_model_table(index, path)
    return models.score(rows, models.load_model_table(spark, path), DEVICE, ALL_FEATURES)
