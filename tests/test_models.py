"""Many models: per-group OLS against numpy, missing-model path, routing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekcast.operators import models
from weekcast.plans import manymodels


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    data = []
    for g in range(3):
        X = rng.normal(size=(200, 3))
        y = 1.0 + g + X @ np.array([2.0, -1.0, 0.5 * g]) + rng.normal(scale=0.1, size=200)
        data += [(g, *map(float, x), float(t)) for x, t in zip(X, y)]
    return spark.createDataFrame(data, "device_id int, feature_1 double, feature_2 double, feature_3 double, label double").repartition(4), data


def test_ols_k_features_matches_numpy(rows):
    df, data = rows
    got = {r["device_id"]: r for r in models.fit_ols(df, "device_id", ["feature_1", "feature_2", "feature_3"], "label").collect()}
    for g in range(3):
        sub = np.array([d[1:] for d in data if d[0] == g])
        A = np.column_stack([np.ones(len(sub)), sub[:, :3]])
        coef, *_ = np.linalg.lstsq(A, sub[:, 3], rcond=None)
        assert got[g]["intercept"] == pytest.approx(coef[0], abs=1e-8)
        assert got[g]["coef"] == pytest.approx(list(coef[1:]), abs=1e-8)
        resid = sub[:, 3] - A @ coef
        assert got[g]["mse"] == pytest.approx(np.mean(resid ** 2), rel=1e-6)
        assert got[g]["n_used"] == 200


def test_ols_one_feature_matches_numpy(rows):
    df, data = rows
    got = {r["device_id"]: r for r in models.fit_ols_one(df, "device_id", "feature_1", "label").collect()}
    for g in range(3):
        sub = np.array([(d[1], d[4]) for d in data if d[0] == g])
        slope, icpt = np.polyfit(sub[:, 0], sub[:, 1], 1)
        assert got[g]["slope"] == pytest.approx(slope, rel=1e-9)
        assert got[g]["intercept"] == pytest.approx(icpt, rel=1e-9)
        resid = sub[:, 1] - (icpt + slope * sub[:, 0])
        assert got[g]["mse"] == pytest.approx(np.mean(resid ** 2), rel=1e-9)


def test_missing_model_gives_null_prediction(rows, spark):
    df, _ = rows
    index = manymodels.model_index_multi(df, "r")
    scored = manymodels.routed_score(spark, df, index, drop_device=1)
    by = {r["device_id"]: r for r in scored.groupBy("device_id").agg(
        F.count(F.col("prediction")).alias("n_pred"), F.max(F.col("has_model").cast("int")).alias("hm")).collect()}
    assert by[1]["n_pred"] == 0 and by[1]["hm"] == 0
    assert by[0]["n_pred"] == 200 and by[0]["hm"] == 1
    assert scored.count() == df.count()


@pytest.fixture(scope="module")
def odd(spark):
    """Device 0 constant, 1 one row, 2 clean, 3 clean plus rows with a null, 4 collinear, 5 nulls only."""
    rng = np.random.default_rng(1)
    data = [(0, 2.0, 1.0, 1.0, float(y)) for y in range(5)] + [(1, 1.0, 2.0, 3.0, 4.0)]
    for g in (2, 3):
        for x in rng.normal(size=(20, 3)):
            data.append((g, *map(float, x), float(5 + 2 * x[0] - x[1] + 0.5 * x[2])))
    data += [(3, None, 1.0, 1.0, 1e6), (3, 50.0, 1.0, 1.0, None), (3, 1.0, float("nan"), 1.0, 9.0)]
    data += [(4, float(i), 2.0 * i, float(i % 3), float(i)) for i in range(12)] + [(5, None, None, None, 1.0)]
    return spark.createDataFrame(data, "device_id int, feature_1 double, feature_2 double, feature_3 double, label double")


def test_constant_and_single_rows_give_null_models(odd):
    one = {r["device_id"]: r for r in models.fit_ols_one(odd, "device_id", "feature_1", "label").collect()}
    assert one[0]["slope"] is None and one[0]["mse"] is None and one[1]["slope"] is None and one[0]["n_used"] == 5
    many = {r["device_id"]: r for r in models.fit_ols(odd, "device_id", ["feature_1", "feature_2", "feature_3"], "label").collect()}
    for g in (0, 1, 4):
        assert many[g]["intercept"] is None and many[g]["mse"] is None and many[g]["coef"] == [None] * 3
    assert 5 not in many and 5 not in one


def test_rows_with_nulls_do_not_bend_the_fit(odd):
    many = {r["device_id"]: r for r in models.fit_ols(odd, "device_id", ["feature_1", "feature_2", "feature_3"], "label").collect()}
    assert many[3]["n_used"] == 20 and many[3]["coef"] == pytest.approx([2.0, -1.0, 0.5], abs=1e-9)
    assert many[3]["mse"] == pytest.approx(0, abs=1e-9)
    one = {r["device_id"]: r for r in models.fit_ols_one(odd, "device_id", "feature_1", "label").collect()}
    assert one[3]["n_used"] == 21 and one[3]["mse"] < 30


def test_null_model_is_a_model(odd, spark):
    scored = manymodels.many_model_score(odd, models.fit_ols(odd, "device_id", manymodels.ALL_FEATURES, "label"))
    by = {r["device_id"]: (r["p"], r["m"]) for r in scored.groupBy("device_id").agg(
        F.count("prediction").alias("p"), F.max("has_model").alias("m")).collect()}
    assert by[0] == (0, True) and by[5] == (0, False) and by[2] == (20, True) and by[3][1]
