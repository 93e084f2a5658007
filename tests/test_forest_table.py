"""A saved forest read as a table of nodes scores every row as the forest itself does."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor

from tests.conftest import SF_SMALL
from weekcast.operators.sampling import bucket_split
from weekcast.plans import tuning
from weekcast.session import scratch_path
from weekcast.sources import inputs


@pytest.fixture(scope="module")
def fitted(spark):
    """Twelve bagged trees with label splits and numeric splits, saved within a pipeline and loaded."""
    listing = inputs.listing(spark, SF_SMALL)
    train, _, _ = bucket_split(listing, tuning.KEY)
    step = tuning.FeatureStep(train)
    path = scratch_path(spark, "forest_test", unique=True)
    step.with_forest(step.forest(depth=4, trees=12).fit(step.indexed(train))).write().save(path)
    model = PipelineModel.load(path)
    return step, model.stages[-1], tuning.forest_nodes(spark, f"{path}/stages/*_{model.stages[-1].uid}", 4), listing


def test_every_row_scored_as_the_forest_does(fitted):
    step, forest, nodes, listing = fitted
    rows = step.indexed(listing)
    want = {r[tuning.KEY]: r["prediction"] for r in forest.transform(rows).collect()}
    got = {r[tuning.KEY]: r["prediction"] for r in tuning.walk_forest(rows, nodes, 4).collect()}
    assert len(want) > 100 and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(v, abs=1e-9) for k, v in want.items())


def test_nodes_are_whole_trees(fitted):
    _, forest, nodes, _ = fitted
    rows = nodes.collect()
    assert len(rows) == forest.totalNumNodes and len({(r["tree"], r["node"]) for r in rows}) == len(rows)
    at = {(r["tree"], r["node"]): r for r in rows}
    for (tree, node), r in at.items():
        children = [at.get((tree, 2 * node + i)) for i in (0, 1)]
        if r["feature"] is None:
            assert children == [None, None] and r["threshold"] is None and r["left"] is None
        else:
            assert r["n"] == sum(c["n"] for c in children)
            assert (r["threshold"] is None) != (r["left"] is None)


def test_plan_has_no_join_of_the_rows_and_no_python(fitted):
    step, _, nodes, listing = fitted
    plan = tuning.walk_forest(step.indexed(listing), nodes, 4)._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Join" not in main and "Exchange" not in main and "Python" not in plan


def test_one_leaf_no_rows_and_null_features(spark):
    same = spark.createDataFrame([(float(i), 7.0) for i in range(20)], "a double, price double")
    rows = VectorAssembler(inputCols=["a"], outputCol="features").transform(same)
    path = scratch_path(spark, "forest_test", unique=True)
    RandomForestRegressor(labelCol="price", numTrees=2, maxDepth=3, seed=1).fit(rows).write().save(path)
    nodes = tuning.forest_nodes(spark, path, 3)
    assert [(r["tree"], r["node"], r["feature"], r["value"]) for r in nodes.orderBy("tree").collect()] == [(0, 1, None, 7.0), (1, 1, None, 7.0)]
    assert {r["prediction"] for r in tuning.walk_forest(rows, nodes, 3).collect()} == {7.0}
    assert tuning.walk_forest(rows.limit(0), nodes, 3).count() == 0
    nothing = rows.selectExpr("a", "if(a < 5, null, features) AS features")
    assert tuning.walk_forest(nothing, nodes, 3).where("prediction IS NULL").count() == 5
    assert {r["prediction"] for r in tuning.walk_forest(rows, nodes.limit(0), 3).collect()} == {None}
