"""Fits of forests keep each row's node between the levels, and only few large ones run side by side."""

import pytest

from tests.conftest import SF_SMALL
from weekcast.plans import tuning
from weekcast.sources import inputs


def test_nodes_are_kept_and_the_forest_is_the_same(spark):
    rows = inputs.listing(spark, SF_SMALL)
    step = tuning.FeatureStep(rows)
    fit_on = tuning.checkpoint(step.fittable(rows))
    forest = step.forest(depth=4, trees=6)
    assert forest.getCacheNodeIds()
    kept, walked = (forest.copy({forest.cacheNodeIds: c}).fit(fit_on).toDebugString.split("\n", 1)[1] for c in (True, False))
    assert kept == walked and "Tree 5" in kept


@pytest.mark.parametrize("fit_rows, at_once", [(3_000_000, 2), (1, 1)])
def test_fits_side_by_side_are_bounded_by_their_rows(spark, monkeypatch, fit_rows, at_once):
    asked, pool = [], tuning.ThreadPoolExecutor
    monkeypatch.setattr(tuning, "FIT_ROWS", fit_rows, raising=False)
    monkeypatch.setattr(tuning, "ThreadPoolExecutor", lambda max_workers: asked.append(max_workers) or pool(max_workers))
    got = tuning.rf_tuned(spark, inputs.listing(spark, SF_SMALL), trials=((2, 3), (3, 5))).collect()
    assert asked == [at_once] and [r["stage"] for r in got] == ["trial", "trial", "final"]
