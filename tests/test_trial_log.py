"""The logged trials are those of the tuned forest."""

from tests.conftest import SF_SMALL
from weekcast import queries
from weekcast.plans import tuning


def test_all_trials_are_logged(spark):
    got = queries.trial_log(spark, SF_SMALL).where("stage is not null").collect()
    assert {int(r["max_depth"]) for r in got} == {depth for depth, _ in tuning.TRIALS}


def test_logged_trials_run_over_many_tasks(spark, monkeypatch):
    parts, keep = [], tuning.checkpoint
    monkeypatch.setattr(tuning, "TASK_ROWS", 20)
    monkeypatch.setattr(tuning, "checkpoint", lambda df: parts.append((got := keep(df)).rdd.getNumPartitions()) or got)
    assert queries.trial_log(spark, SF_SMALL).count() == len(tuning.TRIALS) + 1
    assert len(parts) == 3 and min(parts) > 1
