"""Rows of a forest are dealt over tasks by the rows alone, however few files they come from."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from weekcast.plans import tuning
from weekcast.sources import inputs


def _sizes(df):
    return df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()


def test_one_file_is_dealt_over_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(tuning, "TASK_ROWS", 20)
    rows = inputs.listing(spark, SF_SMALL).coalesce(1)
    n = rows.count()
    step = tuning.FeatureStep(rows)
    sizes = _sizes(tuning.checkpoint(step.fittable(rows)))
    assert len(sizes) == -(-n // 20) and sum(sizes) == n and max(sizes) <= 60
    assert sorted(step.fittable(rows).collect()) == sorted(step.indexed(rows).collect())


def test_rows_of_one_task_stay_where_they_are(spark):
    rows = inputs.listing(spark, SF_SMALL).coalesce(1)
    assert tuning.dealt(rows) is rows
    assert tuning.dealt(rows.limit(0)).count() == 0


def test_rows_without_key_are_dealt_too(spark):
    rows = inputs.listing(spark, SF_SMALL).coalesce(1).withColumn("p_partkey", F.lit(None).cast("bigint"))
    assert max(_sizes(tuning.dealt(rows, 20))) <= 60


def test_forests_do_not_depend_on_the_files(spark, monkeypatch):
    monkeypatch.setattr(tuning, "TASK_ROWS", 20)
    rows = inputs.listing(spark, SF_SMALL)
    got = [tuning.rf_tuned(spark, files, trials=((2, 3), (3, 5))).collect() for files in (rows.coalesce(1), rows.repartition(5))]
    assert [tuple(r)[:3] for r in got[0]] == [tuple(r)[:3] for r in got[1]]
    assert all(abs(a["rmse"] - b["rmse"]) < 1e-6 for a, b in zip(*got))
