"""Plan-shape tests: what the physical plans must (not) contain."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

PYTHON_NODES = ("MapInPandas", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas")


def plan(df):
    df.collect()  # run this DataFrame's own plan so AQE finalises it
    # the final adaptive plan prints the final and the initial plan: keep the final one
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def q(spark, name):
    return E.queries()[name](spark, SF_SMALL)


@pytest.mark.parametrize("name", ["exo_features", "adjusted_demand", "calendar_factors",
                                  "many_model_score", "model_index", "model_index_multi", "routed_score",
                                  "candidate_losses", "forecast_best", "exo_gain"])
def test_no_python_in_relational_queries(spark, name):
    p = plan(q(spark, name))
    assert not any(n in p for n in PYTHON_NODES), name


def test_features_add_no_exchange(spark):
    base = plan(q(spark, "weekly_demand")).count("Exchange hashpartitioning")
    assert plan(q(spark, "exo_features")).count("Exchange hashpartitioning") == base


def test_tail_split_one_extra_exchange(spark):
    base = plan(q(spark, "weekly_demand")).count("Exchange hashpartitioning")
    # the gap fill and the split share the exchange on the series key
    assert plan(q(spark, "tail_split")).count("Exchange hashpartitioning") <= base + 2


@pytest.mark.parametrize("name", ["tail_split", "lag_features", "series_position", "candidate_losses",
                                  "dense_spine", "runlog_latest", "many_model_score"])
def test_no_single_partition_in_series_queries(spark, name):
    assert "SinglePartition" not in plan(q(spark, name)), name


def test_scans_are_pruned(spark):
    p = plan(q(spark, "weekly_demand"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert any(s == "l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz" for s in schemas), schemas


def scans(p, column):
    return len([x for x in re.findall(r"ReadSchema: struct<([^>]*)>", p) if column in x])


@pytest.mark.parametrize("name", ["forecast_best", "candidate_losses", "exo_gain"])
def test_series_jobs_scan_lineitem_once(spark, name):
    p = plan(q(spark, name))
    assert scans(p, "l_partkey") == 1 and p.count("Exchange hashpartitioning") <= 3
    assert not any(n in p for n in PYTHON_NODES)


def test_one_scan_of_part(spark):
    p = plan(q(spark, "hierarchy_join"))
    assert scans(p, "p_brand") == 1 and p.count("Exchange") == 2


@pytest.mark.parametrize("name", ["adjusted_demand", "series_calendar"])
def test_calendar_bounds_come_from_the_weekly_table(spark, name):
    assert scans(plan(q(spark, name)), "l_shipdate") == 0  # the weekly table is read, not lineitem


def test_first_series_filters_part_before_the_join(spark):
    p = plan(q(spark, "first_series"))
    assert re.search(r"PushedFilters: \[[^]]*p_brand", p)


def test_results_invariant_to_shuffle_partitions(spark):
    names = ["tail_split", "best_candidate", "dense_spine", "model_index"]
    before = {n: sorted(map(tuple, q(spark, n).collect())) for n in names}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        after = {n: sorted(map(tuple, q(spark, n).collect())) for n in names}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert before == after


def test_bucketed_series_table_needs_no_exchange(spark):
    from weekcast.operators import series
    from weekcast.session import scratch_path
    from weekcast.sources import inputs, sinks
    loc = scratch_path(spark, "bucketed_db", unique=True)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS wc_bucketed LOCATION '{loc}'")
    try:
        sinks.overwrite_table(inputs.weekly(spark, SF_SMALL), "wc_bucketed.weekly",
                              bucket_by=["product", "sku"], buckets=8, sort_by=["product", "sku", "wk"])
        t = spark.table("wc_bucketed.weekly")
        p = plan(series.tail_split(t, ["product", "sku"], 40))
        assert "Exchange" not in p
        want = sorted(map(tuple, series.tail_split(inputs.weekly(spark, SF_SMALL), ["product", "sku"], 40).collect()))
        assert sorted(map(tuple, series.tail_split(t, ["product", "sku"], 40).collect())) == want
    finally:
        spark.sql("DROP DATABASE wc_bucketed CASCADE")
