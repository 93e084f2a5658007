"""Results must not depend on the physical strategy chosen at scale."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from weekcast.session import scale_conf

JOIN_QUERIES = ["weekly_demand", "hierarchy_join", "many_model_score", "routed_score", "sample_series",
                "first_series", "column_append", "check_rowcount", "dense_spine", "string_index"]


def _rows(spark, name):
    return sorted(map(tuple, E.queries()[name](spark, SF_SMALL).collect()))


@pytest.mark.parametrize("name", JOIN_QUERIES)
def test_same_result_without_broadcast(spark, name):
    before = _rows(spark, name)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        after = sorted(map(tuple, df.collect()))
        if name == "weekly_demand":
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert before == after


def test_scale_conf_sizes():
    conf = scale_conf(12 * 2 ** 40, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 49152
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = scale_conf(10 << 20, cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_cli_lists_queries(capsys):
    from weekcast.__main__ import main
    from weekcast.queries import QUERIES
    assert main(["list"]) == 0
    assert capsys.readouterr().out.split() == sorted(QUERIES)


def test_cli_run_writes_parquet(spark):
    from weekcast.__main__ import main
    from weekcast.session import scratch_path
    out = scratch_path(spark, "cli_out", unique=True)
    assert main(["run", "series_count", "--sf", SF_SMALL, "--out", out]) == 0
    assert spark.read.parquet(out).first()["n_series"] > 0
