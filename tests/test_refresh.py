"""The weekly table by year: what a refresh reads, writes and keeps."""

import datetime as dt
import glob
import os

from tests.conftest import SF_SMALL
from weekcast.plans import demand
from weekcast.session import scratch_path
from weekcast.sources import inputs
from weekcast.sources.tables import read_table


def files(path):
    return {y: sorted(glob.glob(f"{path}/{y}/*.parquet")) for y in sorted(os.listdir(path)) if y.startswith("year=")}


def test_only_the_last_years_are_read_and_written(spark):
    li = read_table(spark, SF_SMALL, "lineitem", ["l_partkey", "l_quantity", "l_shipdate"])
    part = read_table(spark, SF_SMALL, "part", ["p_partkey", "p_type", "p_brand"])
    path = scratch_path(spark, "years", unique=True)
    cut = li.selectExpr("date_sub(max(l_shipdate), 200)").first()[0]
    demand.refresh_weekly(li.where(li.l_shipdate <= cut), part, path)
    local = path.removeprefix("file:")
    before = files(local)
    want = {(r["product"], r["sku"], r["wk"]): r["demand"] for r in inputs.weekly(spark, SF_SMALL).collect()}

    def rows(df):
        got = df.collect()
        assert all(r["wk"].year == r["year"] for r in got)
        return {(r["product"], r["sku"], r["wk"]): r["demand"] for r in got}
    assert rows(demand.refresh_weekly(li, part, path)) == want
    after, last = files(local), max(before)
    assert len(before) > 3 and all(before[y] == after[y] for y in before if y < last) and before[last] != after[last]
    # shipments of an earlier year arrive late
    monday = dt.date(int(last[5:]) - 2, 6, 1)
    late = li.limit(1).selectExpr("l_partkey", "1000.0D AS l_quantity", f"cast(DATE'{monday}' AS {dict(li.dtypes)['l_shipdate']}) AS l_shipdate")
    again = rows(demand.refresh_weekly(li.unionByName(late), part, path, since=monday.year))
    assert sum(again.values()) == sum(want.values()) + 1000
    assert rows(demand.refresh_weekly(li.limit(0), part, path)) == again


def test_date_filter_reaches_the_scan_and_empty_input(spark):
    li = read_table(spark, SF_SMALL, "lineitem", ["l_partkey", "l_quantity", "l_shipdate"])
    part = read_table(spark, SF_SMALL, "part", ["p_partkey", "p_type", "p_brand"])
    path = scratch_path(spark, "years", unique=True)
    assert demand.refresh_weekly(li.limit(0), part, path).count() == 0
    assert demand.refresh_weekly(li, part, path).count() == inputs.weekly(spark, SF_SMALL).count()
    plan = inputs.weekly_of(li.where("l_shipdate >= DATE'1998-01-05'"), part)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan
