"""Every registered query with an oracle agrees with DuckDB (sf0.001)."""

import datetime as dt
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from weekcast.sources.tables import TABLES
from tests.conftest import SF_SMALL


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


@pytest.mark.parametrize("name", sorted(q for q in E.queries() if q not in E.oracle_sql()
                                        and not q.startswith("op") and q != "pipeline"))
def test_query_without_oracle_has_rows(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() > 0


def test_rand_columns_bounds(spark):
    df = E.queries()["rand_columns"](spark, SF_SMALL)
    r = df.selectExpr("min(feature_1) a", "max(feature_1) b", "max(feature_3) c", "min(label) d").first()
    assert 0 <= r["a"] and r["b"] < 1 and r["c"] < 3 and r["d"] >= 0
