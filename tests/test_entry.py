"""The driver's smoke check: entry() runs on sf0.001 with a stable schema."""

import __spark_entry__ as E

EXPECTED = ("struct<product:string,sku:string,wk:date,demand:double,is_history:boolean,status:string,"
            "cand_id:int,loss:double,demand_fitted:double>")


def test_entry_runs_with_stable_schema(spark):
    first = E.entry(spark)
    assert first.schema.simpleString() == EXPECTED
    assert first.count() > 0
    assert E.entry(spark).schema == first.schema


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 49 and len(E.oracle_sql()) >= 42
