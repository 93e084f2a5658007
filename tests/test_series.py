"""Series operators on hand-checkable fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from weekcast.operators import series

MON = dt.date(2024, 1, 1)


def weeks(n, start=MON):
    return [start + dt.timedelta(weeks=i) for i in range(n)]


def test_tail_split_edges(spark):
    rows = []
    for sid, n in (("a", 45), ("b", 41), ("c", 40), ("d", 39)):
        rows += [(sid, w, float(i)) for i, w in enumerate(weeks(n))]
    df = spark.createDataFrame(rows, "s string, wk date, demand double")
    got = {r["s"]: r["h"] for r in series.tail_split(df, ["s"], 40)
           .groupBy("s").agg(F.sum(F.col("is_history").cast("int")).alias("h")).collect()}
    assert got == {"a": 5, "b": 1, "c": 0, "d": 0}


def test_regularise_fills_gaps(spark):
    w = weeks(5)
    df = spark.createDataFrame([("x", w[0], 1.0), ("x", w[1], 2.0), ("x", w[4], 5.0)],
                               "s string, wk date, demand double")
    out = sorted(series.regularise(df, ["s"]).collect(), key=lambda r: r["wk"])
    assert [r["wk"] for r in out] == w
    assert [r["demand"] for r in out] == [1.0, 2.0, None, None, 5.0]
    assert all(r["s"] == "x" for r in out)
    zero = sorted(series.regularise(df, ["s"], fill="zero").collect(), key=lambda r: r["wk"])
    assert [r["demand"] for r in zero] == [1.0, 2.0, 0.0, 0.0, 5.0]
    ff = sorted(series.regularise(df, ["s"], fill="ffill").collect(), key=lambda r: r["wk"])
    assert [r["demand"] for r in ff] == [1.0, 2.0, 2.0, 2.0, 5.0]


def test_diff_and_lags(spark):
    df = spark.createDataFrame([("x", w, float(i * i)) for i, w in enumerate(weeks(5))],
                               "s string, wk date, demand double")
    out = sorted(series.lags(series.differences(df, ["s"]), ["s"], 2).collect(), key=lambda r: r["wk"])
    assert [r["d1"] for r in out] == [None, 1.0, 3.0, 5.0, 7.0]
    assert [r["d2"] for r in out] == [None, None, 2.0, 2.0, 2.0]
    assert [r["lag2"] for r in out] == [None, None, 0.0, 1.0, 4.0]


def test_pack_unpack_roundtrip(spark):
    rows = [("x", w, float(10 - i)) for i, w in enumerate(weeks(6))]
    df = spark.createDataFrame(list(reversed(rows)), "s string, wk date, demand double").repartition(3)
    packed = series.pack(df, ["s"], "wk", ["demand"])
    st = series.packed_stats(packed, ["s"]).first()
    assert (st["n"], st["first_demand"], st["last_demand"], st["sum_demand"]) == (6, 10.0, 5.0, 45.0)
    back = sorted(tuple(r) for r in series.unpack(packed).collect())
    assert back == sorted(rows)


def test_position(spark):
    df = spark.createDataFrame([("x", w, 0.0) for w in weeks(12)], "s string, wk date, demand double")
    out = series.with_position(df, ["s"]).filter("pos >= 10").collect()
    assert sorted(r["pos"] for r in out) == [10, 11]


def test_regularise_keeps_repeated_weeks(spark):
    w = weeks(4)
    df = spark.createDataFrame([("x", w[0], 1.0), ("x", w[0], 2.0), ("x", w[3], 4.0)],
                               "s string, wk date, demand double")
    out = sorted((r["wk"], r["demand"]) for r in series.regularise(df, ["s"]).collect()
                 if r["demand"] is not None)
    assert out == [(w[0], 1.0), (w[0], 2.0), (w[3], 4.0)]
    assert series.regularise(df, ["s"]).count() == 5
