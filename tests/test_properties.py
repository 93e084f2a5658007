"""Property tests: operators against pure-Python brute force on random inputs."""

import datetime as dt
import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weekcast.operators import ranking, search, series

MON = dt.date(2021, 1, 4)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.dictionaries(st.sampled_from("abc"),
                       st.sets(st.integers(0, 40), min_size=1, max_size=15), min_size=1))
def test_regularise_matches_brute_force(spark, weeks_by_key):
    rows = [(k, MON + dt.timedelta(weeks=w), float(w * 10 + ord(k))) for k, ws in weeks_by_key.items() for w in ws]
    df = spark.createDataFrame(rows, "k string, wk date, demand double").repartition(3)
    got = sorted(tuple(r) for r in series.regularise(df, ["k"]).collect())
    want = []
    for k, ws in weeks_by_key.items():
        for w in range(min(ws), max(ws) + 1):
            want.append((k, MON + dt.timedelta(weeks=w), float(w * 10 + ord(k)) if w in ws else None))
    assert got == sorted(want)


@SETTINGS
@given(st.lists(st.integers(1, 30), min_size=1, max_size=5), st.integers(1, 12))
def test_tail_split_counts(spark, lengths, h):
    rows = [(str(i), MON + dt.timedelta(weeks=w), 1.0) for i, n in enumerate(lengths) for w in range(n)]
    df = spark.createDataFrame(rows, "k string, wk date, demand double")
    out = series.tail_split(df, ["k"], h).groupBy("k").agg(
        F.sum(F.col("is_history").cast("int")).alias("h"), F.count(F.lit(1)).alias("n")).collect()
    got = {r["k"]: (r["h"], r["n"]) for r in out}
    assert got == {str(i): (max(n - h, 0), n) for i, n in enumerate(lengths)}


losses = st.one_of(st.floats(0, 5, allow_nan=False), st.just(float("nan")), st.just(float("inf")), st.none(),
                   st.sampled_from([1.0, 2.0]))


@SETTINGS
@given(st.lists(st.lists(losses, min_size=1, max_size=6), min_size=1, max_size=4))
def test_arg_min_matches_python(spark, groups):
    rows = [(str(g), c, l) for g, ls in enumerate(groups) for c, l in enumerate(ls)]
    df = spark.createDataFrame(rows, "k string, cand_id int, loss double").repartition(2)
    got = {r["k"]: r["cand_id"] for r in search.arg_min(df, ["k"], "loss", "cand_id", ["cand_id"]).collect()}

    def key(c, l):
        return (l if l is not None and not math.isnan(l) else math.inf, c)
    want = {str(g): min(range(len(ls)), key=lambda c: key(c, ls[c])) for g, ls in enumerate(groups)}
    assert got == want


@SETTINGS
@given(st.lists(st.integers(0, 20), min_size=1, max_size=60), st.integers(1, 6))
def test_global_row_number_is_a_sorted_permutation(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(parts)
    out = sorted((r["row_id"], r["v"]) for r in ranking.global_row_number(df, ["v"]).collect())
    assert [i for i, _ in out] == list(range(1, len(values) + 1))
    assert [v for _, v in out] == sorted(values)


@SETTINGS
@given(st.lists(st.integers(0, 60), min_size=1, max_size=70))
def test_sql_forecasters_property(spark, ys):
    h = 5
    rows = [("s", MON + dt.timedelta(weeks=i), float(y)) for i, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "k string, wk date, demand double")
    rows = search.sql_forecaster_losses(df, ["k"], h).collect()
    got = {r["cand_id"]: r["loss"] for r in rows}
    nh = len(ys) - h
    assert {r["status"] for r in rows} == {"ok" if nh >= 1 else "too_short"} and len(rows) == 5
    if nh < 1:
        assert set(got.values()) == {None}
        return
    hist, tail = np.array(ys[:nh], float), np.array(ys[nh:], float)
    slope = (hist[-1] - hist[0]) / (nh - 1) if nh > 1 else 0.0
    fc = {0: np.full(h, hist[-1]), 1: np.full(h, hist[-4:].mean()), 2: np.full(h, hist[-26:].mean()),
          3: np.full(h, hist[-52:].mean()), 4: hist[-1] + slope * np.arange(1, h + 1)}
    want = {c: round(float(np.mean((tail - f) ** 2)), 6) for c, f in fc.items()}
    assert got.keys() == want.keys()
    for c in want:
        assert abs(got[c] - want[c]) <= 1e-6 * max(1.0, abs(want[c]))
