"""Golden fixture: the reference's 157-Monday calendar and its factors."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from weekcast.functions import calendar as cal
from weekcast.plans import demand

# pos, date, iso week, counter, shock factor, season factor
GOLDEN = [
    (0, "2018-07-23", 30, 0, 1.0, 1.0),
    (21, "2018-12-17", 51, 0, 1.0, 0.85),
    (22, "2018-12-24", 52, 0, 1.0, 0.8),
    (23, "2018-12-31", 1, 0, 1.0, 1.1),
    (24, "2019-01-07", 2, 0, 1.0, 1.15),
    (83, "2020-02-24", 9, 0, 1.0, 1.0),
    (84, "2020-03-02", 10, 1, 0.801781, 1.0),
    (85, "2020-03-09", 11, 2, 0.803562, 1.0),
    (126, "2020-12-21", 52, 43, 0.876575, 0.8),
    (127, "2020-12-28", 53, 44, 0.878356, 0.8),
    (128, "2021-01-04", 1, 45, 0.880137, 1.1),
    (156, "2021-07-19", 29, 73, 0.93, 1.0),
]


@pytest.fixture(scope="module")
def ref_cal(spark):
    return {r["pos"]: r for r in demand.reference_calendar_factors(spark).collect()}


def test_reference_calendar_length(ref_cal):
    assert len(ref_cal) == 157
    assert min(ref_cal) == 0 and max(ref_cal) == 156


@pytest.mark.parametrize("pos,date,week,counter,shock,season", GOLDEN)
def test_reference_calendar_rows(ref_cal, pos, date, week, counter, shock, season):
    r = ref_cal[pos]
    assert r["wk"] == dt.date.fromisoformat(date)
    assert r["iso_week"] == week
    assert r["counter"] == counter
    assert r["shock_factor"] == pytest.approx(shock, abs=1e-6)
    assert r["season_factor"] == pytest.approx(season)


def test_week53_feature_is_not_christmas(spark):
    df = spark.createDataFrame([(dt.date(2020, 12, 28),), (dt.date(2020, 12, 21),), (dt.date(2021, 1, 4),)], "wk date")
    got = {r["wk"]: r for r in df.select("wk", *[c.alias(n) for n, c in cal.exo_columns(F.col("wk"), cal.REFERENCE_EVENT).items()]).collect()}
    assert got[dt.date(2020, 12, 28)]["christmas"] == 0.0
    assert got[dt.date(2020, 12, 21)]["christmas"] == 1.0
    assert got[dt.date(2021, 1, 4)]["new_year"] == 1.0
    assert got[dt.date(2020, 12, 21)]["covid"] == 1.0


def test_first_monday_rule():
    assert cal.first_monday_on_or_after(dt.date(2020, 3, 1)) == dt.date(2020, 3, 2)
    assert cal.first_monday_on_or_after(dt.date(2020, 3, 2)) == dt.date(2020, 3, 2)
    assert cal.first_monday_on_or_after(dt.date(2000, 3, 1)) == dt.date(2000, 3, 6)
