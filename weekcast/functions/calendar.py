"""Calendar and event features as column expressions.

All features are functions of the week start alone (plus constants), so they
are computed row-wise: no shuffle, no Python, and filters still reach the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (demand shaping and features).
#   shock decline right after the event, in percent:      20
#   shock decline reached at the last calendar week:       7
#   square-root trend factor while the counter is 0:      100
#   season factor by ISO week: 51 -> 0.85, >=52 -> 0.8, 1 -> 1.1, 2 -> 1.15,
#                              3 -> 1.1, 4 -> 1.05, any other week -> 1.0
#   event feature weeks: christmas = ISO weeks 51-52, new_year = ISO weeks 1-4
#   given calendar: 3 x 52 weeks back from the Monday of 2021-07-19,
#                       event date 2020-03-01
# ---------------------------------------------------------------------------
SHOCK_FROM_PCT = 20.0
SHOCK_TO_PCT = 7.0
TREND_FACTOR = 100.0
SEASON_FACTORS = ((51, 0.85), (52, 0.8), (1, 1.1), (2, 1.15), (3, 1.1), (4, 1.05))
SEASON_DEFAULT = 1.0
CHRISTMAS_WEEKS = (51, 52)
NEW_YEAR_WEEKS = (1, 4)
REFERENCE_END = dt.date(2021, 7, 19)
REFERENCE_YEARS = 3
REFERENCE_EVENT = dt.date(2020, 3, 1)

# Event date used with the driver's test tables (their dates span 1995-2001).
TEST_EVENT = dt.date(2000, 3, 1)


def monday(c) -> Column:
    """Week start (Monday) of a date or timestamp column, as DATE.

    Plain date arithmetic (``weekday`` is 0 on Mondays): the same value as
    ``date_trunc('week', ...)`` without its time-zone round trip, which is
    measurably cheaper on the per-row hot path of every lineitem scan.
    """
    d = F.to_date(c)
    return F.date_sub(d, F.weekday(d))


def monday_of(d: dt.date) -> dt.date:
    return d - dt.timedelta(days=d.weekday())


def first_monday_on_or_after(d: dt.date) -> dt.date:
    return d if d.weekday() == 0 else monday_of(d) + dt.timedelta(days=7)


def iso_week(c) -> Column:
    return F.weekofyear(c)


def week_index(wk, origin) -> Column:
    """Whole weeks from ``origin`` (a Monday) to ``wk`` (a Monday)."""
    return (F.datediff(wk, origin) / F.lit(7)).cast("int")


def weekly_sequence(first_wk, last_wk) -> Column:
    """ARRAY<DATE> of every Monday from ``first_wk`` to ``last_wk`` inclusive."""
    return F.sequence(first_wk, last_wk, F.expr("INTERVAL 7 DAYS"))


def weeks_since_event(wk, event: dt.date) -> Column:
    """0 before the first Monday on/after the event, 1 on it, then 2, 3, ...

    The first calendar Monday not before the event carries counter 1, so the
    week just before it is the last with counter 0.
    """
    start = F.lit(first_monday_on_or_after(event))
    return F.when(wk >= start, week_index(wk, start) + 1).otherwise(F.lit(0))


def shock_factor(counter, max_counter) -> Column:
    """1 before the event; then a decline falling linearly from 20 % to 7 %."""
    pct = F.lit(SHOCK_FROM_PCT) - (F.lit(SHOCK_FROM_PCT - SHOCK_TO_PCT) / max_counter) * counter
    return F.when(counter == 0, F.lit(1.0)).otherwise((F.lit(100.0) - pct) / F.lit(100.0))


def season_factor(week) -> Column:
    """First matching rule wins; weeks 52 and 53 share the >= 52 factor."""
    out = None
    for wk_no, factor in SEASON_FACTORS:
        cond = (week >= wk_no) if wk_no == 52 else (week == wk_no)
        out = F.when(cond, F.lit(factor)) if out is None else out.when(cond, F.lit(factor))
    return out.otherwise(F.lit(SEASON_DEFAULT))


def event_flag(wk, event: dt.date) -> Column:
    """1.0 from the event date on.  Week starts are midnights, so comparing the
    DATE with the event DATE equals comparing their midnight timestamps."""
    return (wk >= F.lit(event)).cast("double")


def christmas_flag(wk) -> Column:
    lo, hi = CHRISTMAS_WEEKS
    return iso_week(wk).between(lo, hi).cast("double")


def new_year_flag(wk) -> Column:
    lo, hi = NEW_YEAR_WEEKS
    return iso_week(wk).between(lo, hi).cast("double")


def exo_columns(wk, event: dt.date) -> dict[str, Column]:
    """The three exogenous features of a week, by name."""
    return {"covid": event_flag(wk, event), "christmas": christmas_flag(wk),
            "new_year": new_year_flag(wk)}


def reference_calendar_bounds(end: dt.date = REFERENCE_END,
                              years: int = REFERENCE_YEARS) -> tuple[dt.date, dt.date]:
    last = monday_of(end)
    return last - dt.timedelta(weeks=years * 52), last
