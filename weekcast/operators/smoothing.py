"""Exponential smoothing with level, damped trend and season for every series, and a search that spends
its budget by halving.

A series is one row with its values packed in order, bounded by the weeks of the calendar; a candidate is a
struct of coefficients.  One step is an affine map of the state (level, trend, season), so a fit is a
fold over the array.  Candidates are folded inside the series' row: neither the losses nor the rounds of
a search need an exchange beyond the one that packs the series, and there is no Python.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.operators import series
from weekcast.session import checkpoint

#: Weeks of the season, its coefficient, the candidates (alpha, beta, phi, gamma, season; a
#: season of one week is none) and the weeks of tail that the rounds of a search predict.
SEASON, GAMMA = 13, 0.1
CANDIDATES = tuple((a, b, phi, g, m) for (m, g), (b, phi), a in
                   product(((1, 0.0), (SEASON, GAMMA)), ((0.0, 1.0), (0.1, 0.9)), (0.1, 0.3, 0.5, 0.8)))
TAILS = (5, 10, 20, 40)
#: Weeks of history per week of tail in the rounds of a search; the last round takes all.
HISTORY = 8


def _candidates() -> str:
    one = "named_struct('id', {}, 'alpha', {!r}D, 'beta', {!r}D, 'phi', {!r}D, 'gamma', {!r}D, 'm', {})"
    return "array(" + ", ".join(one.format(i, *c) for i, c in enumerate(CANDIDATES)) + ")"


def _state(y: str, nh: str) -> str:
    """(l, b, s) after ``nh`` values of the array ``y`` by candidate ``c``: the first season gives the
    first level and season, s[0] is the season of the week to come."""
    mean = f"aggregate(slice({y}, 1, c.m), 0.0D, (x, v) -> x + v) / c.m"
    start = f"named_struct('l', {mean}, 'b', 0.0D, 's', transform(slice({y}, 1, c.m), v -> v - {mean}))"
    error = "(v - (x.l + c.phi * x.b + x.s[0]))"
    step = (f"named_struct('l', x.l + c.phi * x.b + c.alpha * {error}, 'b', c.phi * x.b + c.alpha * c.beta * {error}, "
            f"'s', concat(slice(x.s, 2, c.m - 1), array(x.s[0] + c.gamma * {error})))")
    return f"aggregate(slice({y}, c.m + 1, {nh} - c.m), {start}, (x, v) -> {step})"


def _ahead(state: str, weeks: int) -> str:
    """Forecasts of the next ``weeks`` weeks from a state."""
    damped = "IF(c.phi = 1, cast(k AS double), c.phi * (1 - pow(c.phi, k)) / (1 - c.phi))"
    return (f"transform(array({state}), x -> transform(sequence(1, {weeks}), "
            f"k -> x.l + x.b * {damped} + x.s[(k - 1) % c.m]))[0]")


def _loss(y: str, nh: str, weeks: int, digits: int) -> str:
    """Mean squared error of candidate ``c`` over the ``weeks`` values of ``y`` after ``nh``."""
    pairs = f"zip_with(slice({y}, {nh} + 1, {weeks}), {_ahead(_state(y, nh), weeks)}, (v, f) -> pow(v - f, 2))"
    return f"round(aggregate({pairs}, 0.0D, (a, e) -> a + e) / {weeks}, {digits})"


def _packed(df: DataFrame, keys, horizon: int, value: str, order_col: str) -> DataFrame:
    """One row per series: (keys, wks, y, nh, status).  A history needs two seasons; a series with less
    is ``too_short``."""
    s = series.pack(df, keys, order_col, [value], "_pts").select(
        *keys, F.col(f"_pts.{order_col}").alias("wks"), F.expr(f"transform(_pts.{value}, v -> cast(v AS double))").alias("y"))
    s = s.withColumn("nh", F.size("y") - F.lit(horizon))
    return s.withColumn("status", F.when(F.col("nh") >= 2 * SEASON, "ok").otherwise("too_short"))


def losses(df: DataFrame, keys, horizon: int, value: str = "demand", order_col: str = "wk", digits: int = 4) -> DataFrame:
    """(keys, cand_id, status, loss): mean squared error of each candidate over the last ``horizon`` weeks.

    Input must be regular.  A too short series keeps its rows, with a null loss; so does one
    that holds a null value.  An empty table gives no rows.
    """
    s = _packed(df, keys, horizon, value, order_col)
    each = F.expr(f"transform({_candidates()}, c -> named_struct('cand_id', c.id, 'loss', "
                  f"IF(status = 'ok', {_loss('y', 'nh', horizon, digits)}, NULL)))")
    return s.select(*keys, "status", F.inline(each)).select(*keys, "cand_id", "status", "loss")


def forecast(df: DataFrame, keys, horizon: int, value: str = "demand", order_col: str = "wk", digits: int = 4) -> DataFrame:
    """(keys, week, cand_id, forecast) of the ``horizon`` weeks after each series' end, by the candidate of
    smallest loss over its last weeks (ties by id), fitted to the whole series.  Too short series have no rows."""
    s = _packed(df, keys, horizon, value, order_col).where("status = 'ok'")
    best = F.expr(f"array_min(transform({_candidates()}, c -> named_struct('loss', {_loss('y', 'nh', horizon, digits)}, 'c', c))).c")
    s = s.select(*keys, "wks", "y", best.alias("c")).withColumn("f", F.expr(_ahead(_state("y", "size(y)"), horizon)))
    weeks = F.expr("transform(f, (v, k) -> named_struct('wk', date_add(wks[size(wks) - 1], 7 * (k + 1)), 'v', v))")
    return s.select(*keys, F.col("c.id").alias("cand_id"), F.inline(weeks)) \
        .select(*keys, F.col("wk").alias(order_col), "cand_id", F.round("v", digits).alias(f"{value}_forecast"))


def halving(df: DataFrame, keys, horizon: int, value: str = "demand", order_col: str = "wk", digits: int = 4) -> DataFrame:
    """Search by successive halving: (keys, rung, cand_id, status, n_fits, weeks, loss, kept).

    Round ``rung`` fits the candidates that are left on the ``HISTORY`` weeks per week of its tail (the last
    round: on the whole history) and predicts the tail; the better half, by loss, then id, goes on, and
    in the last round the best one is kept.  ``n_fits`` and ``weeks`` say what a round cost a series:
    its fits, and the weeks each went over.  A too short series has its candidates in round 0 only, with
    no fit and nothing kept.  State is checkpointed between rounds: a lost executor repeats one round.
    """
    tails = [t for t in TAILS if t < horizon] + [horizon]
    state = checkpoint(_packed(df, keys, horizon, value, order_col).select(*keys, "y", "status", F.expr(_candidates()).alias("cands")))
    out = None
    for rung, tail in enumerate(tails):
        final = rung == len(tails) - 1
        history = f"size(y) - {tail}" if final else f"least(size(y) - {tail}, {HISTORY * tail})"
        s = state.withColumn("nh", F.expr(f"IF(status = 'ok', {history}, 0)")).withColumn(
            "part", F.expr(f"IF(status = 'ok', slice(y, size(y) - nh - {tail} + 1, nh + {tail}), array())"))
        s = s.withColumn("tried", F.expr(
            f"array_sort(transform(cands, c -> named_struct('loss', IF(status = 'ok', {_loss('part', 'nh', tail, digits)}, NULL), 'c', c)))"))
        s = s.withColumn("n", F.expr("IF(status = 'ok', " + ("1" if final else "cast(ceil(size(cands) / 2) AS int)") + ", 0)"))
        s = checkpoint(s.select(*keys, "y", "status", "nh", "tried", "n"))
        tried = F.expr("transform(tried, (t, i) -> named_struct('cand_id', t.c.id, 'loss', t.loss, 'kept', i < n))")
        rows = s.select(*keys, F.lit(rung).alias("rung"), "status", F.expr("IF(status = 'ok', size(tried), 0)").alias("n_fits"),
                        F.col("nh").alias("weeks"), F.inline(tried))
        out = rows if out is None else out.unionByName(rows)
        state = s.where("n > 0").select(*keys, "y", "status", F.expr("transform(slice(tried, 1, n), t -> t.c)").alias("cands"))
    return out.select(*keys, "rung", "cand_id", "status", "n_fits", "weeks", "loss", "kept")
