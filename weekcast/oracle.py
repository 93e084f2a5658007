"""DuckDB SQL equivalents of the registered queries (exact-oracle checks).

Views ``lineitem part region embeddings events ...`` are pre-registered by
the checker.  Column names and types follow the Spark results.  Floats that
are not sums of integers are rounded in both engines to the same places.
Nothing is imported from the code under test: constants are written out and
calendars are generated here.
"""

from __future__ import annotations

import re

# Weeks held out, the event date, the first Monday on or after it, and the run id.
H = 40
RUN_ID = "weekcast-run-1"
E = "DATE '2000-03-01'"
M0 = "DATE '2000-03-06'"

WEEKLY = """weekly AS (
  SELECT p_type AS product, p_brand AS sku, CAST(date_trunc('week', l_shipdate) AS DATE) AS wk,
         sum(l_quantity) AS demand
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)"""
BOUNDS = """bounds AS (
  SELECT CAST(date_trunc('week', min(l_shipdate)) AS DATE) AS first_wk,
         CAST(date_trunc('week', max(l_shipdate)) AS DATE) AS last_wk FROM lineitem)"""
CAL = """cal AS (
  SELECT CAST(w AS DATE) AS wk, first_wk, last_wk
  FROM (SELECT unnest(generate_series(first_wk, last_wk, INTERVAL 7 DAY)) AS w, first_wk, last_wk FROM bounds))"""


def _counter(wk: str) -> str:
    return (f"CASE WHEN {wk} >= {M0} THEN CAST(date_diff('day', {M0}, {wk}) / 7 AS INTEGER) + 1 "
            f"ELSE 0 END")


def _shock(counter: str, max_counter: str) -> str:
    # down by 20 % right after the event, by 7 % in the last week, linear between
    return (f"CASE WHEN {counter} = 0 THEN CAST(1.0 AS DOUBLE) ELSE "
            f"(CAST(100.0 AS DOUBLE) - (CAST(20.0 AS DOUBLE) - "
            f"(CAST(13.0 AS DOUBLE) / {max_counter}) * {counter})) / CAST(100.0 AS DOUBLE) END")


def _season(week: str) -> str:
    return (f"CASE WHEN {week} = 51 THEN CAST(0.85 AS DOUBLE) WHEN {week} >= 52 THEN CAST(0.8 AS DOUBLE) "
            f"WHEN {week} = 1 THEN CAST(1.1 AS DOUBLE) WHEN {week} = 2 THEN CAST(1.15 AS DOUBLE) "
            f"WHEN {week} = 3 THEN CAST(1.1 AS DOUBLE) WHEN {week} = 4 THEN CAST(1.05 AS DOUBLE) "
            f"ELSE CAST(1.0 AS DOUBLE) END")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# every Monday from a series' first to its last week; weeks without shipments are 0
DENSE = """dense AS (
  SELECT g.product, g.sku, g.wk, coalesce(weekly.demand, CAST(0.0 AS DOUBLE)) AS demand
  FROM (SELECT product, sku, CAST(w AS DATE) AS wk FROM (
          SELECT product, sku, unnest(generate_series(min(wk), max(wk), INTERVAL 7 DAY)) AS w
          FROM weekly GROUP BY product, sku)) g
  LEFT JOIN weekly USING (product, sku, wk))"""

_MEANS = (4, 26, 52)
FORECASTS = f"""t AS (
  SELECT product, sku, wk, demand, row_number() OVER o AS rn, count(*) OVER p - {H} AS nh,
         lag(demand, 1) OVER o AS y1, first_value(demand) OVER o AS y0
  FROM dense WINDOW p AS (PARTITION BY product, sku), o AS (PARTITION BY product, sku ORDER BY wk)),
u AS (
  SELECT *, max(CASE WHEN rn = nh THEN demand END) OVER p AS yl,
    {", ".join(f"avg(CASE WHEN rn <= nh AND rn > nh - {k} THEN demand END) OVER p AS a{k}, "
               f"avg(demand) OVER (PARTITION BY product, sku ORDER BY wk ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS b{k}"
               for k in _MEANS)}
  FROM t WINDOW p AS (PARTITION BY product, sku)),
f AS (
  SELECT product, sku, wk, demand, nh >= 1 AND rn <= nh AS is_history,
         CASE WHEN nh >= 1 THEN 'ok' ELSE 'too_short' END AS status,
         CASE WHEN nh < 1 THEN NULL WHEN rn <= nh THEN y1 ELSE yl END AS f0,
         {", ".join(f"CASE WHEN nh < 1 THEN NULL WHEN rn <= nh THEN b{k} ELSE a{k} END AS f{i + 1}"
                    for i, k in enumerate(_MEANS))},
         CASE WHEN nh < 1 THEN NULL
              WHEN rn <= nh THEN y1 + CASE WHEN rn > 2 THEN (y1 - y0) / (rn - 2) ELSE CAST(0.0 AS DOUBLE) END
              ELSE yl + (rn - nh) * CASE WHEN nh > 1 THEN (yl - y0) / (nh - 1) ELSE CAST(0.0 AS DOUBLE) END END AS f4
  FROM u)"""

LOSSES = """per AS (SELECT product, sku, max(status) AS status, """ + ", ".join(
    f"round(avg(power(demand - f{c}, 2)) FILTER (NOT is_history), 6) AS l{c}" for c in range(5)) + """
        FROM f GROUP BY product, sku),
losses AS (""" + "\n UNION ALL ".join(
    f"SELECT product, sku, status, CAST({c} AS INTEGER) AS cand_id, l{c} AS loss FROM per" for c in range(5)) + """),
best AS (SELECT product, sku, status, CASE WHEN status = 'ok' THEN cand_id END AS cand_id, loss FROM (
  SELECT *, row_number() OVER (PARTITION BY product, sku ORDER BY loss NULLS LAST, cand_id) AS rk FROM losses) WHERE rk = 1)"""

MODELS = """m AS (
  SELECT l_suppkey % 10 AS device_id, count(*) AS n_used,
         regr_slope(l_extendedprice, l_quantity) AS slope,
         regr_intercept(l_extendedprice, l_quantity) AS intercept,
         regr_r2(l_extendedprice, l_quantity) AS r2,
         var_pop(l_extendedprice) - power(covar_pop(l_quantity, l_extendedprice), 2) / var_pop(l_quantity) AS mse
  FROM lineitem GROUP BY 1)"""

def _det3(m) -> str:
    """SQL text of the determinant of a 3x3 matrix of SQL expressions."""
    return (f"(({m[0][0]}) * (({m[1][1]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][1]}))"
            f" - ({m[0][1]}) * (({m[1][0]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][0]}))"
            f" + ({m[0][2]}) * (({m[1][0]}) * ({m[2][1]}) - ({m[1][1]}) * ({m[2][0]})))")


_FEATS = ("l_quantity", "l_discount", "l_tax")
_COV = [[f"c{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]
_CY = ["cy0", "cy1", "cy2"]


def _cramer(col: int) -> str:
    m = [[(_CY[i] if j == col else _COV[i][j]) for j in range(3)] for i in range(3)]
    return f"{_det3(m)} / {_det3(_COV)}"


MODELS3 = ("""mom AS (
  SELECT l_suppkey % 10 AS device_id, count(*) AS n_used, avg(l_extendedprice) AS my,
         var_pop(l_extendedprice) AS vy, """ +
    ", ".join(f"avg({f}) AS m{i}" for i, f in enumerate(_FEATS)) + ", " +
    ", ".join(f"covar_pop({a}, {b}) AS c{i}{j}" for i, a in enumerate(_FEATS)
              for j, b in enumerate(_FEATS) if j >= i) + ", " +
    ", ".join(f"covar_pop({f}, l_extendedprice) AS cy{i}" for i, f in enumerate(_FEATS)) + """
  FROM lineitem GROUP BY 1),
sol AS (SELECT *, """ + ", ".join(f"{_cramer(i)} AS b{i}" for i in range(3)) + """ FROM mom),
fit AS (SELECT *, my - (b0 * m0 + b1 * m1 + b2 * m2) AS intercept,
               greatest(vy - (b0 * cy0 + b1 * cy1 + b2 * cy2), 0.0) AS mse FROM sol)""")

# Golden values: Spark's hash() of the texts '1' to '40' and 'null', made non-negative.
VALUE_HASH_GOLDEN = """('1', 1625004744), ('2', 870267989), ('3', 1756013582), ('4', 2142269034), ('5', 135093849),
  ('6', 1929623325), ('7', 141897003), ('8', 1276280174), ('9', 541481139), ('10', 1573909955),
  ('11', 1726485189), ('12', 155192030), ('13', 2071733625), ('14', 651275377), ('15', 1255987793),
  ('16', 1961710367), ('17', 1970338662), ('18', 483404947), ('19', 276947115), ('20', 635186254),
  ('21', 1759010777), ('22', 1059805429), ('23', 866616713), ('24', 310565539), ('25', 958838101),
  ('26', 1874720063), ('27', 2125090942), ('28', 1483018429), ('29', 1867692786), ('30', 1718779581),
  ('31', 1727939050), ('32', 210093059), ('33', 48770877), ('34', 1269525580), ('35', 330350367),
  ('36', 1212808154), ('37', 105128356), ('38', 2037588501), ('39', 392883167), ('40', 1771747499),
  ('null', 673233193)"""
VALUE_HASH = """
WITH g(value, h) AS (VALUES """ + VALUE_HASH_GOLDEN + """),
v AS (SELECT p_partkey, coalesce(CAST(CASE WHEN p_size <= 40 THEN p_size END AS VARCHAR), 'null') AS value FROM part)
SELECT p_partkey, value, CAST(h AS BIGINT) AS h FROM v LEFT JOIN g USING (value)"""


def _uniform(seed: int) -> str:
    key = f"concat_ws(':', '{seed}', l_orderkey, l_partkey, l_suppkey, l_linenumber)"
    return f"(CAST(CAST('0x' || substr(md5({key}), 1, 13) AS BIGINT) AS DOUBLE) / CAST({1 << 52} AS DOUBLE))"


RAND_COLUMNS = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, f1 AS feature_1, f2 AS feature_2, f3 AS feature_3,
       f1 + f2 + f3 + f4 AS label
FROM (SELECT *, {_uniform(1)} AS f1, {_uniform(2)} * CAST(2 AS DOUBLE) AS f2, {_uniform(3)} * CAST(3 AS DOUBLE) AS f3,
             {_uniform(4)} AS f4 FROM lineitem)"""

_FLAGS = ("covid", "christmas", "new_year")


def _exo_gain() -> str:
    """Regression on the three flags over each history: moments, then Cramer's rule (variances + 1e-6)."""
    m = [[f"(c{min(i, j)}{max(i, j)} + 0.000001)" if i == j else f"c{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]
    b = [f"({_det3([[f'cy{i}' if j == c else m[i][j] for j in range(3)] for i in range(3)])}) / {_det3(m)}" for c in range(3)]
    return f"""
x AS (SELECT *, row_number() OVER (PARTITION BY product, sku ORDER BY wk)
             <= count(*) OVER (PARTITION BY product, sku) - {H} AS hist,
             CAST(wk >= {E} AS DOUBLE) AS covid, CAST(week(wk) BETWEEN 51 AND 52 AS DOUBLE) AS christmas,
             CAST(week(wk) BETWEEN 1 AND 4 AS DOUBLE) AS new_year FROM dense),
mo AS (SELECT product, sku, avg(demand) AS my, {", ".join(f"avg({a}) AS m{i}, covar_pop({a}, demand) AS cy{i}" for i, a in enumerate(_FLAGS))},
             {", ".join(f"covar_pop({_FLAGS[i]}, {_FLAGS[j]}) AS c{i}{j}" for i in range(3) for j in range(i, 3))}
      FROM x WHERE hist GROUP BY product, sku),
be AS (SELECT *, {", ".join(f"{e} AS b{i}" for i, e in enumerate(b))} FROM mo),
e AS (SELECT x.product, x.sku, max(CASE WHEN x.hist THEN 1 ELSE 0 END) = 1 AS ok,
             avg(power(demand - my, 2)) FILTER (NOT hist) AS w0,
             avg(power(demand - (my + {" + ".join(f"b{i} * ({a} - m{i})" for i, a in enumerate(_FLAGS))}), 2)) FILTER (NOT hist) AS w1
      FROM x LEFT JOIN be ON x.product = be.product AND x.sku = be.sku GROUP BY x.product, x.sku)
SELECT product, sku, CASE WHEN ok THEN 'ok' ELSE 'too_short' END AS status, round(w0, 2) AS loss_without,
       round(w1, 2) AS loss_with, round(w0 - w1, 2) AS gain FROM e"""


# label order of the train rows: frequency first, then the label
INDEXED = """tr AS (SELECT * FROM part WHERE p_partkey % 10 < 6),
bi AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS DOUBLE) AS p_brand_code
       FROM tr GROUP BY p_brand),
ty AS (SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS DOUBLE) AS p_type_code
       FROM tr GROUP BY p_type),
ix AS (SELECT p_partkey, p_brand_code, p_type_code FROM part JOIN bi USING (p_brand) JOIN ty USING (p_type))"""

RUNLOG = """r AS (
  SELECT event_id AS run_id, ts AS end_time,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id % 10 AS VARCHAR) END AS device,
         value AS metric
  FROM events)"""

SQL: dict[str, str] = {
    "weekly_demand": _with(WEEKLY) + "SELECT product, sku, wk, demand FROM weekly",
    "row_count": _with(WEEKLY) + "SELECT count(*) AS row_count FROM weekly",
    "range_rows": """
SELECT *, record_id % 10 AS device_id FROM (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
         row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate) - 1 AS record_id
  FROM lineitem)""",
    "calendar": _with(BOUNDS, CAL) + "SELECT wk FROM cal",
    "calendar_factors": _with(BOUNDS, CAL) + f"""
SELECT wk, CAST(week(wk) AS INTEGER) AS iso_week, {_counter('wk')} AS counter,
       round({_shock(_counter('wk'), _counter('last_wk'))}, 6) AS shock_factor,
       {_season('week(wk)')} AS season_factor
FROM cal""",
    "season_lookup": _with(BOUNDS, CAL) + f"SELECT wk, CAST(week(wk) AS INTEGER) AS iso_week, {_season('week(wk)')} AS season_factor FROM cal",
    "week_timestamps": _with(BOUNDS, CAL) + "SELECT wk, CAST(wk AS TIMESTAMP) AS at, "
        "CAST(wk AS TIMESTAMP) >= TIMESTAMP '2000-03-01 00:00:00' AS after_event FROM cal",
    "candidate_wins": _with(WEEKLY, DENSE, FORECASTS, LOSSES) + """
SELECT CAST(c.id AS INTEGER) AS cand_id, c.forecaster, CAST(CASE WHEN c.k IS NULL THEN 0 ELSE 1 END AS INTEGER) AS n_params,
       CAST(c.k AS DOUBLE) AS "window", count(best.cand_id) AS n_series
FROM (VALUES (0, 'last', NULL), (1, 'mean4', 4), (2, 'mean26', 26), (3, 'mean52', 52), (4, 'drift', NULL)) c(id, forecaster, k)
LEFT JOIN best ON c.id = best.cand_id GROUP BY ALL""",
    "weeks_since_event": _with(WEEKLY) + f"SELECT product, sku, wk, {_counter('wk')} AS counter FROM weekly",
    "series_calendar": _with(WEEKLY, BOUNDS, CAL) +
        "SELECT s.product, s.sku, cal.wk FROM (SELECT DISTINCT product, sku FROM weekly) s CROSS JOIN cal",
    "adjusted_demand": _with(WEEKLY, BOUNDS, f"""f AS (
  SELECT product, sku, wk, demand,
         CAST(date_diff('day', (SELECT first_wk FROM bounds), wk) / 7 AS INTEGER) AS pos,
         {_counter('wk')} AS counter,
         {_shock(_counter('wk'), _counter('(SELECT last_wk FROM bounds)'))} AS shock,
         {_season('week(wk)')} AS season
  FROM weekly)""") + f"""
SELECT product, sku, wk,
       round(CASE WHEN counter = 0 THEN demand * shock + CAST(100.0 AS DOUBLE) * sqrt(pos)
                  ELSE demand * shock END * season, 0) AS demand
FROM f""",
    "exo_features": _with(WEEKLY) + f"""
SELECT wk, product, sku, demand, CAST(wk >= {E} AS DOUBLE) AS covid,
       CAST(week(wk) BETWEEN 51 AND 52 AS DOUBLE) AS christmas,
       CAST(week(wk) BETWEEN 1 AND 4 AS DOUBLE) AS new_year
FROM weekly""",
    "first_series": _with(WEEKLY, "k AS (SELECT product, sku FROM weekly ORDER BY product, sku LIMIT 1)") +
        "SELECT w.product, w.sku, w.wk, w.demand FROM weekly w JOIN k USING (product, sku)",
    "series_count": _with(WEEKLY) + "SELECT count(*) AS n_series FROM (SELECT DISTINCT product, sku FROM weekly)",
    "series_bounds": _with(WEEKLY) + f"""
SELECT product, sku, min(wk) AS first_wk, max(wk) AS last_wk, count(*) AS n,
       min(CASE WHEN wk >= {E} THEN wk END) AS first_after_event
FROM weekly GROUP BY product, sku""",
    "series_position": _with(WEEKLY, DENSE) + """
SELECT product, sku, wk, pos FROM (
  SELECT product, sku, wk, CAST(row_number() OVER (PARTITION BY product, sku ORDER BY wk) - 1 AS INTEGER) AS pos
  FROM dense) WHERE pos >= 10""",
    "tail_split": _with(WEEKLY, DENSE) + f"""
SELECT product, sku, wk, demand,
       row_number() OVER (PARTITION BY product, sku ORDER BY wk)
         <= count(*) OVER (PARTITION BY product, sku) - {H} AS is_history
FROM dense""",
    "dense_spine": _with("""sp AS (
  SELECT l_suppkey AS s_key, CAST(date_trunc('week', l_shipdate) AS DATE) AS wk, sum(l_quantity) AS demand
  FROM lineitem GROUP BY 1, 2)""", """g AS (
  SELECT s_key, CAST(w AS DATE) AS wk FROM (
    SELECT s_key, unnest(generate_series(min(wk), max(wk), INTERVAL 7 DAY)) AS w FROM sp GROUP BY s_key))""") +
        "SELECT g.s_key, g.wk, sp.demand FROM g LEFT JOIN sp USING (s_key, wk)",
    "series_diff": _with(WEEKLY, DENSE) + """
SELECT product, sku, wk,
       demand - lag(demand, 1) OVER w AS d1,
       demand - 2 * lag(demand, 1) OVER w + lag(demand, 2) OVER w AS d2
FROM dense WINDOW w AS (PARTITION BY product, sku ORDER BY wk)""",
    "lag_features": _with(WEEKLY, DENSE) + "SELECT product, sku, wk, demand, " + ", ".join(
        f"lag(demand, {k}) OVER w AS lag{k}" for k in range(1, 5)) +
        " FROM dense WINDOW w AS (PARTITION BY product, sku ORDER BY wk)",
    "series_packed": _with(WEEKLY) + """
SELECT product, sku, count(*) AS n, arg_min(demand, wk) AS first_demand,
       arg_max(demand, wk) AS last_demand, sum(demand) AS sum_demand
FROM weekly GROUP BY product, sku""",
    "hierarchy_join": """
WITH s AS (SELECT p_type AS product, p_brand AS sku, count(*) AS n_parts FROM part GROUP BY 1, 2),
     p AS (SELECT p_type AS product, count(*) AS product_parts FROM part GROUP BY 1)
SELECT s.product, s.sku, s.n_parts, p.product_parts FROM s JOIN p USING (product)""",
    "hierarchy_keys": """
SELECT product, concat_ws('_', product, lpad(CAST(i AS VARCHAR), 2, '0')) AS sku_key
FROM (SELECT DISTINCT p_type AS product FROM part) CROSS JOIN (SELECT range AS i FROM range(1, 11))""",
    "column_append": """
WITH a AS (SELECT product, row_number() OVER (ORDER BY product) AS rk FROM (SELECT DISTINCT p_type AS product FROM part)),
     b AS (SELECT r_name AS region, row_number() OVER (ORDER BY r_name) AS rk FROM region)
SELECT a.product, b.region FROM a JOIN b USING (rk)""",
    "array_params": """
SELECT vec_id AS id, CAST(len(embedding) + 1 AS INTEGER) AS n, CAST(1.0 AS DOUBLE) AS ar_first,
       round(CAST(embedding[1] AS DOUBLE), 6) AS ar_second,
       round(CAST(embedding[len(embedding)] AS DOUBLE), 6) AS ar_last
FROM embeddings""",
    "sample_series": _with(WEEKLY, """pick AS (
  SELECT product, sku FROM (SELECT product, sku, count(*) AS n FROM weekly GROUP BY 1, 2)
  ORDER BY n DESC, product, sku LIMIT 1)""") +
        "SELECT w.product, w.sku, w.wk, w.demand FROM weekly w JOIN pick USING (product, sku)",
    "sample_rows": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate FROM lineitem
WHERE ((l_orderkey % 1000003) * 7919 + (l_partkey % 1000003) * 104729
       + (l_suppkey % 1000003) * 31 + (l_linenumber % 1000003) * 13) % 1000 < 100""",
    "holdout_split": """
SELECT CASE WHEN p_partkey % 10 < 6 THEN 'train' WHEN p_partkey % 10 < 8 THEN 'val' ELSE 'test' END AS split,
       count(*) AS n, round(sum(p_retailprice), 2) AS sum_price
FROM part GROUP BY 1""",
    "union_train_val": """
SELECT p_partkey FROM part WHERE p_partkey % 10 < 6
UNION ALL SELECT p_partkey FROM part WHERE p_partkey % 10 >= 6 AND p_partkey % 10 < 8""",
    "scalar_mix": """
SELECT p_partkey, p_partkey % 10 AS key_mod, greatest(p_retailprice, CAST(1000.0 AS DOUBLE)) AS floor_price,
       abs(p_size - 25) AS abs_diff,
       'runs:/' || CAST(p_partkey AS VARCHAR) || '/' || CAST(p_size AS VARCHAR) AS run_uri,
       lower(replace(p_name, ' ', '-')) AS clean_name,
       coalesce(CAST(CASE WHEN p_size <= 40 THEN p_size END AS VARCHAR), 'null') AS null_text,
       CAST(p_size AS VARCHAR) AS size_text
FROM part""",
    "check_rowcount": _with(WEEKLY, BOUNDS, CAL) + """
SELECT 'join_keeps_rows' AS check_name, (SELECT count(*) FROM weekly) AS expected,
       (SELECT count(*) FROM weekly JOIN cal USING (wk)) AS actual,
       (SELECT count(*) FROM weekly) = (SELECT count(*) FROM weekly JOIN cal USING (wk)) AS ok
UNION ALL
SELECT 'calendar_length', CAST(date_diff('day', first_wk, last_wk) / 7 + 1 AS BIGINT),
       (SELECT count(*) FROM cal),
       CAST(date_diff('day', first_wk, last_wk) / 7 + 1 AS BIGINT) = (SELECT count(*) FROM cal)
FROM bounds""",
    "model_index": _with(MODELS) + f"""
SELECT device_id, n_used, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(r2, 6) AS r2,
       round(mse, 2) AS mse, '{RUN_ID}' AS run_id FROM m""",
    "model_index_multi": _with(MODELS3) + f"""
SELECT device_id, n_used, round(b0, 4) AS coef_1, round(b1, 4) AS coef_2, round(b2, 4) AS coef_3,
       round(intercept, 4) AS intercept, round(1 - mse / vy, 6) AS r2, round(mse, 2) AS mse,
       '{RUN_ID}' AS run_id FROM fit""",
    "many_model_score": _with(MODELS3) + """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_suppkey % 10 AS device_id,
       round(intercept + b0 * l_quantity + b1 * l_discount + b2 * l_tax, 4) AS prediction,
       fit.device_id IS NOT NULL AS has_model
FROM lineitem LEFT JOIN fit ON l_suppkey % 10 = fit.device_id""",
    "routed_score": _with(MODELS3) + """
SELECT l_suppkey % 10 AS device_id, count(*) AS n,
       round(avg(intercept + b0 * l_quantity + b1 * l_discount + b2 * l_tax), 4) AS mean_pred
FROM lineitem LEFT JOIN (SELECT * FROM fit WHERE device_id <> 0) m ON l_suppkey % 10 = m.device_id
GROUP BY 1""",
    "mse_by_series": _with(WEEKLY, DENSE, FORECASTS) + """
SELECT product, sku, max(status) AS status, round(avg(power(demand - f0, 2)) FILTER (NOT is_history), 6) AS mse
FROM f GROUP BY product, sku""",
    "rmse_global": _with(WEEKLY, DENSE, FORECASTS) + """
SELECT round(sqrt(avg(power(demand - f0, 2)) FILTER (NOT is_history)), 6) AS rmse,
       count(DISTINCT (product, sku)) AS n_series,
       count(DISTINCT (product, sku)) FILTER (status <> 'ok') AS n_too_short FROM f""",
    "candidate_losses": _with(WEEKLY, DENSE, FORECASTS, LOSSES) + "SELECT product, sku, cand_id, loss, status FROM losses",
    "best_candidate": _with(WEEKLY, DENSE, FORECASTS, LOSSES) + "SELECT product, sku, status, cand_id, loss FROM best",
    "forecast_best": _with(WEEKLY, DENSE, FORECASTS, LOSSES) + """
SELECT f.product, f.sku, f.wk, f.demand, f.is_history, f.status, b.cand_id, CASE WHEN f.status = 'ok' THEN b.loss END AS loss,
       round(CASE b.cand_id WHEN 0 THEN f0 WHEN 1 THEN f1 WHEN 2 THEN f2 WHEN 3 THEN f3 WHEN 4 THEN f4 END, 6) AS demand_fitted
FROM f JOIN best b ON f.product = b.product AND f.sku = b.sku""",
    "exo_gain": _with(WEEKLY, DENSE, _exo_gain().split("\nSELECT product, sku, CASE")[0].strip()) +
        "SELECT product, sku, CASE" + _exo_gain().split("\nSELECT product, sku, CASE")[1],
    "forecast_frame": _with(WEEKLY, DENSE, FORECASTS) +
        "SELECT product, sku, wk, demand, is_history, status = 'ok' AS eligible FROM f",
    "value_hash": VALUE_HASH,
    "rand_columns": RAND_COLUMNS,
    "indexed_listing": _with(INDEXED) + "SELECT p_partkey, p_brand_code, p_type_code FROM ix",
    "forest_checks": _with(INDEXED) + """
SELECT split, count(*) AS n_rows, count(*) - count(ix.p_partkey) AS n_skipped, count(ix.p_partkey) AS n_scored
FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 < 6 THEN 'train' WHEN p_partkey % 10 < 8 THEN 'val' ELSE 'test' END AS split
      FROM part) LEFT JOIN ix USING (p_partkey) GROUP BY split""",
    "string_index": """
WITH s AS (SELECT 'p_brand' AS "column", p_brand AS label FROM part
           UNION ALL SELECT 'p_type', p_type FROM part),
     c AS (SELECT "column", label, count(*) AS n FROM s WHERE label IS NOT NULL GROUP BY 1, 2)
SELECT "column", label,
       CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, label) - 1 AS DOUBLE) AS idx
FROM c""",
    "runlog_latest": _with(RUNLOG) + """
SELECT device, run_id, end_time, metric FROM (
  SELECT *, row_number() OVER (PARTITION BY device ORDER BY end_time DESC, run_id DESC) AS rk
  FROM r WHERE device IS NOT NULL) WHERE rk = 1""",
    "topk_runs": _with(RUNLOG) + """
SELECT device, run_id, end_time FROM r WHERE device IS NOT NULL
ORDER BY end_time DESC, run_id DESC LIMIT 10""",
    "write_readback": _with(WEEKLY) +
        "SELECT product, count(*) AS n, sum(demand) AS demand FROM weekly GROUP BY product",
    "table_roundtrip": _with(WEEKLY) + """
SELECT product, count(*) AS n, sum(demand) AS demand, source
FROM weekly CROSS JOIN (VALUES ('built'), ('saved')) v(source) GROUP BY product, source""",
    "runlog_roundtrip": _with(RUNLOG) + """
SELECT 'device-' || device AS parent_run_id, count(*) AS n_declared, count(*) AS n_logged,
       max(end_time) AS last_end, max(metric) AS best_metric
FROM r WHERE device IS NOT NULL GROUP BY device""",
    "schema_checks": """
SELECT 'lineitem' AS table_name, 'l_partkey' AS column_name, 'bigint' AS expected, 'bigint' AS actual, true AS ok,
       count(l_partkey) AS n_values FROM lineitem
UNION ALL SELECT 'lineitem', 'l_quantity', 'double', 'double', true, count(l_quantity) FROM lineitem
UNION ALL SELECT 'lineitem', 'l_shipdate', 'timestamp_ntz', 'timestamp_ntz', true, count(l_shipdate) FROM lineitem
UNION ALL SELECT 'part', 'p_partkey', 'bigint', 'bigint', true, count(p_partkey) FROM part
UNION ALL SELECT 'part', 'p_type', 'string', 'string', true, count(p_type) FROM part
UNION ALL SELECT 'part', 'p_brand', 'string', 'string', true, count(p_brand) FROM part
UNION ALL SELECT 'part', 'p_colour', 'string', NULL, false, 0""",
    "metric_csv_roundtrip": _with(WEEKLY) +
        "SELECT lower(replace(product, ' ', '-')) AS name, sum(demand) AS value FROM weekly GROUP BY product",
}


# --- forests per device: the levels written out one after the other --------------------------

_BINS, _TREES, _DEPTH, _LEAST = 16, 4, 3, 20


def _bin(i: int, f: str) -> str:
    at = f"floor(({f} - lo{i}) / (hi{i} - lo{i}) * CAST({_BINS} AS DOUBLE))"
    return f"CAST(least({at}, {_BINS - 1}) AS INTEGER) AS b{i}"


def _forest() -> str:
    edges = ", ".join(f"min({f}) AS lo{i}, max({f}) AS hi{i}" for i, f in enumerate(_FEATS))
    ctes = [f"edges AS (SELECT {edges} FROM lineitem)",
            f"""rows AS (SELECT l_suppkey % 10 AS g, (l_orderkey * 7 + l_linenumber) % {_TREES} AS fold, l_extendedprice AS y,
              CAST(round(l_extendedprice / CAST(0.01 AS DOUBLE)) AS BIGINT) AS c, {", ".join(_bin(i, f) for i, f in enumerate(_FEATS))}
              FROM lineitem, edges)""",
            f"""p0 AS (SELECT g, CAST(tree AS INTEGER) AS tree, 1 AS node, b0, b1, b2, count(*) AS n, CAST(sum(c) AS BIGINT) AS s
              FROM rows, range({_TREES}) AS r(tree) WHERE fold <> tree GROUP BY ALL)"""]
    for d in range(_DEPTH):
        long = " UNION ALL ".join(f"SELECT g, tree, node, {i} AS feature, b{i} AS bin, n, s FROM p{d} WHERE node >= {1 << d}" for i in range(3))
        ctes += [f"""h{d} AS (SELECT g, tree, node, feature, bin, CAST(sum(n) AS BIGINT) AS n, CAST(sum(s) AS BIGINT) AS s
                  FROM ({long}) GROUP BY ALL)""",
                 f"""w{d} AS (SELECT g, tree, node, feature, bin, CAST(sum(n) OVER o AS BIGINT) AS nl, CAST(sum(n) OVER p AS BIGINT) AS nt,
                  CAST(sum(s) OVER o AS BIGINT) AS sl, CAST(sum(s) OVER p AS BIGINT) AS st FROM h{d}
                  WINDOW p AS (PARTITION BY g, tree, node, feature),
                         o AS (PARTITION BY g, tree, node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING))""",
                 f"""g{d} AS (SELECT *, CAST(sl AS DOUBLE) * CAST(sl AS DOUBLE) / nl
                    + CAST(st - sl AS DOUBLE) * CAST(st - sl AS DOUBLE) / (nt - nl) - CAST(st AS DOUBLE) * CAST(st AS DOUBLE) / nt AS gain
                  FROM w{d} WHERE nl >= {_LEAST} AND nt - nl >= {_LEAST})""",
                 f"""s{d} AS (SELECT g, tree, node, feature, bin FROM (SELECT *, row_number() OVER (
                    PARTITION BY g, tree, node ORDER BY gain DESC, feature, bin) AS k FROM g{d} WHERE gain > 0) WHERE k = 1)""",
                 f"""p{d + 1} AS (SELECT g, tree, CASE WHEN feature IS NULL THEN node ELSE 2 * node + CASE WHEN
                    (CASE feature WHEN 0 THEN b0 WHEN 1 THEN b1 ELSE b2 END) > bin THEN 1 ELSE 0 END END AS node, b0, b1, b2, n, s
                  FROM p{d} LEFT JOIN s{d} USING (g, tree, node))"""]
    ctes.append("inner_nodes AS (" + " UNION ALL ".join(f"SELECT * FROM s{d}" for d in range(_DEPTH)) + ")")
    ctes.append("sums AS (" + " UNION ALL ".join(
        f"SELECT g, tree, node, CAST(sum(n) AS BIGINT) AS n, CAST(sum(s) AS BIGINT) AS s FROM p{d} WHERE node >= {1 << d} GROUP BY ALL"
        for d in range(_DEPTH + 1)) + ")")
    ctes.append("nodes AS (SELECT g, tree, node, feature, bin, n, CAST(s AS DOUBLE) / n * CAST(0.01 AS DOUBLE) AS value "
                "FROM sums LEFT JOIN inner_nodes USING (g, tree, node))")
    return ",\n".join(ctes)


SQL["device_trees"] = "WITH " + _forest() + """
SELECT g AS device_id, tree, node, feature, bin, n, round(value, 4) AS value FROM nodes"""


def _walk() -> str:
    out, at = [], f"a0 AS (SELECT *, 1 AS node, row_number() OVER () AS id FROM rows, (SELECT DISTINCT tree FROM nodes))"
    out.append(at)
    for d in range(_DEPTH):
        out.append(f"""a{d + 1} AS (SELECT a.* EXCLUDE (node), CASE WHEN m.feature IS NULL THEN a.node ELSE 2 * a.node + CASE WHEN
          (CASE m.feature WHEN 0 THEN b0 WHEN 1 THEN b1 ELSE b2 END) > m.bin THEN 1 ELSE 0 END END AS node
          FROM a{d} a JOIN nodes m ON a.g = m.g AND a.tree = m.tree AND a.node = m.node)""")
    return ",\n".join(out)


SQL["device_tree_scores"] = "WITH " + _forest() + ",\n" + _walk().replace(
    "row_number() OVER () AS id FROM rows,", "id FROM (SELECT *, row_number() OVER () AS id FROM rows),") + f""",
f AS (SELECT a.g, a.id, any_value(a.y) AS y, avg(m.value) AS p FROM a{_DEPTH} a
      JOIN nodes m ON a.g = m.g AND a.tree = m.tree AND a.node = m.node GROUP BY a.g, a.id)
SELECT g AS device_id, count(*) AS n, round(avg(p), 2) AS mean_pred, round(avg(power((y - p) / 1000, 2)), 4) AS mse
FROM f GROUP BY g"""


# --- autoregressive moving averages: windows, sums, Cramer's rule and a recursion over the weeks ----

_LONG, _HISTORY, _RIDGE = 4, 24, "CAST(1e-6 AS DOUBLE)"


def _det(m) -> str:
    if len(m) == 1:
        return f"({m[0][0]})"
    return "(" + " ".join(f"{'-' if j % 2 else '+'} ({m[0][j]}) * {_det([r[:j] + r[j + 1:] for r in m[1:]])}" for j in range(len(m))) + ")"


def _rule(prefix: str, k: int, names: str) -> str:
    m = [[f"{prefix}{min(i, j)}{max(i, j)}" + (f" + {_RIDGE}" if i == j else "") for j in range(k)] for i in range(k)]
    cols = [[[f"{prefix}y{i}" if j == c else m[i][j] for j in range(k)] for i in range(k)] for c in range(k)]
    return ", ".join(f"{_det(x)} / {_det(m)} AS {names}{c}" for c, x in enumerate(cols))


def _sums(prefix: str, k: int, x: str, y: str, where: str) -> str:
    pairs = [f"coalesce(sum({x}{i} * {x}{j}) FILTER ({where}), 0) AS {prefix}{i}{j}" for i in range(k) for j in range(i, k)]
    return ", ".join(pairs + [f"coalesce(sum({x}{i} * {y}) FILTER ({where}), 0) AS {prefix}y{i}" for i in range(k)])


ARMA = f"""v AS (
  SELECT product, sku, wk, demand, row_number() OVER (PARTITION BY product, sku ORDER BY wk) - 1 AS t,
         count(*) OVER (PARTITION BY product, sku) - {H} AS nh FROM dense),
c AS (SELECT *, demand - avg(CASE WHEN t < nh THEN demand END) OVER (PARTITION BY product, sku) AS z,
             avg(CASE WHEN t < nh THEN demand END) OVER (PARTITION BY product, sku) AS mean FROM v WHERE nh >= {_HISTORY}),
l AS (SELECT *, {", ".join(f"lag(z, {k + 1}) OVER (PARTITION BY product, sku ORDER BY wk) AS l{k}" for k in range(_LONG))} FROM c),
m AS (SELECT product, sku, {_sums("m", _LONG, "l", "z", f"t >= {_LONG} AND t < nh")} FROM l GROUP BY product, sku),
a AS (SELECT product, sku, {_rule("m", _LONG, "a")} FROM m),
e AS (SELECT l.*, CASE WHEN t < {_LONG} THEN 0 ELSE z - {" - ".join(f"a{k} * l{k}" for k in range(_LONG))} END AS e
      FROM l JOIN a USING (product, sku)),
o AS (SELECT p.p, q.q FROM (VALUES (0), (1), (2)) AS p(p), (VALUES (0), (1)) AS q(q)),
x AS (SELECT *, CASE WHEN p >= 1 THEN l0 ELSE 0 END AS x0, CASE WHEN p >= 2 THEN l1 ELSE 0 END AS x1,
             CASE WHEN q >= 1 THEN e1 ELSE 0 END AS x2
      FROM (SELECT *, lag(e, 1) OVER (PARTITION BY product, sku ORDER BY wk) AS e1 FROM e), o),
n AS (SELECT product, sku, p, q, {_sums("n", 3, "x", "z", f"t >= {_LONG + 1} AND t < nh")} FROM x GROUP BY product, sku, p, q),
b AS (SELECT *, abs(b2) < 1 AND abs(b1) < 1 AND b1 + b0 < 1 AND b1 - b0 < 1 AS stable
      FROM (SELECT product, sku, p, q, {_rule("n", 3, "b")} FROM n)),
rec AS (
  SELECT product, sku, p, q, CAST(-1 AS BIGINT) AS t, CAST(0 AS DOUBLE) AS h, CAST(0 AS DOUBLE) AS h1, CAST(0 AS DOUBLE) AS r,
         CAST(0 AS DOUBLE) AS f, CAST(0 AS DOUBLE) AS y, b0, b1, b2 FROM b WHERE stable
  UNION ALL
  SELECT product, sku, p, q, t, CASE WHEN t < nh THEN z ELSE f END, h, CASE WHEN t < nh THEN z - f ELSE 0 END, f + mean, demand, b0, b1, b2
  FROM (SELECT rec.product, rec.sku, p, q, c.t, c.nh, c.z, c.mean, c.demand, rec.h, b0, b1, b2,
               b0 * rec.h + b1 * rec.h1 + b2 * rec.r AS f
        FROM rec JOIN c ON rec.product = c.product AND rec.sku = c.sku AND c.t = rec.t + 1)),
al AS (SELECT product, sku, p, q, round(avg(power(y - f, 2)) FILTER (t >= nh), 4) AS loss
       FROM rec JOIN (SELECT DISTINCT product, sku, nh FROM c) USING (product, sku) WHERE t >= 0 GROUP BY product, sku, p, q)"""
_ARMA = "WITH RECURSIVE " + ",\n".join([WEEKLY, DENSE, ARMA])
SQL["arma_losses"] = _ARMA + """
SELECT s.product, s.sku, CAST(o.p AS INTEGER) AS p, CAST(o.q AS INTEGER) AS q,
       CASE WHEN s.nh < 24 THEN 'too_short' WHEN loss IS NULL THEN 'unstable' ELSE 'ok' END AS status, loss
FROM (SELECT DISTINCT product, sku, nh FROM v) s CROSS JOIN o LEFT JOIN al USING (product, sku, p, q)"""
SQL["arma_forecast"] = _ARMA + """,
pick AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product, sku ORDER BY loss, p, q) AS k FROM al) WHERE k = 1)
SELECT v.product, v.sku, v.wk, v.demand, v.t < v.nh AND v.nh >= 24 AS is_history,
       CASE WHEN pick.p IS NULL THEN 'too_short' ELSE 'ok' END AS status, CAST(pick.p AS INTEGER) AS p, CAST(pick.q AS INTEGER) AS q,
       round(rec.f, 4) AS demand_fitted
FROM v LEFT JOIN pick USING (product, sku)
LEFT JOIN rec ON rec.product = v.product AND rec.sku = v.sku AND rec.p = pick.p AND rec.q = pick.q AND rec.t = v.t"""


# --- exponential smoothing: the recursion as a fold over a list, rounds of a search one after the other ----

_SEASON = 13
_SMOOTHERS = """cand AS (
  SELECT CAST(row_number() OVER (ORDER BY m, beta, alpha) - 1 AS INTEGER) AS cand_id, alpha, beta, phi, gamma, m
  FROM (VALUES (CAST(0.1 AS DOUBLE)), (CAST(0.3 AS DOUBLE)), (CAST(0.5 AS DOUBLE)), (CAST(0.8 AS DOUBLE))) AS a(alpha),
       (VALUES (CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)), (CAST(0.1 AS DOUBLE), CAST(0.9 AS DOUBLE))) AS t(beta, phi),
       (VALUES (1, CAST(0 AS DOUBLE)), (13, CAST(0.1 AS DOUBLE))) AS s(m, gamma)),
packed AS (
  SELECT product, sku, max(wk) AS last_wk, list(demand ORDER BY wk) AS y, CAST(count(*) AS INTEGER) AS n,
         CASE WHEN count(*) - 40 >= 26 THEN 'ok' ELSE 'too_short' END AS status
  FROM dense GROUP BY product, sku)"""


def _smoothed(source: str) -> str:
    """Rows of ``source`` (candidate columns, part, nh) with the state st after nh values of the part."""
    return f"""(SELECT * EXCLUDE (mean), list_reduce(list_concat(
      [{{'l': mean, 'b': CAST(0 AS DOUBLE), 's': list_transform(part[1:m], lambda v: v - mean), 'v': CAST(0 AS DOUBLE)}}],
      list_transform(part[m + 1:nh], lambda v: {{'l': CAST(0 AS DOUBLE), 'b': CAST(0 AS DOUBLE), 's': CAST([] AS DOUBLE[]), 'v': v}})),
      lambda x, r: {{'l': x.l + phi * x.b + alpha * (r.v - (x.l + phi * x.b + x.s[1])),
                     'b': phi * x.b + alpha * beta * (r.v - (x.l + phi * x.b + x.s[1])),
                     's': list_append(x.s[2:], x.s[1] + gamma * (r.v - (x.l + phi * x.b + x.s[1]))), 'v': r.v}}) AS st
      FROM (SELECT *, list_sum(part[1:m]) / m AS mean FROM ({source})))"""


_DAMPED = "CASE WHEN phi = 1 THEN CAST(k AS DOUBLE) ELSE phi * (1 - power(phi, k)) / (1 - phi) END"


def _missed(source: str, tail) -> str:
    """Rows of ``source`` with the mean squared error over the ``tail`` values after nh."""
    ahead = f"st.l + st.b * ({_DAMPED}) + st.s[(k - 1) % m + 1]"
    return f"""(SELECT *, round(list_sum(list_transform(range(1, {tail} + 1), lambda k: power(part[nh + k] - ({ahead}), 2))) / {tail}, 4) AS loss
      FROM {_smoothed(source)})"""


_PACKED = _with(WEEKLY, DENSE, _SMOOTHERS)
_OK = f"SELECT *, y AS part, n - {H} AS nh FROM packed, cand WHERE status = 'ok'"
SQL["smoothing_losses"] = _PACKED + f"""
SELECT product, sku, cand_id, status, loss FROM {_missed(_OK, H)}
UNION ALL SELECT product, sku, cand_id, status, NULL FROM packed, cand WHERE status <> 'ok'"""
SQL["smoothing_forecast"] = _PACKED + f""",
pick AS (SELECT product, sku, cand_id FROM (
  SELECT *, row_number() OVER (PARTITION BY product, sku ORDER BY loss, cand_id) AS r FROM {_missed(_OK, H)}) WHERE r = 1)
SELECT product, sku, CAST(last_wk + CAST(7 * k AS INTEGER) AS DATE) AS wk, cand_id,
       round(st.l + st.b * ({_DAMPED}) + st.s[(k - 1) % m + 1], 4) AS demand_forecast
FROM {_smoothed("SELECT *, y AS part, n AS nh FROM packed JOIN pick USING (product, sku) JOIN cand USING (cand_id)")}, range(1, {H + 1}) AS w(k)"""


def _rungs() -> str:
    ctes, tails, fits = [], (5, 10, 20, H), 16
    for r, tail in enumerate(tails):
        last = r == len(tails) - 1
        nh = f"n - {tail}" if last else f"least(n - {tail}, {8 * tail})"
        who = "packed, cand" if r == 0 else f"packed JOIN r{r - 1} USING (product, sku) JOIN cand USING (cand_id)"
        rows = (f"SELECT product, sku, status, n, cand_id, alpha, beta, phi, gamma, m, CAST({nh} AS INTEGER) AS nh, "
                f"y[n - ({nh}) - {tail} + 1:n] AS part FROM {who} WHERE status = 'ok'" + (" AND kept" if r else ""))
        keep = 1 if last else fits // 2
        ctes.append(f"""r{r} AS MATERIALIZED (SELECT product, sku, {r} AS rung, cand_id, {fits} AS n_fits, nh AS weeks, loss,
          row_number() OVER (PARTITION BY product, sku ORDER BY loss, cand_id) <= {keep} AS kept FROM {_missed(rows, tail)})""")
        fits = keep
    return ",\n".join(ctes)


SQL["halving_search"] = _PACKED + ",\n" + _rungs() + "\n" + " UNION ALL ".join(
    f"SELECT product, sku, rung, cand_id, 'ok' AS status, n_fits, weeks, loss, kept FROM r{r}" for r in range(4)) + """
UNION ALL SELECT product, sku, 0, cand_id, status, 0, 0, NULL, false FROM packed, cand WHERE status <> 'ok'"""


# --- nested runs: from the roots down, one level after the other ------------------------------

SQL["run_tree"] = """WITH RECURSIVE own AS (
  SELECT event_id AS run_id, CASE WHEN event_id > 0 THEN event_id // 8 END AS up FROM events WHERE event_type <> 'error'),
down AS (
  SELECT run_id, run_id AS root_run_id, CAST(0 AS BIGINT) AS depth, CASE WHEN up IS NULL THEN 'root' ELSE 'orphan' END AS status
  FROM own WHERE up IS NULL OR up NOT IN (SELECT run_id FROM own)
  UNION ALL
  SELECT own.run_id, down.root_run_id, down.depth + 1, 'nested' FROM down JOIN own ON own.up = down.run_id)
SELECT down.*, coalesce(n, 0) AS n_children FROM down
LEFT JOIN (SELECT up AS run_id, count(*) AS n FROM own WHERE up IS NOT NULL GROUP BY up) USING (run_id)"""


# --- orders of differencing, and the table by year ----------------------------------------------


def _kpss() -> str:
    o = "OVER (PARTITION BY product, sku ORDER BY wk)"
    e = ", ".join(f"d{d} - avg(d{d}) OVER (PARTITION BY product, sku) AS e{d}" for d in range(3))
    lagged = ", ".join(f"lag(e{d}, {j}) {o} AS e{d}l{j}" for d in range(3) for j in range(1, 5))
    sums = ", ".join(f"sum(e{d}) OVER (PARTITION BY product, sku ORDER BY wk ROWS UNBOUNDED PRECEDING) AS s{d}" for d in range(3))
    m = ", ".join(f"count(e{d}) AS n{d}, sum(s{d} * s{d}) FILTER (e{d} IS NOT NULL) AS q{d}, sum(e{d} * e{d})"
                  + "".join(f" + CAST({2 * (5 - j)} AS DOUBLE) / 5 * sum(e{d} * e{d}l{j})" for j in range(1, 5)) + f" AS v{d}" for d in range(3))
    k = ", ".join(f"CASE WHEN n >= 22 AND v{d} > 1e-6 THEN round(q{d} / n{d} / v{d}, 6) END AS kpss{d}" for d in range(3))
    return f"""a AS (SELECT product, sku, wk, demand AS d0, demand - lag(demand) {o} AS d1,
                     demand - 2 * lag(demand) {o} + lag(demand, 2) {o} AS d2 FROM dense),
b AS (SELECT *, {e} FROM a),
c AS (SELECT *, {lagged}, {sums} FROM b),
m AS (SELECT product, sku, count(*) AS n, {m} FROM c GROUP BY product, sku),
k AS (SELECT product, sku, n, CASE WHEN n >= 22 THEN 'ok' ELSE 'too_short' END AS status, {k} FROM m)"""


SQL["difference_order"] = _with(WEEKLY, DENSE, _kpss()) + """
SELECT *, CASE WHEN status = 'ok' THEN CASE WHEN coalesce(kpss0, 0) <= 0.463 THEN 0 WHEN coalesce(kpss1, 0) <= 0.463 THEN 1 ELSE 2 END
          END AS d FROM k"""
SQL["weekly_refresh"] = _with(WEEKLY) + "SELECT *, CAST(year(wk) AS INTEGER) AS year FROM weekly WHERE wk IS NOT NULL"


# --- one tree over the listing, from the train rows: levels written out one after the other ----------

_TABLE_DEPTH = 3


def _impurity(n: str, s: str, q: str) -> str:
    return f"(({q} - {s} * {s} / {n}) / {n})"


def _one_tree(fitted: str = "split = 'train'", tag: str = "") -> str:
    """Rows with their node per level (r0 to r3), splits per level (b0 to b2), nodes; ``tag`` ends the names."""
    value = "CASE feature WHEN 0 THEN c0 WHEN 1 THEN c1 ELSE c2 END"
    out = ["""r0 AS (
  SELECT *, {fitted} AS train FROM (
  SELECT CASE WHEN p_partkey % 10 < 6 THEN 'train' WHEN p_partkey % 10 < 8 THEN 'val' ELSE 'test' END AS split,
         p_brand_code AS c0, p_type_code AS c1, CAST(p_size AS DOUBLE) AS c2, round(p_retailprice * 100) AS y, 1 AS node
  FROM part JOIN ix USING (p_partkey)))""", "u AS (SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS feature)",
           "sizes AS (SELECT v, (v + lead(v) OVER (ORDER BY v)) / 2 AS cut FROM (SELECT DISTINCT c2 AS v FROM r0 WHERE train))"]
    for d in range(_TABLE_DEPTH):
        # labels stand in the order of their mean price, sizes in their own
        out.append(f"""h{d} AS (
  SELECT node, feature, {value} AS v, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s, sum(y * y) AS q
  FROM r{d} CROSS JOIN u WHERE train AND node >= {1 << d} GROUP BY ALL)""")
        out.append(f"""o{d} AS (
  SELECT node, feature, v, row_number() OVER w AS pos, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(q) OVER w AS ql,
         sum(n) OVER t AS nt, sum(s) OVER t AS st, sum(q) OVER t AS qt
  FROM h{d} WINDOW t AS (PARTITION BY node, feature), w AS (PARTITION BY node, feature
    ORDER BY CASE WHEN feature = 2 THEN v ELSE s / n END, v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
        left, right = _impurity("nl", "sl", "ql"), _impurity("(nt - nl)", "(st - sl)", "(qt - ql)")
        out.append(f"""b{d} AS (
  SELECT node, feature, pos, cut FROM (
    SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, pos) AS rk FROM (
      SELECT o.*, {_impurity("nt", "st", "qt")} - nl / nt * {left} - (nt - nl) / nt * {right} AS gain
      FROM o{d} o WHERE nl < nt AND abs({_impurity("nt", "st", "qt")}) > 1e-15) WHERE gain > 0) b
  LEFT JOIN sizes z ON b.feature = 2 AND z.v = b.v WHERE rk = 1)""")
        out.append(f"""r{d + 1} AS (
  SELECT r.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN r.node
         WHEN (CASE WHEN b.feature = 2 THEN r.c2 <= b.cut ELSE coalesce(o.pos <= b.pos, false) END) THEN 2 * r.node
         ELSE 2 * r.node + 1 END AS node
  FROM r{d} r LEFT JOIN b{d} b ON r.node = b.node
  LEFT JOIN o{d} o ON b.feature < 2 AND o.node = b.node AND o.feature = b.feature
                  AND o.v = CASE b.feature WHEN 0 THEN c0 ELSE c1 END)""")
    inner = " UNION ALL ".join(f"""
  SELECT b.node, b.feature, b.cut, (SELECT string_agg(CAST(CAST(o.v AS INTEGER) AS VARCHAR), ',' ORDER BY o.v) FROM o{d} o
         WHERE b.feature < 2 AND o.node = b.node AND o.feature = b.feature AND o.pos <= b.pos) AS codes FROM b{d} b""" for d in range(_TABLE_DEPTH))
    found = " UNION ALL ".join(f"SELECT node, count(*) AS n, sum(y) / count(*) AS value FROM r{d} WHERE train AND node >= {1 << d} GROUP BY node"
                               for d in range(_TABLE_DEPTH + 1))
    sql = ",\n".join([*out, f"inner_nodes AS ({inner})", f"nodes AS ({found})"]).replace("{fitted}", fitted)
    names = [f"{c}{d}" for c in "rhob" for d in range(_TABLE_DEPTH + 1)] + ["u", "sizes", "inner_nodes", "nodes"]
    for n in names if tag else ():
        sql = re.sub(rf"\b{n} AS \(", f"{n}{tag} AS (", re.sub(rf"\b(FROM|JOIN) {n}\b", rf"\1 {n}{tag}", sql))
    return sql


SQL["forest_table"] = _with(INDEXED, _one_tree()) + """
SELECT 0 AS tree, node, feature, cut AS threshold, codes AS left_codes, n, round(value, 4) AS value
FROM nodes LEFT JOIN inner_nodes USING (node)"""
SQL["forest_table_scores"] = _with(INDEXED, _one_tree()) + f"""
SELECT split, count(*) AS n_scored, round(avg(value), 3) AS mean_pred, round(sqrt(avg(power((y - value) / 100, 2))), 5) AS rmse
FROM r{_TABLE_DEPTH} JOIN nodes USING (node) GROUP BY split"""
# depths 1 to 3 judged on validation rows, the best (ties: the least deep) fitted again on train and validation rows
_REFIT = _one_tree("split <> 'test'", "_re")


def _missed_by(split: str, depth: int, tag: str = "") -> str:
    """A tree of fewer levels is the top of the deeper one."""
    return (f"SELECT 'x' AS stage, {depth} AS max_depth, round(sqrt(avg(power((y - value) / 100, 2))), 5) AS rmse, count(*) AS n_scored "
            f"FROM r{depth}{tag} JOIN nodes{tag} USING (node) WHERE split = '{split}'")


SQL["forest_search"] = _with(INDEXED, _one_tree(), _REFIT) + ", trial AS (" + " UNION ALL ".join(
    _missed_by("val", d).replace("'x'", "'trial'") for d in (1, 2, 3)) + "), final AS (" + " UNION ALL ".join(
    _missed_by("test", d, "_re").replace("'x'", "'final'") for d in (1, 2, 3)) + """)
SELECT * FROM trial UNION ALL
SELECT * FROM final WHERE max_depth = (SELECT max_depth FROM trial ORDER BY rmse, max_depth LIMIT 1)"""
SQL["table_diff"] = _with(WEEKLY, WEEKLY.replace("weekly AS", "early AS").replace("GROUP BY", "WHERE l_orderkey % 500 <> 0 GROUP BY")) + """
SELECT w.product, w.sku, w.wk, CASE WHEN e.wk IS NULL THEN 'added' ELSE 'changed' END AS change,
       CASE WHEN e.wk IS NULL THEN 0 ELSE 1 END AS n_left, 1 AS n_right
FROM weekly w LEFT JOIN early e ON w.product = e.product AND w.sku = e.sku AND w.wk = e.wk
WHERE e.wk IS NULL OR e.demand <> w.demand"""
