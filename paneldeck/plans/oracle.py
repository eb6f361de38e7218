"""DuckDB SQL that computes the same results as the Spark queries.

The CTEs mirror ``paneldeck.plans.bindings``; each query's final SELECT
applies the same rounding as ``finalize``.
"""

from __future__ import annotations

from paneldeck.functions.dictionaries import PART_KEYWORDS
from paneldeck.plans import bindings as B

CATS = list(PART_KEYWORDS)


def r(expr: str, scale: int = 6) -> str:
    return f"(round(CAST({expr} AS DOUBLE), {scale}) + 0.0)"


def _rx(p: str) -> str:
    return "'(?i)" + p.replace("'", "''") + "'"


def unicode_words(text: str) -> str:
    """Java (and the reference's Python) treat accented letters and
    non-ASCII digits as word characters for ``\\b``; RE2 does not.  Mapping
    them to an ASCII letter / digit gives RE2 the same boundaries (dictionary
    words are ASCII, so nothing else about a match changes)."""
    return (f"regexp_replace(regexp_replace({text}, '[^\\x00-\\x7F\\P{{L}}]', 'x', 'g'), "
            f"'[^\\x00-\\x7F\\P{{N}}]', '0', 'g')")


def flag(text: str, pattern: str) -> str:
    return f"CASE WHEN regexp_matches({text}, {_rx(pattern)}) THEN 1 ELSE 0 END"


def mentions(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {_rx(pattern)}))"


WEEK = "CAST(floor(datediff('day', {o}, {d}) / 7.0) AS INTEGER)"

FOOD_ROWS = """fr AS (
  SELECT o.o_custkey AS subject_id, CAST(o.o_orderdate AS DATE) AS date, p.p_name AS food, p.p_type AS category,
         l.l_quantity AS fiber_g, l.l_extendedprice AS calories_kcal, l.l_extendedprice * l.l_discount AS carb_g,
         l.l_extendedprice * l.l_tax AS protein_g, CAST(p.p_size AS DOUBLE) AS fat_g,
         l.l_orderkey AS order_key, l.l_linenumber AS line_no
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)"""

DAILY = """daily AS (
  SELECT subject_id, date,
         coalesce(sum(fiber_g), 0) AS fiber_g_total, coalesce(sum(calories_kcal), 0) AS calories_kcal_total,
         coalesce(sum(carb_g), 0) AS carb_g_total, coalesce(sum(protein_g), 0) AS protein_g_total,
         coalesce(sum(fat_g), 0) AS fat_g_total, count(*) AS n_entries
  FROM fr WHERE date IS NOT NULL AND subject_id IS NOT NULL GROUP BY subject_id, date)"""


def kwd_cte() -> str:
    flags = ",\n         ".join(f"CAST(max({flag('lower(coalesce(food, \'\'))', p)}) AS INTEGER) AS kw_{c}"
                               for c, p in PART_KEYWORDS.items())
    return f"""kwd AS (
  SELECT subject_id, date,
         {flags}
  FROM fr WHERE date IS NOT NULL AND subject_id IS NOT NULL GROUP BY subject_id, date)"""


def dflags_cte() -> str:
    fills = ", ".join(f"CAST(coalesce(k.kw_{c}, 0) AS INTEGER) AS kw_{c}" for c in CATS)
    return f"""dflags AS (
  SELECT d.*, {fills}
  FROM daily d LEFT JOIN kwd k ON d.subject_id = k.subject_id AND d.date = k.date)"""


def weekly_cte() -> str:
    parts = []
    for n in B.DAILY_NUTRIENTS:
        parts.append(f"avg({n}) AS {n}_week_mean")
        parts.append(f"coalesce(sum({n}), 0) AS {n}_week_sum")
    parts.append("CAST(coalesce(sum(n_entries), 0) AS BIGINT) AS n_entries_week_sum")
    for c in CATS:
        parts.append(f"avg(kw_{c}) AS share_of_days_kw_{c}")
        parts.append(f"CAST(max(kw_{c}) AS INTEGER) AS any_kw_{c}")
    body = ",\n         ".join(parts)
    return f"""dweek AS (
  SELECT *, {WEEK.format(o='min(date) OVER (PARTITION BY subject_id)', d='date')} AS week_index FROM dflags),
weekly AS (
  SELECT subject_id, week_index,
         {body}
  FROM dweek WHERE week_index IS NOT NULL GROUP BY subject_id, week_index)"""


MEASURES = f"""origin AS (SELECT subject_id, min(date) AS origin_date FROM daily GROUP BY subject_id),
meas AS (
  SELECT o.o_custkey AS subject_id, 'weight' AS metric,
         CASE WHEN {WEEK.format(o='g.origin_date', d='CAST(o.o_orderdate AS DATE)')} <= 0 THEN 'start' ELSE 'end' END AS phase,
         {WEEK.format(o='g.origin_date', d='CAST(o.o_orderdate AS DATE)')} AS week,
         o.o_totalprice AS value, o.o_orderkey AS tp_index, CAST(NULL AS VARCHAR) AS note,
         CAST(o.o_orderdate AS DATE) AS date
  FROM orders o JOIN origin g ON o.o_custkey = g.subject_id)"""

TRAJ_LONG = """wc AS (
  SELECT subject_id, week, value, tp_index, phase, note FROM meas
  WHERE metric = 'weight' AND ((phase = 'start' AND week = 0) OR phase = 'end')
    AND value IS NOT NULL AND NOT isnan(value)),
st AS (
  SELECT subject_id, arg_min(value, tp_index) FILTER (WHERE week = 0) AS start_weight,
         CAST(regr_count(value, CAST(week AS DOUBLE)) AS BIGINT) AS n,
         regr_slope(value, CAST(week AS DOUBLE)) AS b, regr_intercept(value, CAST(week AS DOUBLE)) AS a,
         regr_sxx(value, CAST(week AS DOUBLE)) AS sxx, regr_syy(value, CAST(week AS DOUBLE)) AS syy,
         regr_sxy(value, CAST(week AS DOUBLE)) AS sxy
  FROM wc GROUP BY subject_id),
traj AS (
  SELECT w.subject_id, w.week, w.value, s.start_weight, w.value - s.start_weight AS delta_kg,
         (w.value / s.start_weight - 1) * 100 AS pct_change, w.phase, w.note,
         CASE WHEN s.n >= 2 THEN s.b END AS slope_kg_per_week, w.tp_index
  FROM wc w JOIN st s ON w.subject_id = s.subject_id WHERE s.start_weight IS NOT NULL)"""


def long_base(*extra: str) -> str:
    ctes = [FOOD_ROWS, DAILY, kwd_cte(), dflags_cte(), weekly_cte(), MEASURES, TRAJ_LONG, *extra]
    return "WITH " + ",\n".join(ctes) + "\n"


def weekly_long_select() -> str:
    cols = ["subject_id", "week_index"]
    for n in B.DAILY_NUTRIENTS:
        cols += [r(f"{n}_week_mean", 6) + f" AS {n}_week_mean", r(f"{n}_week_sum", 4) + f" AS {n}_week_sum"]
    cols.append("n_entries_week_sum")
    for c in CATS:
        cols += [r(f"share_of_days_kw_{c}") + f" AS share_of_days_kw_{c}", f"any_kw_{c}"]
    return ", ".join(cols)


# ---------------------------------------------------------------- wide dialect
EVENTS = """ev AS (
  SELECT user_id AS subject_id, CAST(ts AS DATE) AS date, event_type,
         CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events)"""

MEAS_WIDE = f"""mw0 AS (
  SELECT subject_id, date,
         avg(CASE WHEN event_type = 'purchase' THEN value END) AS weight_kg,
         avg(CASE WHEN event_type = 'click' THEN value END) AS energy_1_10,
         avg(CASE WHEN event_type = 'view' THEN value END) AS mood_1_10
  FROM ev GROUP BY subject_id, date),
mw AS (SELECT *, {WEEK.format(o='min(date) OVER (PARTITION BY subject_id)', d='date')} + 1 AS week FROM mw0)"""

TRAJ_WIDE = """tw0 AS (
  SELECT *, lag(weight_kg) OVER (PARTITION BY subject_id ORDER BY date) AS weight_kg_prev,
         first_value(weight_kg IGNORE NULLS) OVER (PARTITION BY subject_id ORDER BY date
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS baseline_weight_kg,
         CASE WHEN weight_kg IS NOT NULL THEN count(weight_kg) OVER (PARTITION BY subject_id ORDER BY date
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 END AS idx,
         count(weight_kg) OVER (PARTITION BY subject_id) AS n_valid
  FROM mw),
tw1 AS (
  SELECT *, weight_kg - weight_kg_prev AS delta_kg,
         CASE WHEN n_valid >= 3 THEN regr_slope(weight_kg, CAST(idx AS DOUBLE)) OVER (PARTITION BY subject_id) END
             AS weight_slope_kg_per_week
  FROM tw0),
traj_w AS (
  SELECT subject_id, date, week, weight_kg, energy_1_10, mood_1_10, delta_kg,
         CASE WHEN weight_kg_prev <> 0 THEN delta_kg / weight_kg_prev END * 100 AS delta_kg_pct,
         lead(delta_kg) OVER (PARTITION BY subject_id ORDER BY date) AS delta_kg_next,
         baseline_weight_kg, weight_kg - baseline_weight_kg AS delta_from_baseline_kg,
         CASE WHEN baseline_weight_kg <> 0 THEN (weight_kg - baseline_weight_kg) / baseline_weight_kg END * 100
             AS delta_from_baseline_pct,
         weight_slope_kg_per_week
  FROM tw1)"""

DAILY_WIDE = f"""dw0 AS (
  SELECT subject_id, date, sum(value) AS total_calories,
         sum(CASE WHEN event_type = 'click' THEN value END) AS total_fiber_g
  FROM ev GROUP BY subject_id, date),
dw AS (SELECT *, {WEEK.format(o='min(date) OVER (PARTITION BY subject_id)', d='date')} + 1 AS week FROM dw0),
ww AS (
  SELECT subject_id, week,
         avg(total_calories) AS calories_mean, coalesce(sum(total_calories), 0) AS calories_sum,
         stddev_samp(total_calories) AS calories_std, count(total_calories) AS calories_days,
         avg(total_fiber_g) AS fiber_g_mean, coalesce(sum(total_fiber_g), 0) AS fiber_g_sum,
         stddev_samp(total_fiber_g) AS fiber_g_std, count(total_fiber_g) AS fiber_days
  FROM dw WHERE week IS NOT NULL GROUP BY subject_id, week),
weekly_w AS (
  SELECT *, calories_sum AS calories_week, fiber_g_sum AS fiber_g_week, calories_mean AS calories_day_avg,
         fiber_g_mean AS fiber_g_day_avg,
         CASE WHEN calories_sum <> 0 THEN fiber_g_sum / calories_sum END * 1000 AS fiber_per_1000_cal
  FROM ww)"""


def kw_wide_cte() -> str:
    parts = []
    for c, p in PART_KEYWORDS.items():
        parts.append(f"CAST(max({flag('t', p)}) AS INTEGER) AS {c}_week")
        parts.append(f"CAST(coalesce(sum({mentions('t', p)}), 0) AS INTEGER) AS {c}_mentions")
    body = ",\n         ".join(parts)
    variety = " + ".join(f"{c}_week" for c in CATS)
    return f"""fw AS (
  SELECT subject_id, date, lower(coalesce(food, '')) AS t,
         {WEEK.format(o='min(date) OVER (PARTITION BY subject_id)', d='date')} + 1 AS week FROM fr),
kw0 AS (
  SELECT subject_id, week,
         {body},
         CAST(count(*) AS INTEGER) AS food_entries_week
  FROM fw WHERE week IS NOT NULL GROUP BY subject_id, week),
kw_w AS (SELECT *, CAST({variety} AS INTEGER) AS food_variety_categories FROM kw0)"""


def merge_wide_cte(fill: str) -> str:
    if fill == "reference":
        fills = ["coalesce(w.fiber_g_week, 0) AS fiber_g_week", "coalesce(w.calories_week, 0) AS calories_week",
                 "coalesce(k.food_entries_week, 0) AS food_entries_week",
                 "coalesce(t.weight_slope_kg_per_week, 0) AS weight_slope_kg_per_week"]
    else:
        fills = ["w.fiber_g_week AS fiber_g_week", "w.calories_week AS calories_week",
                 "k.food_entries_week AS food_entries_week", "t.weight_slope_kg_per_week AS weight_slope_kg_per_week"]
    flags = ", ".join(f"CAST(coalesce(k.{c}_week, 0) AS INTEGER) AS {c}_week"
                      for c in CATS)
    return f"""m0 AS (
  SELECT t.subject_id, t.date, t.week, t.weight_kg, t.delta_kg, t.delta_kg_next, t.baseline_weight_kg,
         {', '.join(fills)}, {flags}, k.food_variety_categories
  FROM traj_w t
  LEFT JOIN weekly_w w ON t.subject_id = w.subject_id AND t.week = w.week
  LEFT JOIN kw_w k ON t.subject_id = k.subject_id AND t.week = k.week),
med AS (SELECT median(fiber_g_week) AS fm, median(calories_week) AS cm FROM m0),
merged AS (
  SELECT m0.*, CAST(coalesce(CAST(fiber_g_week > fm AS INTEGER), 0) AS INTEGER) AS high_fiber_week,
         CAST(coalesce(CAST(calories_week > cm AS INTEGER), 0) AS INTEGER) AS high_calorie_week
  FROM m0, med WHERE delta_kg_next IS NOT NULL)"""


def wide_base(*extra: str) -> str:
    ctes = [FOOD_ROWS, EVENTS, MEAS_WIDE, TRAJ_WIDE, DAILY_WIDE, kw_wide_cte(), *extra]
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- model panels
ANALYSIS_LONG = """al AS (
  SELECT t.subject_id, t.week, t.tp_index, t.value, t.delta_kg, t.pct_change,
         lead(t.delta_kg) OVER (PARTITION BY t.subject_id ORDER BY t.week, t.tp_index) AS delta_kg_next,
         w.* EXCLUDE (subject_id, week_index)
  FROM traj t LEFT JOIN weekly w ON t.subject_id = w.subject_id AND t.week = w.week_index)"""


def model_long(*extra: str) -> str:
    return long_base(ANALYSIS_LONG, *extra)


def model_wide(*extra: str) -> str:
    return wide_base(merge_wide_cte("reference"), *extra)


def ols1_sql(panel: str, y: str, x: str) -> str:
    return f""", d AS (SELECT {y} AS y, {x} AS x FROM {panel} WHERE {y} IS NOT NULL AND {x} IS NOT NULL),
s AS (SELECT count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx,
             regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, avg(x) AS mx FROM d),
f AS (SELECT *, greatest(syy - b * sxy, 0) AS rss, greatest(syy - b * sxy, 0) / (n - 2) AS mse FROM s)
SELECT 'intercept' AS term, {r('a')} AS coef, {r('sqrt(mse * (1.0 / n + mx * mx / sxx))')} AS se,
       {r('a / sqrt(mse * (1.0 / n + mx * mx / sxx))')} AS t_stat, {r('1 - rss / syy')} AS r_squared,
       CAST(n AS BIGINT) AS n_obs, CAST(n - 2 AS BIGINT) AS df_resid FROM f
UNION ALL
SELECT '{x}', {r('b')}, {r('sqrt(mse / sxx)')}, {r('b / sqrt(mse / sxx)')}, {r('1 - rss / syy')},
       CAST(n AS BIGINT), CAST(n - 2 AS BIGINT) FROM f"""


def ols2_sql(panel: str, y: str, x1: str, x2: str) -> str:
    return f""", d AS (SELECT {y} AS y, {x1} AS x1, {x2} AS x2 FROM {panel}
           WHERE {y} IS NOT NULL AND {x1} IS NOT NULL AND {x2} IS NOT NULL),
s AS (SELECT count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my,
             var_pop(x1) * count(*) AS s11, var_pop(x2) * count(*) AS s22, covar_pop(x1, x2) * count(*) AS s12,
             covar_pop(x1, y) * count(*) AS s1y, covar_pop(x2, y) * count(*) AS s2y, var_pop(y) * count(*) AS syy FROM d),
c AS (SELECT *, s11 * s22 - s12 * s12 AS det FROM s),
b AS (SELECT *, (s22 * s1y - s12 * s2y) / det AS b1, (s11 * s2y - s12 * s1y) / det AS b2 FROM c),
f AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, greatest(syy - b1 * s1y - b2 * s2y, 0) AS rss,
             greatest(syy - b1 * s1y - b2 * s2y, 0) / (n - 3) AS mse FROM b),
g AS (SELECT *, sqrt(mse * (1.0 / n + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / det)) AS se0,
             sqrt(mse * s22 / det) AS se1, sqrt(mse * s11 / det) AS se2 FROM f)
SELECT 'intercept' AS term, {r('b0')} AS coef, {r('se0')} AS se, {r('b0 / se0')} AS t_stat,
       {r('1 - rss / syy')} AS r_squared, CAST(n AS BIGINT) AS n_obs, CAST(n - 3 AS BIGINT) AS df_resid FROM g
UNION ALL SELECT '{x1}', {r('b1')}, {r('se1')}, {r('b1 / se1')}, {r('1 - rss / syy')}, CAST(n AS BIGINT), CAST(n - 3 AS BIGINT) FROM g
UNION ALL SELECT '{x2}', {r('b2')}, {r('se2')}, {r('b2 / se2')}, {r('1 - rss / syy')}, CAST(n AS BIGINT), CAST(n - 3 AS BIGINT) FROM g"""


def fe1_sql(panel: str, y: str, x: str, group: str = "subject_id") -> str:
    return f""", d AS (SELECT {group} AS g, {y} AS y, {x} AS x FROM {panel} WHERE {y} IS NOT NULL AND {x} IS NOT NULL AND {group} IS NOT NULL),
dm AS (SELECT g, x - avg(x) OVER (PARTITION BY g) AS xt, y - avg(y) OVER (PARTITION BY g) AS yt FROM d),
s AS (SELECT count(*) AS n, sum(xt * xt) AS sxx, sum(xt * yt) AS sxy, sum(yt * yt) AS syy FROM dm),
f AS (SELECT *, sxy / sxx AS b, greatest(syy - sxy * sxy / sxx, 0) AS rss FROM s)
SELECT '{x}' AS term, {r('b')} AS coef, {r('sqrt(rss / (n - 1) / sxx)')} AS se, {r('b / sqrt(rss / (n - 1) / sxx)')} AS t_stat,
       {r('1 - rss / syy')} AS r_squared_within, CAST(n AS BIGINT) AS n_obs, CAST(n - 1 AS BIGINT) AS df_resid FROM f"""


def cluster1_sql(panel: str, y: str, x: str, group: str = "subject_id") -> str:
    return f""", d AS (SELECT {group} AS g, {y} AS y, {x} AS x FROM {panel} WHERE {y} IS NOT NULL AND {x} IS NOT NULL AND {group} IS NOT NULL),
dm AS (SELECT g, y, x - avg(x) OVER (PARTITION BY g) AS xt, y - avg(y) OVER (PARTITION BY g) AS yt FROM d),
s AS (SELECT count(*) AS n, count(DISTINCT g) AS gg, sum(xt * xt) AS sxx, sum(xt * yt) AS sxy, sum(yt * yt) AS wyy,
             var_pop(y) * count(*) AS tss FROM dm),
b AS (SELECT *, sxy / sxx AS beta FROM s),
sc AS (SELECT dm.g, sum(dm.xt * (dm.yt - b.beta * dm.xt)) AS sg FROM dm, b GROUP BY dm.g),
m AS (SELECT sum(sg * sg) AS meat FROM sc),
f AS (SELECT b.*, m.meat, sqrt(gg / (gg - 1.0) * (n - 1.0) / (n - 1.0 - gg) * meat / (sxx * sxx)) AS se,
             greatest(wyy - beta * sxy, 0) AS rss FROM b, m)
SELECT '{x}' AS term, {r('beta', 4)} AS coef, {r('se', 4)} AS se, {r('beta / se', 4)} AS z_stat,
       {r('1 - rss / tss')} AS r_squared, CAST(n AS BIGINT) AS n_obs, CAST(gg AS BIGINT) AS n_clusters FROM f"""


def within_slopes_sql(panel: str, y: str, x1: str, x2: str, group: str = "subject_id") -> str:
    return f""", d AS (SELECT {group} AS g, {y} AS y, {x1} AS x1, {x2} AS x2 FROM {panel}
           WHERE {y} IS NOT NULL AND {x1} IS NOT NULL AND {x2} IS NOT NULL AND {group} IS NOT NULL),
s AS (SELECT g, count(*) AS n, var_pop(x1) * count(*) AS w11, var_pop(x2) * count(*) AS w22,
             covar_pop(x1, x2) * count(*) AS w12, covar_pop(x1, y) * count(*) AS w1y, covar_pop(x2, y) * count(*) AS w2y
      FROM d GROUP BY g HAVING count(*) >= 3),
c AS (SELECT *, w11 * w22 - w12 * w12 AS det, w11 + w22 AS tr FROM s),
b AS (SELECT g, CASE WHEN abs(det) > 1e-9 * tr * tr THEN (w22 * w1y - w12 * w2y) / det
                     WHEN tr = 0 THEN 0.0
                     ELSE (w11 * w1y + w12 * w2y) / (tr * tr) END AS b1 FROM c)
SELECT {r('avg(b1)', 4)} AS within_subject_mean, {r('stddev_pop(b1)', 4)} AS within_subject_std,
       CAST(count(b1) AS BIGINT) AS within_subject_n FROM b"""


def within_slope_list_sql(panel: str, y: str, x1: str, x2: str, group: str = "subject_id") -> str:
    body = within_slopes_sql(panel, y, x1, x2, group)
    head = body[:body.rindex("SELECT ")]
    return head + f"SELECT g AS {group}, {r('b1', 4)} AS coef_x1 FROM b"


def _avg_rank(col: str, src: str) -> str:
    return f"(rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0)"


def spearman_sql(panel: str, x: str, y: str) -> str:
    return f""", d AS (SELECT {x} AS x, {y} AS y FROM {panel} WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
rk AS (SELECT {_avg_rank('x', 'd')} AS rx, {_avg_rank('y', 'd')} AS ry FROM d),
s AS (SELECT count(*) AS n, CASE WHEN count(*) >= 10 AND var_pop(rx) > 0 AND var_pop(ry) > 0
                                 THEN covar_pop(rx, ry) / sqrt(var_pop(rx) * var_pop(ry)) END AS rho FROM rk)
SELECT CAST(n AS BIGINT) AS n, {r('rho')} AS rho,
       {r('CASE WHEN rho * rho < 1 THEN rho * sqrt((n - 2) / (1 - rho * rho)) END')} AS t_stat FROM s"""


def pearson_sql(panel: str, x: str, y: str) -> str:
    return f""", d AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {panel} WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
s AS (SELECT count(*) AS n, CASE WHEN var_pop(x) * var_pop(y) > 0 THEN covar_pop(x, y) / sqrt(var_pop(x) * var_pop(y)) END AS r FROM d)
SELECT CAST(n AS BIGINT) AS n, {r('r')} AS r,
       {r('CASE WHEN r * r < 1 THEN r * sqrt((n - 2) / (1 - r * r)) END')} AS t_stat FROM s"""


def mann_whitney_sql(panel: str, y: str, flag: str) -> str:
    return f"""SELECT '{flag}' AS flag, CAST(count(*) FILTER (WHERE f = 1) AS BIGINT) AS n1,
       CAST(count(*) FILTER (WHERE f = 0) AS BIGINT) AS n0,
       {r('median(v) FILTER (WHERE f = 1)')} AS median_1, {r('median(v) FILTER (WHERE f = 0)')} AS median_0,
       {r('sum(rk) FILTER (WHERE f = 1) - count(*) FILTER (WHERE f = 1) * (count(*) FILTER (WHERE f = 1) + 1) / 2.0')} AS u_stat,
       {r('(SELECT sum(c * c * c - c) FROM (SELECT count(*) AS c FROM ' + panel + ' WHERE ' + y + ' IS NOT NULL AND ' + flag + ' IS NOT NULL GROUP BY ' + y + '))')} AS tie_term
FROM (SELECT {y} AS v, {flag} AS f, {_avg_rank(y, panel)} AS rk FROM {panel} WHERE {y} IS NOT NULL AND {flag} IS NOT NULL)"""


def trend_sql(panel: str, x: str, y: str, points: int = 100) -> str:
    return f""", d AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {panel} WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
s AS (SELECT regr_count(y, x) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx,
             regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, min(x) AS lo, max(x) AS hi, avg(x) AS xb FROM d),
g AS (SELECT s.*, i, lo + (hi - lo) * i / {points - 1}.0 AS gx FROM s, range(0, {points}) t(i) WHERE b IS NOT NULL)
SELECT CAST(i AS INTEGER) AS i, {r('gx', 4)} AS x, {r('a + b * gx', 4)} AS yhat,
       {r('sqrt(greatest(syy - b * sxy, 0) / (n - 2)) * sqrt(1.0 / n + (gx - xb) * (gx - xb) / sxx)', 4)} AS se_mean FROM g"""


# ---------------------------------------------------------------- descriptive
PARTICIPANTS = """pp0 AS (
  SELECT o.o_custkey AS subject_id, first(c.c_mktsegment ORDER BY o.o_orderdate, o.o_orderkey) AS category,
         first(o.o_totalprice ORDER BY o.o_orderdate, o.o_orderkey) AS starting_weight,
         last(o.o_totalprice ORDER BY o.o_orderdate, o.o_orderkey) AS ending_weight,
         count(*) AS num_measurements
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_totalprice IS NOT NULL GROUP BY o.o_custkey HAVING count(*) >= 2),
pp AS (SELECT *, ending_weight - starting_weight AS weight_change,
              (ending_weight - starting_weight) / starting_weight * 100 AS weight_change_percent FROM pp0)"""


def duration_case(col: str) -> str:
    return (f"CASE WHEN {col} >= 28 THEN '4+ Weeks' WHEN {col} >= 14 THEN '2-4 Weeks' "
            f"WHEN {col} >= 7 THEN '1-2 Weeks' ELSE '< 1 Week' END")


def participants_base(*extra: str) -> str:
    return "WITH " + ",\n".join([PARTICIPANTS, *extra]) + "\n"


# ---------------------------------------------------------------- data quality
def _sql_lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else repr(v)


def rule_sql(rule, table: str) -> str:
    """The same evaluation as operators.quality.evaluate, as one SQL SELECT."""
    c, k = rule.column, rule.kind
    head = f"SELECT '{table}' AS table_name, '{rule.name}' AS rule, {('' + repr(c)) if c else 'NULL'} AS column_name"
    head = head.replace('"', "'")
    if k in ("row_count_between", "max_between", "mean_between", "stdev_between", "quantile_between"):
        obs = {"row_count_between": "CAST(count(*) AS DOUBLE)",
               "max_between": (f"CAST(date_diff('day', DATE '1970-01-01', CAST(max({c}) AS DATE)) AS DOUBLE)"
                               if rule.is_date else f"CAST(max({c}) AS DOUBLE)"),
               "mean_between": f"avg({c})", "stdev_between": f"stddev_samp({c})",
               "quantile_between": f"quantile_cont({c}, {rule.quantile})"}[k]
        conds = [f"({obs}) IS NOT NULL"]
        if rule.min_value is not None:
            conds.append(f"({obs}) >= {rule.bound(rule.min_value)!r}")
        if rule.max_value is not None:
            conds.append(f"({obs}) <= {rule.bound(rule.max_value)!r}")
        return (f"{head}, CAST(count(*) AS BIGINT) AS n, CAST(NULL AS BIGINT) AS n_fail, CAST(NULL AS DOUBLE) AS ratio, "
                f"{r(obs)} AS observed, CAST(NULL AS DOUBLE) AS mostly, coalesce({' AND '.join(conds)}, false) AS success "
                f"FROM {table}")
    evaluated, passes = rule_predicates_sql(rule)
    n = f"count(*) FILTER (WHERE {evaluated})"
    nf = f"count(*) FILTER (WHERE ({evaluated}) AND NOT coalesce({passes}, false))"
    ratio = f"CASE WHEN {n} > 0 THEN CAST({n} - {nf} AS DOUBLE) / {n} END"
    return (f"{head}, CAST({n} AS BIGINT) AS n, CAST({nf} AS BIGINT) AS n_fail, {r(ratio)} AS ratio, "
            f"CAST(NULL AS DOUBLE) AS observed, {r(repr(float(rule.mostly)))} AS mostly, "
            f"coalesce({ratio} >= {float(rule.mostly)!r}, true) AS success FROM {table}")


def rule_predicates_sql(rule) -> tuple[str, str]:
    """(evaluated-row predicate, passing predicate) of a row rule in SQL."""
    c, k = rule.column, rule.kind
    evaluated = {"not_null": "true"}.get(k, f"{c} IS NOT NULL")
    if k in ("pair_ge", "pair_equal", "pair_not_equal"):
        evaluated = f"{c} IS NOT NULL AND {rule.other} IS NOT NULL"
    if k == "not_null":
        passes = f"{c} IS NOT NULL"
    elif k == "between":
        parts = ["true"]
        if rule.min_value is not None:
            parts.append(f"{c} >= {rule.min_value!r}")
        if rule.max_value is not None:
            parts.append(f"{c} <= {rule.max_value!r}")
        passes = " AND ".join(parts)
    elif k == "in_set":
        passes = f"{c} IN ({', '.join(_sql_lit(v) for v in rule.values)})"
    elif k == "regex":
        passes = f"regexp_matches(CAST({c} AS VARCHAR), '{rule.pattern}')"
    elif k == "length_between":
        passes = f"length({c}) BETWEEN {rule.min_value} AND {rule.max_value}"
    elif k == "pair_ge":
        passes = f"{c} >= {rule.other}"
    elif k == "pair_equal":
        passes = f"{c} = {rule.other}"
    elif k == "pair_not_equal":
        passes = f"{c} <> {rule.other}"
    elif k == "castable":
        passes = f"TRY_CAST(CAST({c} AS VARCHAR) AS {rule.type_name.upper()}) IS NOT NULL"
    else:
        raise ValueError(k)
    return evaluated, passes


# ---------------------------------------------------------------- cell tables
def _parse_num(v: str) -> str:
    s = f"trim({v})"
    cleaned = f"regexp_replace(regexp_replace({s}, '[^0-9.,+\\-]', '', 'g'), ',', '', 'g')"
    return (f"(CASE WHEN {s} IS NULL OR lower({s}) IN ('', 'nan', 'none', 'null') THEN NULL "
            f"WHEN {cleaned} = '' THEN NULL ELSE TRY_CAST({cleaned} AS DOUBLE) END)")


def _mixed_date(v: str) -> str:
    s = f"trim({v})"
    return (f"(CASE WHEN TRY_CAST({s} AS DOUBLE) IS NOT NULL "
            f"THEN DATE '1899-12-30' + CAST(floor(TRY_CAST({s} AS DOUBLE)) AS INTEGER) "
            f"ELSE CAST(coalesce(try_strptime({s}, '%Y-%m-%d'), try_strptime({s}, '%Y-%m-%d %H:%M:%S'), "
            f"try_strptime({s}, '%m/%d/%Y'), try_strptime({s}, '%Y/%m/%d')) AS DATE) END)")


def _norm(v: str) -> str:
    # white space as the reference's rule has it (Unicode), collapsed before the ends are cut
    white = ("[\\s\\x0B\\x1C-\\x1F\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}"
             "\\x{202F}\\x{205F}\\x{3000}]+")
    return f"trim(regexp_replace(lower(coalesce(CAST({v} AS VARCHAR), '')), '{white}', ' ', 'g'))"


FOOD_CELLS = """fl AS (
  SELECT 'logs/customer_' || CAST(o.o_custkey AS VARCHAR) || '.xlsx' AS source_path,
         'order_' || CAST(o.o_orderkey AS VARCHAR) AS sheet_name,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS off,
         row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_quantity,
                            l.l_extendedprice, l.l_tax, l.l_returnflag) AS rn,
         CAST(o.o_orderdate AS DATE) AS day, l.l_returnflag, p.p_name, l.l_quantity, l.l_extendedprice, l.l_tax,
         o.o_custkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey),
fsheets AS (SELECT DISTINCT source_path, sheet_name, off FROM fl),
cells_f AS (
  SELECT source_path, sheet_name, CAST(rn + off AS INTEGER) AS row_no, 0 AS col_no,
         CASE WHEN l_returnflag = 'R' THEN CAST(datediff('day', DATE '1899-12-30', day) AS VARCHAR)
              ELSE strftime(day, '%Y-%m-%d') END AS value FROM fl
  UNION ALL SELECT source_path, sheet_name, CAST(rn + off AS INTEGER), 1, p_name FROM fl
  UNION ALL SELECT source_path, sheet_name, CAST(rn + off AS INTEGER), 2, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' g' FROM fl
  UNION ALL SELECT source_path, sheet_name, CAST(rn + off AS INTEGER), 3, '~' || CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) FROM fl
  UNION ALL SELECT source_path, sheet_name, CAST(rn + off AS INTEGER), 4, CAST(CAST(floor(l_tax * 100) AS BIGINT) AS VARCHAR) || 'g/day' FROM fl
  UNION ALL SELECT source_path, sheet_name, CAST(rn + off AS INTEGER), 5, CASE WHEN rn = 1 THEN CAST(o_custkey AS VARCHAR) END FROM fl
  UNION ALL SELECT source_path, sheet_name, off, 0, 'Date' FROM fsheets
  UNION ALL SELECT source_path, sheet_name, off, 1, 'Food Item' FROM fsheets
  UNION ALL SELECT source_path, sheet_name, off, 2, 'Dietary Fiber (g)' FROM fsheets
  UNION ALL SELECT source_path, sheet_name, off, 3, 'Calories' FROM fsheets
  UNION ALL SELECT source_path, sheet_name, off, 4, 'Protein (g)' FROM fsheets
  UNION ALL SELECT source_path, sheet_name, off, 5, 'Subject ID' FROM fsheets
  UNION ALL SELECT source_path, sheet_name, 0, 0, 'Daily food log' FROM fsheets WHERE off = 1)"""

LABEL_CELLS = """lw AS (
  SELECT m.subject_id, m.week, arg_min(m.value, m.tp_index) AS weight, count(*) AS energy,
         count(*) FILTER (WHERE o.o_orderstatus = 'F') AS mood
  FROM meas m JOIN orders o ON m.tp_index = o.o_orderkey WHERE m.week >= 0 GROUP BY m.subject_id, m.week),
lw2 AS (SELECT *, 'logs/customer_' || CAST(subject_id AS VARCHAR) || '.xlsx' AS source_path, 'measures' AS sheet_name,
               row_number() OVER (PARTITION BY subject_id ORDER BY week) AS k FROM lw),
cells_l AS (
  SELECT source_path, sheet_name, CAST(2 + (k - 1) * 3 + 0 AS INTEGER) AS row_no, 0 AS col_no,
         CASE WHEN week = 0 THEN 'Starting Weight' ELSE 'Weight End Week ' || CAST(week AS VARCHAR) END AS value FROM lw2
  UNION ALL SELECT source_path, sheet_name, CAST(2 + (k - 1) * 3 AS INTEGER), 1, CAST(weight AS VARCHAR) FROM lw2
  UNION ALL SELECT source_path, sheet_name, CAST(2 + (k - 1) * 3 + 1 AS INTEGER), 0,
         CASE WHEN week = 0 THEN 'Starting Energy' ELSE 'Energy End Week ' || CAST(week AS VARCHAR) END FROM lw2
  UNION ALL SELECT source_path, sheet_name, CAST(2 + (k - 1) * 3 + 1 AS INTEGER), 1, CAST(energy AS VARCHAR) FROM lw2
  UNION ALL SELECT source_path, sheet_name, CAST(2 + (k - 1) * 3 + 2 AS INTEGER), 0,
         CASE WHEN week = 0 THEN 'Starting Mood' ELSE 'Mood End Week ' || CAST(week AS VARCHAR) END FROM lw2
  UNION ALL SELECT source_path, sheet_name, CAST(2 + (k - 1) * 3 + 2 AS INTEGER), 1, CAST(mood AS VARCHAR) FROM lw2
  UNION ALL SELECT DISTINCT source_path, sheet_name, 0, 0, 'Label' FROM lw2
  UNION ALL SELECT DISTINCT source_path, sheet_name, 0, 1, 'Timepoint 1' FROM lw2
  UNION ALL SELECT DISTINCT source_path, sheet_name, 1, 0, 'Subject ID' FROM lw2
  UNION ALL SELECT DISTINCT source_path, sheet_name, 1, 1, CAST(subject_id AS VARCHAR) FROM lw2)"""


def header_ctes(src: str, p: str) -> list[str]:
    """I4 + I7 + I8 over cell CTE ``src``; CTE names prefixed by ``p``."""
    return [f"""{p}rows AS (
  SELECT source_path, sheet_name, row_no, count(value) AS nn, count(DISTINCT value) AS nd,
         max(CASE WHEN value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL THEN 1 ELSE 0 END) AS has_text
  FROM {src} GROUP BY source_path, sheet_name, row_no)""",
            f"""{p}sn AS (
  SELECT s.source_path, s.sheet_name,
         coalesce(min(r.row_no) FILTER (WHERE r.nn >= 2 AND r.nd >= 2 AND r.has_text = 1), 0) AS sniffed_row
  FROM (SELECT DISTINCT source_path, sheet_name FROM {src}) s
  LEFT JOIN {p}rows r ON s.source_path = r.source_path AND s.sheet_name = r.sheet_name
  GROUP BY s.source_path, s.sheet_name)""",
            f"""{p}st AS (
  SELECT source_path, sheet_name, max(col_no) + 1 AS ncols,
         count(DISTINCT CASE WHEN row_no > 0 THEN row_no END) AS nrows,
         count(*) FILTER (WHERE row_no = 0 AND value IS NOT NULL AND trim(value) <> '') AS named,
         count(*) FILTER (WHERE row_no > 0 AND col_no = 0 AND value IS NOT NULL) AS col0_filled
  FROM {src} GROUP BY source_path, sheet_name)""",
            f"""{p}hr AS (
  SELECT st.source_path, st.sheet_name,
         (nrows = 0 OR (nrows - col0_filled) > nrows * 0.8 OR (ncols - named) > ncols * 0.5) AS header_inferred,
         CASE WHEN (nrows = 0 OR (nrows - col0_filled) > nrows * 0.8 OR (ncols - named) > ncols * 0.5)
              THEN sn.sniffed_row ELSE 0 END AS header_row
  FROM {p}st st JOIN {p}sn sn ON st.source_path = sn.source_path AND st.sheet_name = sn.sheet_name)""",
            f"""{p}pos AS (
  SELECT c.source_path, c.sheet_name, unnest(generate_series(0, max(c.col_no))) AS col_no
  FROM {src} c JOIN {p}hr h ON c.source_path = h.source_path AND c.sheet_name = h.sheet_name
  WHERE c.row_no >= h.header_row GROUP BY c.source_path, c.sheet_name)""",
            f"""{p}h0 AS (
  SELECT q.source_path, q.sheet_name, q.col_no, {_norm('c.value')} AS raw_name
  FROM {p}pos q JOIN {p}hr h ON q.source_path = h.source_path AND q.sheet_name = h.sheet_name
  LEFT JOIN {src} c ON c.source_path = q.source_path AND c.sheet_name = q.sheet_name AND c.col_no = q.col_no
                    AND c.row_no = h.header_row)""",
            f"""{p}h1 AS (
  SELECT *, regexp_replace(regexp_replace(raw_name, '[ \\-.]', '_', 'g'), '[()]', '', 'g') AS n FROM {p}h0)""",
            f"""{p}hd AS (
  SELECT source_path, sheet_name, col_no, raw_name,
         CASE WHEN n = '' OR row_number() OVER (PARTITION BY source_path, sheet_name, n ORDER BY col_no) > 1
              THEN 'unnamed_' || CAST(col_no AS VARCHAR) ELSE n END AS name
  FROM {p}h1)"""]


def kind_ctes(src: str, p: str) -> list[str]:
    """I5 + I6 on top of header_ctes(src, p)."""
    from paneldeck.operators.sheets import FIBER_TERMS, LABEL_PATTERNS, NUTRITION_HINTS
    fib = " OR ".join(f"contains(text, '{t}')" for t in FIBER_TERMS)
    hint = " OR ".join(f"contains(text, '{t}')" for t in NUTRITION_HINTS)
    pats = " + ".join(f"coalesce(max(CASE WHEN regexp_matches(t, '{x}') THEN 1 ELSE 0 END), 0)" for x in LABEL_PATTERNS)
    return [f"""{p}nut AS (
  SELECT source_path, sheet_name, ({fib}) OR (({hint}) AND has_g = 1) AS is_nutrition
  FROM (SELECT source_path, sheet_name, string_agg(raw_name, ' ' ORDER BY col_no) AS text,
               max(CASE WHEN contains(raw_name, 'g') THEN 1 ELSE 0 END) AS has_g
        FROM {p}hd GROUP BY source_path, sheet_name))""",
            f"""{p}data AS (
  SELECT c.* FROM {src} c JOIN {p}hr h ON c.source_path = h.source_path AND c.sheet_name = h.sheet_name
  WHERE c.row_no > h.header_row)""",
            f"""{p}lab AS (
  SELECT n.source_path, n.sheet_name, n.nrows >= 6 AND coalesce(k.score, 0) >= 3 AS is_label
  FROM (SELECT source_path, sheet_name, count(DISTINCT row_no) AS nrows FROM {p}data GROUP BY ALL) n
  LEFT JOIN (SELECT source_path, sheet_name, {pats} AS score
             FROM (SELECT source_path, sheet_name, lower(trim(coalesce(value, 'nan'))) AS t FROM {p}data WHERE col_no = 0)
             GROUP BY source_path, sheet_name) k
  ON n.source_path = k.source_path AND n.sheet_name = k.sheet_name)"""]


def label_parse_ctes(p: str) -> list[str]:
    """I9-I12 + I11 on label cells with header_ctes(..., p)."""
    from paneldeck.operators.sheets import END_60_RE, END_WEEK_RE, START_RE, SUBJECT_RE
    return [f"""{p}lv AS (
  SELECT d.source_path, d.sheet_name, d.row_no, d.col_no, d.value, l.label,
         CASE WHEN hd.raw_name IS NULL OR hd.raw_name = '' THEN 'timepoint_' || CAST(d.col_no AS VARCHAR) ELSE hd.raw_name END AS timepoint
  FROM {p}data d
  JOIN (SELECT source_path, sheet_name, row_no, {_norm('value')} AS label FROM {p}data WHERE col_no = 0) l
    ON d.source_path = l.source_path AND d.sheet_name = l.sheet_name AND d.row_no = l.row_no
  LEFT JOIN {p}hd hd ON d.source_path = hd.source_path AND d.sheet_name = hd.sheet_name AND d.col_no = hd.col_no
  WHERE d.col_no >= 1)""",
            f"""{p}subj AS (
  SELECT source_path, sheet_name, arg_min(value, col_no * 1000000 + row_no) AS subject_id FROM {p}lv
  WHERE regexp_matches(label, '{SUBJECT_RE}') AND value IS NOT NULL GROUP BY source_path, sheet_name)""",
            f"""{p}lp AS (
  SELECT *, regexp_extract(label, '{START_RE}', 1) AS s, regexp_extract(label, '{END_WEEK_RE}', 1) AS e,
         regexp_extract(label, '{END_WEEK_RE}', 2) AS ew, regexp_extract(label, '{END_60_RE}', 1) AS s60
  FROM {p}lv WHERE NOT regexp_matches(label, '{SUBJECT_RE}'))""",
            f"""{p}tidy AS (
  SELECT j.subject_id,
         CASE WHEN s60 <> '' THEN s60 WHEN e <> '' THEN e WHEN s <> '' THEN s END AS metric,
         CASE WHEN s60 <> '' OR e <> '' THEN 'end' WHEN s <> '' THEN 'start' END AS phase,
         CAST(CASE WHEN s60 <> '' THEN 60 WHEN e <> '' THEN TRY_CAST(ew AS INTEGER) WHEN s <> '' THEN 0 END AS INTEGER) AS week,
         CASE WHEN (s60 <> '' OR e <> '') AND {_parse_num('lp.value')} = 0 THEN NULL ELSE {_parse_num('lp.value')} END AS value,
         CASE WHEN regexp_extract(trim(timepoint), '(\\d+)$', 1) = '' THEN NULL
              ELSE TRY_CAST(regexp_extract(trim(timepoint), '(\\d+)$', 1) AS BIGINT) END AS tp_index,
         timepoint, CASE WHEN s60 <> '' THEN '60d' END AS note, lp.sheet_name, lp.source_path, lp.row_no, lp.col_no
  FROM {p}lp lp LEFT JOIN {p}subj j ON lp.source_path = j.source_path AND lp.sheet_name = j.sheet_name
  WHERE s60 <> '' OR e <> '' OR s <> '')""",
            f"""{p}wb AS (
  SELECT source_path, arg_min(subject_id, sheet_name || '|' || lpad(CAST(col_no AS VARCHAR), 9, '0') || '|' ||
                                          lpad(CAST(row_no AS VARCHAR), 9, '0')) AS workbook_subject_id
  FROM {p}tidy WHERE subject_id IS NOT NULL GROUP BY source_path)"""]
