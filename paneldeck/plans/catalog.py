"""Query catalogue: one Spark query per inventory operator (or tight group),
each paired with a DuckDB SQL oracle where SQL can express it.

``QUERIES[name] = (spark_fn(spark, sf_dir) -> DataFrame, sql or None)``
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneldeck.functions.dictionaries import PART_KEYWORDS
from paneldeck.operators import assemble, keywords, panel
from paneldeck.plans import bindings as B
from paneldeck.plans import oracle as O
from paneldeck.plans import panels as P
from paneldeck.plans.finalize import finalize
from paneldeck.session import bucket_count, cut_lineage, input_listing, materialized, spread
from paneldeck.sources.tables import join_side, table_path

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
CATS = list(PART_KEYWORDS)


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


# ------------------------------------------------------------------ long dialect

DAILY_SCALES = {"fiber_g_total": 2, "calories_kcal_total": 2, "carb_g_total": 4, "protein_g_total": 4, "fat_g_total": 2}


@register("q_daily_rollup", O.long_base() + f"""
SELECT subject_id, date, {O.r('fiber_g_total', 2)} AS fiber_g_total, {O.r('calories_kcal_total', 2)} AS calories_kcal_total,
       {O.r('carb_g_total', 4)} AS carb_g_total, {O.r('protein_g_total', 4)} AS protein_g_total,
       {O.r('fat_g_total', 2)} AS fat_g_total, n_entries FROM daily""")
def q_daily_rollup(spark, d):
    """A1 daily rollup of the food rows."""
    return finalize(B.daily_long(spark, d), DAILY_SCALES)


@register("q_kw_daily", O.long_base() + "SELECT * FROM kwd")
def q_kw_daily(spark, d):
    """A4 daily keyword flags by (subject, date)."""
    return P.kw_daily(spark, d)


@register("q_daily_flags", O.long_base() + "SELECT subject_id, date, " + ", ".join(
    O.r(n, DAILY_SCALES[n]) + f" AS {n}" for n in B.DAILY_NUTRIENTS) + ", n_entries, "
          + ", ".join(f"kw_{c}" for c in CATS) + " FROM dflags")
def q_daily_flags(spark, d):
    """J1 + P8: daily totals left-joined with daily keyword flags (missing = 0)."""
    return finalize(P.daily_with_flags(spark, d), DAILY_SCALES)


@register("q_weekly_long", O.long_base() + f"SELECT {O.weekly_long_select()} FROM weekly")
def q_weekly_long(spark, d):
    """P5 week index + J1/P8 daily flags + A2 weekly rollup (long dialect)."""
    w = P.weekly_long(spark, d)
    scales = {f"{n}_week_sum": 4 for n in B.DAILY_NUTRIENTS}
    return finalize(w, scales)


TRAJ_COLS = ["subject_id", "week", "tp_index", "value", "start_weight", "delta_kg", "pct_change", "phase",
             "slope_kg_per_week"]


@register("q_baseline_delta", O.long_base() + f"""
SELECT subject_id, week, tp_index, {O.r('value', 2)} AS value, {O.r('start_weight', 2)} AS start_weight,
       {O.r('delta_kg', 2)} AS delta_kg, {O.r('pct_change')} AS pct_change, phase,
       {O.r('slope_kg_per_week', 4)} AS slope_kg_per_week FROM traj""")
def q_baseline_delta(spark, d):
    """P1-P4, W6, ST1 slope: long-dialect weight trajectories."""
    t = P.trajectories_long(spark, d).select(*TRAJ_COLS)
    return finalize(t, {"value": 2, "start_weight": 2, "delta_kg": 2, "slope_kg_per_week": 4})


@register("q_subject_slope", O.long_base() + f"""
SELECT subject_id, n AS n_points, {O.r('CASE WHEN n >= 2 THEN b END', 4)} AS slope,
       {O.r('CASE WHEN n >= 2 THEN a END', 2)} AS intercept,
       {O.r('CASE WHEN n > 2 THEN sqrt(greatest(0, syy - b * sxy) / (n - 2) / sxx) END', 4)} AS slope_se
FROM st WHERE start_weight IS NOT NULL""")
def q_subject_slope(spark, d):
    """ST1 per-subject OLS slope of weight on week with its standard error."""
    from paneldeck.operators import regress
    m = B.measures_long(spark, d)
    rows = (m.filter(F.col("metric") == "weight")
            .filter(((F.col("phase") == "start") & (F.col("week") == 0)) | (F.col("phase") == "end"))
            .filter(F.col("value").isNotNull()))
    has_base = rows.filter(F.col("week") == 0).select("subject_id").distinct()
    s = regress.group_slopes(rows.join(has_base, "subject_id", "left_semi"), "subject_id", "week", "value", min_points=2)
    return finalize(s.select("subject_id", "n_points", "slope", "intercept", "slope_se"),
                    {"slope": 4, "intercept": 2, "slope_se": 4})


@register("q_slope_ci", None)
def q_slope_ci(spark, d):
    """ST1 + ST12: per-subject 95% CI of the slope (t quantile, no SQL form)."""
    t = P.trajectories_long(spark, d)
    return (t.select("subject_id", "slope_kg_per_week", "slope_ci_lower", "slope_ci_upper").distinct())


ANALYSIS_LONG_COLS = ["subject_id", "week", "tp_index", "value", "delta_kg", "delta_kg_next",
                      "fiber_g_total_week_mean", "calories_kcal_total_week_mean", "n_entries_week_sum",
                      "any_kw_widget", "any_kw_gear", "share_of_days_kw_widget"]


@register("q_align_long", O.long_base() + f"""
SELECT t.subject_id, t.week, t.tp_index, {O.r('t.value', 2)} AS value, {O.r('t.delta_kg', 2)} AS delta_kg,
       {O.r('lead(t.delta_kg) OVER (PARTITION BY t.subject_id ORDER BY t.week, t.tp_index)', 2)} AS delta_kg_next,
       {O.r('w.fiber_g_total_week_mean')} AS fiber_g_total_week_mean,
       {O.r('w.calories_kcal_total_week_mean')} AS calories_kcal_total_week_mean,
       w.n_entries_week_sum, w.any_kw_widget, w.any_kw_gear, {O.r('w.share_of_days_kw_widget')} AS share_of_days_kw_widget
FROM traj t LEFT JOIN weekly w ON t.subject_id = w.subject_id AND t.week = w.week_index""")
def q_align_long(spark, d):
    """J2 + W4: analysis panel (trajectories ⟕ weekly) with next-observation delta."""
    a = P.analysis_long(spark, d).select(*ANALYSIS_LONG_COLS)
    return finalize(a, {"value": 2, "delta_kg": 2, "delta_kg_next": 2})


@register("q_kw_prevalence", O.long_base() + """
, prev AS (SELECT count(*) AS total, """ + ", ".join(f"CAST(coalesce(sum(kw_{c}), 0) AS BIGINT) AS {c}" for c in CATS) + """ FROM kwd)
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS keyword, {c} AS positive, CAST(total AS BIGINT) AS total, {O.r(f'{c} * 100.0 / total')} AS pct FROM prev"
    for c in CATS))
def q_kw_prevalence(spark, d):
    """A8 keyword prevalence over subject-days."""
    return finalize(keywords.keyword_prevalence(P.kw_daily(spark, d), CATS))


# ------------------------------------------------------------------ wide dialect

# means of 2-decimal values: 6 decimals, so exact decimal ties (which Spark and
# DuckDB round differently) would need 32+ values in one group
WIDE_TRAJ_SCALES = {"weight_kg": 6, "energy_1_10": 6, "mood_1_10": 6, "delta_kg": 6, "delta_kg_next": 6,
                    "baseline_weight_kg": 6, "delta_from_baseline_kg": 6}


@register("q_step_delta", O.wide_base() + "SELECT subject_id, date, week, " + ", ".join(
    O.r(c, WIDE_TRAJ_SCALES.get(c, 6)) + f" AS {c}" for c in
    ["weight_kg", "energy_1_10", "mood_1_10", "delta_kg", "delta_kg_pct", "delta_kg_next", "baseline_weight_kg",
     "delta_from_baseline_kg", "delta_from_baseline_pct", "weight_slope_kg_per_week"]) + " FROM traj_w")
def q_step_delta(spark, d):
    """W1-W3, P6, A9/W7, W8, ST2: wide-dialect trajectories by date."""
    return finalize(P.trajectories_wide(spark, d), WIDE_TRAJ_SCALES)


WEEKLY_WIDE_COLS = ["subject_id", "week", "calories_mean", "calories_sum", "calories_std", "calories_days",
                    "fiber_g_mean", "fiber_g_sum", "fiber_g_std", "fiber_days", "calories_week", "fiber_g_week",
                    "calories_day_avg", "fiber_g_day_avg", "fiber_per_1000_cal"]


@register("q_weekly_wide", O.wide_base() + "SELECT " + ", ".join(
    c if c in ("subject_id", "week", "calories_days", "fiber_days") else O.r(c, 4) + f" AS {c}"
    for c in WEEKLY_WIDE_COLS) + " FROM weekly_w")
def q_weekly_wide(spark, d):
    """A3 + P7 + P14: weekly mean/sum/std/count, aliases and fiber density."""
    w = P.weekly_wide(spark, d).select(*WEEKLY_WIDE_COLS)
    return finalize(w, default=4)


@register("q_kw_weekly", O.wide_base() + "SELECT * FROM kw_w")
def q_kw_weekly(spark, d):
    """Weekly keyword flags, mention counts, variety and entry count."""
    return P.keywords_wide(spark, d)


MERGED_COLS = (["subject_id", "date", "week", "weight_kg", "delta_kg", "delta_kg_next", "baseline_weight_kg",
                "fiber_g_week", "calories_week", "food_entries_week", "weight_slope_kg_per_week"]
               + [f"{c}_week" for c in CATS] + ["food_variety_categories", "high_fiber_week", "high_calorie_week"])


def _merged_sql(fill: str) -> str:
    sel = ", ".join(c if c in ("subject_id", "date", "week", "food_entries_week", "food_variety_categories",
                               "high_fiber_week", "high_calorie_week") or c.endswith("_week") and c[:-5] in CATS
                    else O.r(c, 6) + f" AS {c}" for c in MERGED_COLS)
    return O.wide_base(O.merge_wide_cte(fill)) + f"SELECT {sel} FROM merged"


def _merged(spark, d, fill):
    m = P.analysis_wide(spark, d, fill=fill)
    if fill == "reference":
        m = m.withColumn("food_entries_week", F.col("food_entries_week").cast("int"))
    return finalize(m.select(*MERGED_COLS), default=6)


@register("q_merge_panel_flags_only", _merged_sql("flags_only"))
def q_merge_panel_flags_only(spark, d):
    """J3 + P8 (flags only) + P9 medians + P11: the wide analysis panel."""
    return _merged(spark, d, "flags_only")


@register("q_merge_panel_reference", _merged_sql("reference"))
def q_merge_panel_reference(spark, d):
    """J3 + Q3 reference zero-fill of every *_week column + Q4 median order."""
    return _merged(spark, d, "reference")


@register("q_calendar_spine", O.wide_base() + """
, dwk AS (SELECT subject_id, date, total_calories, total_fiber_g FROM dw),
dates AS (SELECT subject_id, date FROM dwk UNION ALL SELECT subject_id, date FROM ev),
rng AS (SELECT subject_id, min(date) AS lo, max(date) AS hi FROM dates
        WHERE date IS NOT NULL AND subject_id IN (SELECT subject_id FROM traj_w) GROUP BY subject_id),
spine AS (SELECT subject_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM rng)
SELECT s.subject_id, s.date, """ + O.r("d.total_calories", 4) + " AS total_calories, " + O.r("d.total_fiber_g", 4)
          + """ AS total_fiber_g FROM spine s LEFT JOIN dwk d ON s.subject_id = d.subject_id AND s.date = d.date""")
def q_calendar_spine(spark, d):
    """U2 + A11 + U6 + J4 + J5: gap-preserving per-subject calendar ⟕ daily."""
    daily = B.daily_wide(spark, d).select("subject_id", "date", "total_calories", "total_fiber_g")
    ev = B.events_clean(spark, d).select("subject_id", "date")
    subjects = P.trajectories_wide(spark, d).select("subject_id")
    s = panel.calendar_spine(subjects, daily, ev)
    return finalize(s.select("subject_id", "date", "total_calories", "total_fiber_g"), default=4)


# ------------------------------------------------------------------ statistics

from paneldeck.operators import mixed, ranks, regress  # noqa: E402

LONG_Y = "delta_kg_next"
LONG_X = ["fiber_g_total_week_mean", "calories_kcal_total_week_mean", "any_kw_widget", "any_kw_gear"]
WIDE_X = ["fiber_g_week", "calories_week", "widget_week", "gear_week"]


def model_panel_long(spark, d):
    return P.analysis_long(spark, d)


def model_panel_wide(spark, d):
    return P.analysis_wide(spark, d, fill="reference")


def _py(v):
    if v is None:
        return None
    if isinstance(v, int):
        return v
    v = float(v)
    return v if v == v and v not in (float("inf"), float("-inf")) else None


def _coef_frame(spark, res: regress.ModelResult, stat_name: str = "t_stat", fit_cols: dict | None = None):
    rows = []
    for (_m, term, coef, se, stat, _p, _lo, _hi) in res.coefficient_rows():
        extra = tuple(_py(fit_cols[k](res)) for k in fit_cols) if fit_cols else ()
        rows.append((term, coef, se, stat, *extra))
    from pyspark.sql import types as T
    fields = [T.StructField("term", T.StringType()), T.StructField("coef", T.DoubleType()),
              T.StructField("se", T.DoubleType()), T.StructField(stat_name, T.DoubleType())]
    for k in (fit_cols or {}):
        fields.append(T.StructField(k, T.LongType() if k in ("n_obs", "df_resid", "n_clusters") else T.DoubleType()))
    return spark.createDataFrame(rows, T.StructType(fields))


_FIT_OLS = {"r_squared": lambda r: r.fit["r_squared"], "n_obs": lambda r: int(r.fit["observations"]),
            "df_resid": lambda r: int(r.fit["df_resid"])}




def _with(base: str, tail: str) -> str:
    # base ends with the last CTE; tail starts with ", name AS (...)" and a final SELECT
    return base.rstrip() + "\n" + tail


@register("q_ols1", _with(O.model_wide(), O.ols1_sql("merged", LONG_Y, "fiber_g_week")))
def q_ols1(spark, d):
    """ST3 with one predictor on the wide panel (oracle by regr_* in SQL)."""
    res = regress.ols(model_panel_wide(spark, d), LONG_Y, ["fiber_g_week"])
    return finalize(_coef_frame(spark, res, fit_cols=_FIT_OLS))


@register("q_ols2", _with(O.model_wide(), O.ols2_sql("merged", LONG_Y, "fiber_g_week", "calories_week")))
def q_ols2(spark, d):
    """ST3 with two predictors (oracle by Cramer's rule in SQL)."""
    res = regress.ols(model_panel_wide(spark, d), LONG_Y, ["fiber_g_week", "calories_week"])
    return finalize(_coef_frame(spark, res, fit_cols=_FIT_OLS))


@register("q_ols", None)
def q_ols(spark, d):
    """ST3 + ST12: the reference's pooled OLS, four predictors, t-based p-values."""
    res = regress.ols(model_panel_wide(spark, d), LONG_Y, WIDE_X)
    return res.coefficients(spark)


@register("q_fe_within", _with(O.model_wide(), O.fe1_sql("merged", LONG_Y, "fiber_g_week")))
def q_fe_within(spark, d):
    """ST5 + W9 with one predictor, naive dof (Q6)."""
    res = regress.fe_within(model_panel_wide(spark, d), LONG_Y, ["fiber_g_week"], "subject_id")
    fit = {"r_squared_within": lambda r: r.fit["r_squared_within"], "n_obs": lambda r: int(r.fit["observations"]),
           "df_resid": lambda r: int(r.fit["df_resid"])}
    return finalize(_coef_frame(spark, res, fit_cols=fit))


@register("q_fe", None)
def q_fe(spark, d):
    """ST5 + ST12: within-subject FE model with the reference's four predictors."""
    res = regress.fe_within(model_panel_wide(spark, d), LONG_Y, WIDE_X, "subject_id")
    return res.coefficients(spark)


@register("q_cluster_se", _with(O.model_long(), O.cluster1_sql("al", LONG_Y, "fiber_g_total_week_mean")))
def q_cluster_se(spark, d):
    """ST4: subject dummies + cluster-robust SE, one predictor (oracle in SQL)."""
    res = regress.cluster_ols(model_panel_long(spark, d), LONG_Y, ["fiber_g_total_week_mean"], "subject_id")
    fit = {"r_squared": lambda r: r.fit["r_squared"], "n_obs": lambda r: int(r.fit["observations"]),
           "n_clusters": lambda r: int(r.fit["n_clusters"])}
    return finalize(_coef_frame(spark, res, "z_stat", fit), {"coef": 4, "se": 4, "z_stat": 4})


@register("q_cluster", None)
def q_cluster(spark, d):
    """ST4 + ST12: the reference's clustered model (fiber, calories, two flags)."""
    res = regress.cluster_ols(model_panel_long(spark, d), LONG_Y, LONG_X, "subject_id")
    return res.coefficients(spark)


@register("q_within_slopes", _with(O.model_long(), O.within_slopes_sql("al", LONG_Y, LONG_X[0], LONG_X[1])))
def q_within_slopes(spark, d):
    """ST6: distribution of per-subject within slopes (n >= 3)."""
    s = regress.within_slopes(model_panel_long(spark, d), LONG_Y, LONG_X[0], LONG_X[1], "subject_id")
    return finalize(regress.summarize_within(s), {"within_subject_mean": 4, "within_subject_std": 4})


@register("q_spearman", _with(O.model_long(), O.spearman_sql("al", LONG_X[0], LONG_Y)))
def q_spearman(spark, d):
    """ST7 + W10: Spearman rho from scalable average ranks."""
    return finalize(ranks.spearman(model_panel_long(spark, d), LONG_X[0], LONG_Y))


@register("q_pearson", _with(O.model_long(), O.pearson_sql("al", LONG_X[0], LONG_Y)))
def q_pearson(spark, d):
    """ST8: Pearson r (R7-safe) and its t statistic."""
    return finalize(regress.pearson(model_panel_long(spark, d), LONG_X[0], LONG_Y))


@register("q_mannwhitney", O.model_long() + "\n" + "\nUNION ALL\n".join(
    O.mann_whitney_sql("al", LONG_Y, f) for f in ("any_kw_widget", "any_kw_gear")))
def q_mannwhitney(spark, d):
    """ST9 + A17: Mann–Whitney U statistic, tie term, group sizes and medians."""
    res = ranks.mann_whitney_many(model_panel_long(spark, d), LONG_Y, ["any_kw_widget", "any_kw_gear"])
    return finalize(res)


@register("q_kw_weekly_joined", O.long_base("""ws AS (
  SELECT f.subject_id, CAST(floor(datediff('day', o.origin_date, f.date) / 7.0) AS INTEGER) + 1 AS week,
         count(*) AS food_entries_week,
         string_agg(lower(coalesce(food, '')), ' ' ORDER BY f.date, f.order_key, f.line_no, f.food) AS t
  FROM (SELECT o_custkey AS subject_id, CAST(o_orderdate AS DATE) AS date, p_name AS food, l_orderkey AS order_key,
               l_linenumber AS line_no
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey) f
  JOIN origin o ON o.subject_id = f.subject_id GROUP BY 1, 2)""") + "SELECT subject_id, week, " + ", ".join(
    f"CAST({O.flag('t', p)} AS INTEGER) AS {c}_week, CAST({O.mentions('t', p)} AS INTEGER) AS {c}_mentions"
    for c, p in PART_KEYWORDS.items()) + ", CAST(food_entries_week AS INTEGER) AS food_entries_week, CAST("
          + " + ".join(O.flag("t", p) for p in PART_KEYWORDS.values()) + " AS INTEGER) AS food_variety_categories FROM ws")
def q_kw_weekly_joined(spark, d):
    """A5-A7 on the week's joined text (Q17): phrases may cross entries."""
    from paneldeck.operators import rollup
    rows = B.food_rows(spark, d).select("subject_id", "date", F.col("food").alias("food_item"),
                                        F.struct("date", "order_key", "line_no", "food").alias("entry"))
    origin = rollup.subject_origin(P.daily_flags(spark, d))
    weeks = rollup.add_week_index(rows, out="week", one_based=True, origin=origin)
    return keywords.weekly_keywords_wide(weeks, PART_KEYWORDS, joined=True, order_col="entry")


@register("q_group_tests", None)
def q_group_tests(spark, d):
    """ST9 + ST12: Mann–Whitney two-sided p-values (exact for small untied samples)."""
    from pyspark.sql import types as T
    stats = q_mannwhitney(spark, d).collect()
    rows = [(r["flag"], r["n1"], r["n0"], r["median_1"], r["median_0"], r["u_stat"],
             ranks.mann_whitney_p(r["n1"], r["n0"], r["u_stat"], r["tie_term"]),
             ranks.mann_whitney_method(r["n1"], r["n0"], r["tie_term"] > 0, cells=None)) for r in stats]
    schema = T.StructType([T.StructField("flag", T.StringType()), T.StructField("n1", T.LongType()),
                           T.StructField("n0", T.LongType()), T.StructField("median_1", T.DoubleType()),
                           T.StructField("median_0", T.DoubleType()), T.StructField("u_stat", T.DoubleType()),
                           T.StructField("p_value", T.DoubleType()), T.StructField("p_method", T.StringType())])
    return spark.createDataFrame(rows, schema)


@register("q_corr_tests", None)
def q_corr_tests(spark, d):
    """ST7 + ST8 + ST12: Spearman and Pearson with two-sided t p-values."""
    from paneldeck.functions.dist import t_pvalue_udf
    pnl = model_panel_long(spark, d)
    sp = ranks.spearman(pnl, LONG_X[0], LONG_Y).select(F.lit("spearman").alias("method"), "n",
                                                        F.col("rho").alias("estimate"), "t_stat")
    pe = regress.pearson(pnl, LONG_X[0], LONG_Y).select(F.lit("pearson").alias("method"), "n",
                                                         F.col("r").alias("estimate"), "t_stat")
    both = sp.unionByName(pe)
    return both.withColumn("p_value", t_pvalue_udf(F.col("t_stat"), (F.col("n") - 2).cast("double")))


@register("q_mixed_ml", None)
def q_mixed_ml(spark, d):
    """ST10 (ML, long panel, two predictors as in the clustered pipeline)."""
    res = mixed.random_intercept(model_panel_long(spark, d), LONG_Y, LONG_X[:2], "subject_id", reml=False)
    return res.coefficients(spark)


@register("q_mixed_reml", None)
def q_mixed_reml(spark, d):
    """ST10 (REML, wide panel, the four reference predictors)."""
    res = mixed.random_intercept(model_panel_wide(spark, d), LONG_Y, WIDE_X, "subject_id", reml=True)
    return res.coefficients(spark)


@register("q_model_fit", None)
def q_model_fit(spark, d):
    """ST13: one fit-metrics table for every model (union of results)."""
    wide, long = model_panel_wide(spark, d), model_panel_long(spark, d)
    results = [regress.ols(wide, LONG_Y, WIDE_X), regress.fe_within(wide, LONG_Y, WIDE_X, "subject_id"),
               regress.cluster_ols(long, LONG_Y, LONG_X, "subject_id"),
               mixed.random_intercept(long, LONG_Y, LONG_X[:2], "subject_id"),
               mixed.random_intercept(wide, LONG_Y, WIDE_X, "subject_id", reml=True)]
    out = results[0].model_fit(spark)
    for r in results[1:]:
        out = out.unionByName(r.model_fit(spark))
    return out


@register("q_full_analysis", None)
def q_full_analysis(spark, d):
    """ST13: the whole analysis as one table: every coefficient and fit metric of
    the five models (convergence included), correlations, group tests and the
    summary of within-subject slopes."""
    wide, long = model_panel_wide(spark, d), model_panel_long(spark, d)
    results = [regress.ols(wide, LONG_Y, WIDE_X), regress.fe_within(wide, LONG_Y, WIDE_X, "subject_id"),
               regress.cluster_ols(long, LONG_Y, LONG_X, "subject_id"),
               mixed.random_intercept(long, LONG_Y, LONG_X[:2], "subject_id"),
               mixed.random_intercept(wide, LONG_Y, WIDE_X, "subject_id", reml=True)]
    none = F.lit(None).cast("double")

    def section(df, name, model, term, estimate, se=none, statistic=none, p=none):
        return df.select(F.lit(name).alias("section"), model.alias("model"), term.alias("term"),
                         estimate.cast("double").alias("estimate"), se.cast("double").alias("se"),
                         statistic.cast("double").alias("statistic"), p.cast("double").alias("p_value"))

    c = F.col
    parts = []
    for r in results:
        parts.append(section(r.coefficients(spark), "coefficient", c("model"), c("term"), c("coef"), c("se"), c("stat"),
                             c("p_value")))
        parts.append(section(r.model_fit(spark), "fit", c("model"), c("metric"), c("value")))
    parts.append(section(q_corr_tests(spark, d), "correlation", c("method"), F.lit(LONG_X[0]), c("estimate"),
                         statistic=c("t_stat"), p=c("p_value")))
    parts.append(section(q_group_tests(spark, d), "group_test", F.concat(F.lit("mann_whitney_"), "p_method"), c("flag"),
                         c("median_1") - c("median_0"), statistic=c("u_stat"), p=c("p_value")))
    within = q_within_slopes(spark, d)
    numbers = [n for n, t in within.dtypes if t in ("double", "bigint", "int")]
    parts.append(section(within.select(*[c(n).cast("double").alias(n) for n in numbers])
                         .unpivot([], numbers, "metric", "value"), "within", F.lit("within_slopes"), c("metric"), c("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("q_trend_grid", _with(O.model_long(), O.trend_sql("al", LONG_X[0], LONG_Y)))
def q_trend_grid(spark, d):
    """ST11: fitted line on a 100-point grid with the standard error of the mean."""
    g = regress.trend_grid(model_panel_long(spark, d), None, LONG_X[0], LONG_Y)
    return finalize(g.select(F.col("i").cast("int"), "x", "yhat", "se_mean"), default=4)


# ------------------------------------------------------------------ descriptive

from paneldeck.operators import describe as D  # noqa: E402

PIVOT_WEEKS = [4, 8, 12, 60]
PIVOT_COLS = [f"{v}_week_{w}" for w in PIVOT_WEEKS for v in ("delta_kg", "pct_change")]


def _pivot_sql_cols() -> str:
    parts = []
    for w in PIVOT_WEEKS:
        parts.append(f"arg_min(delta_kg, tp_index) FILTER (WHERE week = {w}) AS delta_kg_week_{w}")
        parts.append(f"arg_min(pct_change, tp_index) FILTER (WHERE week = {w}) AS pct_change_week_{w}")
    return ", ".join(parts)


PIVOT_CTE = f"pv AS (SELECT subject_id, {_pivot_sql_cols()} FROM al GROUP BY subject_id)"


def _pivot(spark, d):
    return D.pivot_weeks(P.analysis_long(spark, d), "subject_id", "week", ["delta_kg", "pct_change"],
                         PIVOT_WEEKS, tie="tp_index")


@register("q_pivot_weeks", O.model_long(PIVOT_CTE) + "SELECT subject_id, " + ", ".join(
    O.r(c, 2 if c.startswith("delta") else 6) + f" AS {c}" for c in PIVOT_COLS) + " FROM pv")
def q_pivot_weeks(spark, d):
    """A13 + U5: per-subject change at weeks 4, 8, 12 and 60 (pivot, fixed values)."""
    return finalize(_pivot(spark, d), {c: 2 for c in PIVOT_COLS if c.startswith("delta")})


def _describe_sql() -> str:
    stats = [("count", "CAST(count({c}) AS DOUBLE)"), ("mean", "avg({c})"), ("std", "stddev_samp({c})"),
             ("min", "min({c})"), ("25%", "quantile_cont({c}, 0.25)"), ("50%", "quantile_cont({c}, 0.5)"),
             ("75%", "quantile_cont({c}, 0.75)"), ("max", "max({c})")]
    sel = []
    for name, f in stats:
        cols = ", ".join(O.r(f.format(c=c), 4) + f' AS "{c}"' for c in PIVOT_COLS)
        sel.append(f"SELECT '{name}' AS statistic, {cols} FROM pv")
    return O.model_long(PIVOT_CTE) + "\nUNION ALL\n".join(sel)


@register("q_describe", _describe_sql())
def q_describe(spark, d):
    """describe() of the per-subject change table with a statistic column (Q14)."""
    return finalize(D.describe(_pivot(spark, d), PIVOT_COLS), default=4)


@register("q_early_late", O.model_long() + f"""
SELECT subject_id, {O.r('avg(fiber_g_total_week_mean) FILTER (WHERE week <= 3)')} AS fiber_g_early_mean,
       {O.r('avg(fiber_g_total_week_mean) FILTER (WHERE week >= 4)')} AS fiber_g_later_mean,
       {O.r('avg(calories_kcal_total_week_mean) FILTER (WHERE week <= 3)')} AS calories_early_mean,
       {O.r('avg(calories_kcal_total_week_mean) FILTER (WHERE week >= 4)')} AS calories_later_mean,
       count(*) FILTER (WHERE week <= 3) AS n_early_weeks, count(*) FILTER (WHERE week >= 4) AS n_later_weeks
FROM al GROUP BY subject_id""")
def q_early_late(spark, d):
    """A15 + P18: early (weeks 0-3) vs later (4+) nutrition means per subject."""
    return finalize(D.early_late(P.analysis_long(spark, d), "subject_id", "week",
                                 {"fiber_g_total_week_mean": "fiber_g", "calories_kcal_total_week_mean": "calories"}))


@register("q_crosstab", O.model_long() + "\nUNION ALL\n".join(f"""
SELECT '{k}' AS keyword, count(*) FILTER (WHERE any_kw_{k} = 1) AS n_weeks_with_keyword,
       count(*) FILTER (WHERE any_kw_{k} = 0) AS n_weeks_without_keyword,
       {O.r(f'median(delta_kg) FILTER (WHERE any_kw_{k} = 1)', 2)} AS median_delta_with_keyword,
       {O.r(f'median(delta_kg) FILTER (WHERE any_kw_{k} = 0)', 2)} AS median_delta_without_keyword,
       {O.r('median(delta_kg)', 2)} AS overall_median_delta
FROM al WHERE delta_kg IS NOT NULL""" for k in ("widget", "gear")))
def q_crosstab(spark, d):
    """Keyword × outcome table (n and median with / without, overall median)."""
    t = D.keyword_crosstab(P.analysis_long(spark, d), "delta_kg", {"widget": "any_kw_widget", "gear": "any_kw_gear"})
    return finalize(t, default=2)


def participants(spark, d):
    o = B.read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = B.read_table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(join_side(c, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return D.participant_changes(j, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice",
                                 category="c_mktsegment").withColumnRenamed("o_custkey", "subject_id")


PART_COLS = ["subject_id", "category", "starting_weight", "ending_weight", "weight_change", "weight_change_percent",
             "num_measurements"]


@register("q_participants", O.participants_base() + "SELECT subject_id, category, " + ", ".join(
    [O.r("starting_weight", 2) + " AS starting_weight", O.r("ending_weight", 2) + " AS ending_weight",
     O.r("weight_change", 2) + " AS weight_change", O.r("weight_change_percent") + " AS weight_change_percent"])
          + ", num_measurements FROM pp")
def q_participants(spark, d):
    """A10: first / last measurement, change and percent per participant."""
    return finalize(participants(spark, d).select(*PART_COLS),
                    {"starting_weight": 2, "ending_weight": 2, "weight_change": 2})


@register("q_cohort", O.participants_base() + f"""
SELECT count(*) AS total_participants, {O.r('avg(weight_change)', 4)} AS avg_change,
       {O.r('median(weight_change)', 4)} AS median_change, {O.r('stddev_pop(weight_change)', 4)} AS std_change,
       count(*) FILTER (WHERE weight_change < 0) AS successful,
       {O.r('count(*) FILTER (WHERE weight_change < 0) * 100.0 / count(*)')} AS success_rate,
       {O.r('avg(starting_weight)', 4)} AS avg_starting_weight, {O.r('avg(num_measurements)')} AS avg_duration FROM pp""")
def q_cohort(spark, d):
    """Cohort summary over participants."""
    return finalize(D.cohort_summary(participants(spark, d)),
                    {"avg_change": 4, "median_change": 4, "std_change": 4, "avg_starting_weight": 4})


@register("q_duration_bucket", O.participants_base() + f"""
SELECT {O.duration_case('num_measurements')} AS duration_category, count(*) AS n_participants,
       {O.r('avg(weight_change)', 4)} AS mean_change FROM pp GROUP BY 1""")
def q_duration_bucket(spark, d):
    """Participants by duration bucket (28 / 14 / 7 measurements)."""
    p = participants(spark, d).withColumn("duration_category", D.duration_bucket("num_measurements"))
    g = p.groupBy("duration_category").agg(F.count(F.lit(1)).alias("n_participants"),
                                           F.avg("weight_change").alias("mean_change"))
    return finalize(g, {"mean_change": 4})


@register("q_category_mean", O.participants_base() + f"""
SELECT category, {O.r('avg(weight_change)', 4)} AS mean, count(weight_change) AS count FROM pp GROUP BY category""")
def q_category_mean(spark, d):
    """Mean change and count by category (market segment)."""
    return finalize(D.category_mean(participants(spark, d), "category", "weight_change"), {"mean": 4})


@register("q_range_summary", O.participants_base() + f"""
SELECT {O.r('min(weight_change)', 2)} AS weight_change_min, {O.r('min(starting_weight)', 2)} AS starting_weight_min,
       min(num_measurements) AS num_measurements_min, {O.r('max(weight_change)', 2)} AS weight_change_max,
       {O.r('max(starting_weight)', 2)} AS starting_weight_max, max(num_measurements) AS num_measurements_max FROM pp""")
def q_range_summary(spark, d):
    """Ranges of change, starting weight and duration."""
    return finalize(D.range_summary(participants(spark, d), ["weight_change", "starting_weight", "num_measurements"]),
                    default=2)


@register("q_hist", O.participants_base("""st AS (SELECT min(weight_change) AS lo, max(weight_change) AS hi, count(*) AS n,
       CAST(greatest(1, least(15, count(*) // 2)) AS INTEGER) AS nb FROM pp)""", """bins AS (
  SELECT CAST(b AS INTEGER) AS bin, lo + b * (hi - lo) / nb AS bin_lower, lo + (b + 1) * (hi - lo) / nb AS bin_upper
  FROM st, range(0, nb) t(b))""", """cnt AS (
  SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((weight_change - lo) / ((hi - lo) / nb)), nb - 1) END AS INTEGER) AS bin,
         count(*) AS c FROM pp, st GROUP BY 1)""") + f"""
SELECT b.bin, {O.r('b.bin_lower', 2)} AS bin_lower, {O.r('b.bin_upper', 2)} AS bin_upper,
       CAST(coalesce(c.c, 0) AS BIGINT) AS count FROM bins b LEFT JOIN cnt c ON b.bin = c.bin""")
def q_hist(spark, d):
    """RP5: histogram of participant change, bins = min(15, n // 2)."""
    return finalize(D.histogram(participants(spark, d), "weight_change"), default=2)


@register("q_weekly_mean_sd", O.model_wide() + f"""
SELECT week, {O.r('avg(fiber_g_week)', 6)} AS mean, {O.r('stddev_samp(fiber_g_week)', 6)} AS std,
       count(fiber_g_week) AS n FROM merged GROUP BY week""")
def q_weekly_mean_sd(spark, d):
    """Weekly mean ± sd of fiber across subjects."""
    return finalize(D.weekly_mean_sd(model_panel_wide(spark, d), "week", "fiber_g_week"), default=6)


@register("q_weekly_prevalence", O.model_wide() + f"""
SELECT week, {O.r('avg(CAST(widget_week AS DOUBLE))')} AS widget_week_share,
       {O.r('avg(CAST(gear_week AS DOUBLE))')} AS gear_week_share FROM merged GROUP BY week""")
def q_weekly_prevalence(spark, d):
    """Weekly prevalence of two keyword flags."""
    return finalize(D.weekly_prevalence(model_panel_wide(spark, d), "week", ["widget_week", "gear_week"]))


@register("q_outcome_summary", O.wide_base() + f"""
, fin AS (SELECT max(week) AS fw FROM traj_w),
lastw AS (SELECT t.* FROM traj_w t, fin WHERE t.week = fin.fw AND t.delta_from_baseline_kg IS NOT NULL)
SELECT (SELECT fw FROM fin) AS final_week, count(DISTINCT subject_id) AS n_subjects,
       {O.r('avg(delta_from_baseline_kg)', 6)} AS mean_change, {O.r('stddev_samp(delta_from_baseline_kg)', 6)} AS sd_change,
       count(*) FILTER (WHERE delta_from_baseline_kg < 0) AS n_losing,
       {O.r('avg(CASE WHEN delta_from_baseline_kg < 0 THEN 1.0 ELSE 0.0 END)')} AS share_losing,
       {O.r('min(delta_from_baseline_kg)', 6)} AS min_change, {O.r('max(delta_from_baseline_kg)', 6)} AS max_change
FROM lastw""")
def q_outcome_summary(spark, d):
    """A24 + J7: outcome at the final study week (mean ± sd, share losing, range)."""
    s = D.outcome_summary(P.trajectories_wide(spark, d), "subject_id", "week", "delta_from_baseline_kg")
    return finalize(s, default=6)


@register("q_points_class", O.model_long() + f"""
SELECT subject_id, week, tp_index, {O.r('fiber_g_total_week_mean')} AS x, {O.r('delta_kg_next', 2)} AS y,
       CAST(any_kw_widget = 0 AND any_kw_gear = 0 AS INTEGER) AS is_other,
       CAST(any_kw_widget = 1 AS INTEGER) AS is_widget, CAST(any_kw_gear = 1 AS INTEGER) AS is_gear
FROM al WHERE fiber_g_total_week_mean IS NOT NULL AND delta_kg_next IS NOT NULL""")
def q_points_class(spark, d):
    """RP1 + P16: scatter points with their (overlapping) classes."""
    a = P.analysis_long(spark, d).filter(F.col("fiber_g_total_week_mean").isNotNull() & F.col("delta_kg_next").isNotNull())
    out = a.select("subject_id", "week", "tp_index", F.col("fiber_g_total_week_mean").alias("x"),
                   F.col("delta_kg_next").alias("y"),
                   *D.point_classes("any_kw_widget", "any_kw_gear", "widget", "gear"))
    return finalize(out, {"y": 2})


@register("q_small_multiples", O.model_long("""firstn AS (SELECT DISTINCT subject_id FROM al ORDER BY subject_id LIMIT 12)""") + f"""
SELECT a.subject_id, CAST(regr_count(calories_kcal_total_week_mean, CAST(week AS DOUBLE)) AS BIGINT) AS n_points,
       {O.r('CASE WHEN regr_count(calories_kcal_total_week_mean, CAST(week AS DOUBLE)) >= 3 THEN regr_slope(calories_kcal_total_week_mean, CAST(week AS DOUBLE)) END', 4)} AS slope,
       {O.r('CASE WHEN regr_count(calories_kcal_total_week_mean, CAST(week AS DOUBLE)) >= 3 THEN regr_intercept(calories_kcal_total_week_mean, CAST(week AS DOUBLE)) END', 4)} AS intercept
FROM al a WHERE a.subject_id IN (SELECT subject_id FROM firstn) GROUP BY a.subject_id""")
def q_small_multiples(spark, d, n_subjects=12):
    """RP3 + O3 + ST11: calories trend per subject for the first ``n_subjects``
    (the report's 12; deterministic top-k by id, semi-joined back); a line needs
    n >= 3."""
    a = P.analysis_long(spark, d)
    first = a.select("subject_id").distinct().orderBy("subject_id").limit(n_subjects)
    sub = a.join(F.broadcast(first), "subject_id", "left_semi")
    s = regress.group_slopes(sub, "subject_id", "week", "calories_kcal_total_week_mean", min_points=3)
    return finalize(s.select("subject_id", F.col("n_points").cast("bigint"), "slope", "intercept"), default=4)


# ------------------------------------------------------------------ data quality

from paneldeck.operators import quality as Q  # noqa: E402
from paneldeck.plans.contracts import ORDERS_MODEL, STUDY_SUITES, SUITES  # noqa: E402

ROW_MODEL = [Q.Rule("between", "o_totalprice", min_value=1000, max_value=400000),
             Q.Rule("in_set", "o_orderpriority", values=["1-URGENT", "2-HIGH", "3-MEDIUM"]),
             Q.Rule("regex", "o_orderstatus", pattern="^[FO]$")]


def _data_rules(rules):
    return [r for r in rules if r.kind not in Q.META_KINDS]


def _quality_results(spark, d, data_only=True):
    out = None
    for t, rules in SUITES.items():
        rs = _data_rules(rules) if data_only else rules
        e = Q.evaluate(B.read_table(spark, d, t), t, rs)
        out = e if out is None else out.unionByName(e)
    return out


def _quality_sql_union() -> str:
    return "\nUNION ALL\n".join(O.rule_sql(r, t) for t, rules in SUITES.items() for r in _data_rules(rules))


@register("q_quality_rules", _quality_sql_union())
def q_quality_rules(spark, d):
    """DQ4-DQ15: every data rule of the three suites, one aggregate pass per table."""
    return finalize(_quality_results(spark, d))


def _study_tables(spark, d) -> dict[str, DataFrame]:
    """The panel tables in the column names of the study's two contracts."""
    bronze = B.food_rows(spark, d).select(
        F.col("subject_id").cast("string").alias("id"), "date", F.col("food").alias("food_desc"),
        F.col("calories_kcal").alias("calories"), "fiber_g", "protein_g", "fat_g", F.col("carb_g").alias("carbs_g"))
    flag = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    silver = P.analysis_long(spark, d).select(
        F.col("subject_id").cast("string").alias("subject_id"), F.col("week").cast("bigint").alias("study_week"),
        "delta_kg_next", (F.try_divide(F.col("fiber_g_total_week_sum"), F.col("calories_kcal_total_week_sum")) * 1000)
        .alias("fiber_per_1000kcal"), F.col("calories_kcal_total_week_sum").alias("calories_week"),
        flag("any_kw_widget").alias("potato_week"), flag("any_kw_gear").alias("beans_week"),
        F.col("start_weight").alias("weight_kg_baseline"), F.col("value").alias("weight_kg_current"))
    return {"bronze_nutrition_data": bronze, "silver_features": silver}


@register("q_contract_suites", O.model_long("""bronze_nutrition_data AS (
  SELECT CAST(subject_id AS VARCHAR) AS id, date, food AS food_desc, calories_kcal AS calories, fiber_g, protein_g,
         CAST(fat_g AS DOUBLE) AS fat_g, carb_g AS carbs_g FROM fr)""", """silver_features AS (
  SELECT CAST(subject_id AS VARCHAR) AS subject_id, CAST(week AS BIGINT) AS study_week, delta_kg_next,
         CASE WHEN calories_kcal_total_week_sum <> 0
              THEN fiber_g_total_week_sum / calories_kcal_total_week_sum * 1000 END AS fiber_per_1000kcal,
         calories_kcal_total_week_sum AS calories_week, CAST(coalesce(any_kw_widget, 0) AS BIGINT) AS potato_week,
         CAST(coalesce(any_kw_gear, 0) AS BIGINT) AS beans_week, value - delta_kg AS weight_kg_baseline,
         value AS weight_kg_current FROM al)""")
          + "\nUNION ALL\n".join(O.rule_sql(r, t) for t, rules in STUDY_SUITES.items() for r in _data_rules(rules)))
def q_contract_suites(spark, d):
    """DQ4-DQ15: the study's own two contracts on the panel's raw rows and weekly
    features (the metadata rules are in the tests)."""
    parts = [Q.evaluate(df, t, _data_rules(STUDY_SUITES[t])) for t, df in _study_tables(spark, d).items()]
    return finalize(parts[0].unionByName(parts[1]))


@register("q_quality_schema", None)
def q_quality_schema(spark, d):
    """DQ1-DQ3 + DQ17: metadata rules and the exact-schema diff of orders."""
    from pyspark.sql import types as T
    meta = []
    for t, rules in SUITES.items():
        m = [r for r in rules if r.kind in Q.META_KINDS]
        if m:
            meta += Q.check_metadata(B.read_table(spark, d, t), t, m)
    diff = Q.schema_diff(B.read_table(spark, d, "orders"), ORDERS_MODEL)
    rows = [(t, rule, c, ok, None, None) for (t, rule, c, _n, _f, _r, _o, _m, ok) in meta]
    rows += [("orders", "exact_schema", c, False, exp, act) for (c, _p, exp, act) in diff]
    schema = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("rule", T.StringType()),
                           T.StructField("column_name", T.StringType()), T.StructField("success", T.BooleanType()),
                           T.StructField("expected", T.StringType()), T.StructField("actual", T.StringType())])
    return spark.createDataFrame(rows, schema)


@register("q_quality_coerce", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL) AS {c}" for c, t in (
        ("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", "VARCHAR"), ("o_totalprice", "DOUBLE"),
        ("o_orderdate", "DATE"), ("o_orderpriority", "VARCHAR"))) + " FROM orders")
def q_quality_coerce(spark, d):
    """DQ18: coerce orders to the declared row model; values lost per column."""
    _out, lost = Q.coerce(B.read_table(spark, d, "orders"), ORDERS_MODEL)
    return lost


@register("q_quality_rows", "SELECT row_key, rule, column_name, value FROM (\n" + "\nUNION ALL\n".join(
    f"""SELECT o_orderkey AS row_key, '{r.name}' AS rule, '{r.column}' AS column_name, CAST({r.column} AS VARCHAR) AS value,
       row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders
    WHERE {O.rule_predicates_sql(r)[0]} AND NOT coalesce({O.rule_predicates_sql(r)[1]}, false)"""
    for r in ROW_MODEL) + "\n) WHERE rn <= 10")
def q_quality_rows(spark, d):
    """DQ16 + O5: row-model failures per rule, first 10 rows per rule by key."""
    errs = Q.row_errors(B.read_table(spark, d, "orders"), "o_orderkey", ROW_MODEL)
    return Q.capped_errors(errs, 10)


@register("q_quality_summary", "WITH res AS (\n" + _quality_sql_union() + """
)
SELECT table_name, count(*) FILTER (WHERE success) AS expectations_met, count(*) AS total_expectations,
       coalesce(string_agg(CASE WHEN NOT success THEN rule END, ',' ORDER BY rule), '') AS failures,
       bool_and(success) AS success, 'validated' AS status FROM res GROUP BY table_name
UNION ALL SELECT 'silver_features', CAST(0 AS BIGINT), CAST(0 AS BIGINT), '', false, 'missing'""")
def q_quality_summary(spark, d):
    """DQ19 + DQ20: per-table suite summary; of the contract's tables, those that
    the input folder lacks count as failures."""
    s = Q.suite_summary(_quality_results(spark, d))
    s = s.select("table_name", "expectations_met", "total_expectations",
                 F.array_join(F.col("failures"), ",").alias("failures"), "success",
                 F.lit("validated").alias("status"))
    absent = [t for t in [*SUITES, "silver_features"] if not input_listing(spark, table_path(d, t))]
    status = Q.multi_table_status(spark, s.select("table_name", "success"), absent)
    return status.drop("success").join(s.drop("status"), "table_name", "left").select(
        "table_name", F.coalesce("expectations_met", F.lit(0)).cast("bigint").alias("expectations_met"),
        F.coalesce("total_expectations", F.lit(0)).cast("bigint").alias("total_expectations"),
        F.coalesce("failures", F.lit("")).alias("failures"), F.coalesce("success", F.lit(False)).alias("success"),
        "status")


# ------------------------------------------------------------------ ingest

from paneldeck.functions import clean as C  # noqa: E402
from paneldeck.operators import sheets as S  # noqa: E402
from paneldeck.plans import sheet_bindings as SB  # noqa: E402


@register("q_parse_number", f"""SELECT event_id, props, {O._parse_num('props')} AS k_value FROM events""")
def q_parse_number(spark, d):
    """Messy-number parse of every event's props text ('{{"k": 69}}' -> 69)."""
    e = B.read_table(spark, d, "events").select("event_id", "props")
    return e.withColumn("k_value", C.parse_number("props"))


@register("q_trailing_int", """SELECT p_partkey, p_brand,
  CASE WHEN regexp_extract(trim(p_brand), '(\\d+)$', 1) = '' THEN NULL
       ELSE TRY_CAST(regexp_extract(trim(p_brand), '(\\d+)$', 1) AS BIGINT) END AS brand_no FROM part""")
def q_trailing_int(spark, d):
    """Trailing integer of every part brand ('Brand#17' -> 17)."""
    p = B.read_table(spark, d, "part").select("p_partkey", "p_brand")
    return p.withColumn("brand_no", C.trailing_int("p_brand"))


@register("q_norm_text", f"""SELECT doc_id, {O._norm('text')} AS norm_text FROM documents""")
def q_norm_text(spark, d):
    """Normalised text (lower, trimmed, single spaces) of every document."""
    doc = B.read_table(spark, d, "documents").select("doc_id", "text")
    return doc.select("doc_id", C.norm_text("text").alias("norm_text"))


@register("q_serial_date", f"""SELECT p_partkey,
  {O._mixed_date("CAST(44000 + p_size AS VARCHAR)")} AS serial_date,
  {O._mixed_date("strftime(DATE '1899-12-30' + (44000 + p_size), '%Y-%m-%d')")} AS text_date,
  DATE '1899-12-30' + (44000 + p_size) AS iso_time_date, DATE '1899-12-30' + (44000 + p_size) AS month_name_date,
  DATE '1899-12-30' + (44000 + p_size) AS short_year_date, DATE '1899-12-30' + (44000 + p_size) AS dashed_date,
  true AS rejected FROM part""")
def q_serial_date(spark, d):
    """Spreadsheet serial numbers and the common ways of writing a date parse
    to the same day; a cell that holds no date is counted as rejected."""
    p = spread(B.read_table(spark, d, "part").select("p_partkey", "p_size"), "p_partkey")
    serial = (F.lit(44000) + F.col("p_size")).cast("string")
    day = F.date_add(F.lit("1899-12-30").cast("date"), F.lit(44000) + F.col("p_size"))
    text = lambda pattern: C.parse_mixed_date(F.date_format(day, pattern))
    return p.select("p_partkey", C.parse_mixed_date(serial).alias("serial_date"),
                    text("yyyy-MM-dd").alias("text_date"), text("yyyy-MM-dd'T'10:00:00").alias("iso_time_date"),
                    text("MMM d, yyyy").alias("month_name_date"), text("M/d/yy").alias("short_year_date"),
                    text("MM-dd-yyyy").alias("dashed_date"),
                    C.date_rejected(F.concat(F.lit("week "), serial)).alias("rejected"))


def _food_cells_sql(*extra):
    return "WITH " + ",\n".join([FOOD_SQL_CELLS, *O.header_ctes("cells_f", "f_"), *extra]) + "\n"


FOOD_SQL_CELLS = O.FOOD_CELLS


@register("q_header_detect", _food_cells_sql() + "SELECT source_path, sheet_name, header_row, header_inferred FROM f_hr")
def q_header_detect(spark, d):
    """I4 + I7: header row per sheet (row 0, or sniffed when row 0 looks wrong)."""
    return S.choose_header_row(SB.unpack(SB.food_log_rows(spark, d, bucket_count(spark, d))))


def _both_cells_sql(*extra):
    ctes = [O.FOOD_ROWS, O.DAILY, O.MEASURES, O.FOOD_CELLS, O.LABEL_CELLS,
            "cells_all AS (SELECT * FROM cells_f UNION ALL SELECT * FROM cells_l)",
            *O.header_ctes("cells_all", "a_"), *O.kind_ctes("cells_all", "a_"), *extra]
    return "WITH " + ",\n".join(ctes) + "\n"


def _packed_sheets(spark, d):
    """All sheets' rows, packed, with their header row; written once, in buckets by
    sheet.  Each kind of sheet is dealt once, before its cells are made: rows are
    grouped, sheets are grouped and the result is joined back where they lie, and
    later groupings and joins by sheet find the rows in their buckets."""
    def build():
        n = bucket_count(spark, d)
        logs, labels = (rows.join(S.choose_header_row(SB.unpack(rows)), S.SHEET)
                        for rows in (SB.food_log_rows(spark, d, n), SB.label_rows(spark, d, n)))
        return logs.unionByName(labels)
    return materialized(spark, ("cells_h", d), build, by=S.SHEET)


def _sheet_stage(spark, d):
    """(cells with their header row, header rows, normalised headers).  The header
    rows and headers have one row and a few rows a sheet."""
    ph = _packed_sheets(spark, d)
    hr = ph.select(*S.SHEET, "header_row", "header_inferred").distinct()
    ch = SB.unpack(ph.drop("header_inferred"))
    h = materialized(spark, ("headers", d), lambda: S.normalized_headers(ch, hr), by=S.SHEET)
    return ch, hr, h


def _cells_of(spark, d, sheets):
    """The cells, with their header row, of the sheets named: packed rows are joined."""
    return SB.unpack(_packed_sheets(spark, d).drop("header_inferred").join(sheets, S.SHEET, "left_semi"))


@register("q_sheet_kind", _both_cells_sql() + """SELECT n.source_path, n.sheet_name, n.is_nutrition, l.is_label,
  (SELECT string_agg(name, ',' ORDER BY col_no) FROM a_hd h WHERE h.source_path = n.source_path AND h.sheet_name = n.sheet_name) AS headers
FROM a_nut n JOIN a_lab l ON n.source_path = l.source_path AND n.sheet_name = l.sheet_name""")
def q_sheet_kind(spark, d):
    """I5 + I6 + I8: per sheet the nutrition / label-style classification and
    its normalised, de-duplicated header names."""
    cells, hr, h = _sheet_stage(spark, d)
    names = h.groupBy(*S.SHEET).agg(F.array_join(F.sort_array(F.collect_list(F.struct("col_no", "name"))).getField("name"), ",")
                                    .alias("headers"))
    return S.nutrition_sheets(h).join(S.label_sheets(cells, hr), S.SHEET).join(names, S.SHEET)


def _tidy_labels(spark, d, stage=None):
    cells, hr, h = stage if stage is not None else _sheet_stage(spark, d)

    def label_cells():
        lab = S.label_sheets(cells, hr).filter("is_label").select(*S.SHEET)
        return _cells_of(spark, d, lab)
    # the label-style sheets' cells (a small part of all cells) feed several
    # self-joins of the tidy step: written once instead of re-derived per branch
    lc = materialized(spark, ("label_sheet_cells", d), label_cells, by=S.SHEET)
    return S.tidy_label_sheets(lc, hr, h)


LABEL_COLS = ["subject_id", "metric", "phase", "week", "value", "tp_index", "timepoint", "note", "sheet_name",
              "source_path", "row_no", "col_no"]


@register("q_label_parse", _both_cells_sql(
    "lcells AS (SELECT c.* FROM cells_all c JOIN a_lab l ON c.source_path = l.source_path AND c.sheet_name = l.sheet_name WHERE l.is_label)",
    *O.header_ctes("lcells", "l_"), *O.kind_ctes("lcells", "l_")[1:2], *O.label_parse_ctes("l_"))
          + "SELECT " + ", ".join(O.r('value', 2) + " AS value" if c == "value" else c for c in LABEL_COLS) + " FROM l_tidy")
def q_label_parse(spark, d):
    """Label-style sheets unpivoted and parsed into tidy measures."""
    return finalize(_tidy_labels(spark, d).select(*LABEL_COLS), {"value": 2})


STD_COLS = ["source_path", "sheet_name", "row_no", "date", "food", "fiber_g", "calories_kcal", "protein_g", "carb_g",
            "subject_id"]


def _std_sql() -> str:
    from paneldeck.operators.sheets import FIELD_TERMS, GENERIC_FIBER_TERMS

    def any_of(terms):
        return "(" + " OR ".join(f"contains(name, '{t}')" for t in terms) + ")"
    specs = {f: any_of(t) for f, t in FIELD_TERMS.items()}
    specs["insoluble"] = "contains(name, 'insoluble')"
    specs["soluble"] = "(contains(name, 'soluble') AND NOT contains(name, 'insoluble'))"
    specs["fiber"] = f"({any_of(GENERIC_FIBER_TERMS)} AND NOT contains(name, 'soluble'))"
    specs["subject"] = "(contains(name, 'subject') AND contains(name, 'id'))"
    res = ", ".join(f"min(col_no) FILTER (WHERE {c}) AS c_{f}" for f, c in specs.items())
    raw = ", ".join(f"max(CASE WHEN d.col_no = r.c_{f} THEN d.value END) AS raw_{f}" for f in specs)
    return _both_cells_sql(
        "lcells AS (SELECT c.* FROM cells_all c JOIN a_lab l ON c.source_path = l.source_path AND c.sheet_name = l.sheet_name WHERE l.is_label)",
        *O.header_ctes("lcells", "l_"), *O.kind_ctes("lcells", "l_")[1:2], *O.label_parse_ctes("l_"),
        "ncells AS (SELECT c.* FROM cells_all c JOIN a_nut n ON c.source_path = n.source_path AND c.sheet_name = n.sheet_name WHERE n.is_nutrition)",
        f"res AS (SELECT source_path, sheet_name, {res} FROM a_hd GROUP BY source_path, sheet_name)",
        f"""rows AS (SELECT d.source_path, d.sheet_name, d.row_no, {raw}
   FROM a_data d JOIN ncells n ON d.source_path = n.source_path AND d.sheet_name = n.sheet_name AND d.row_no = n.row_no AND d.col_no = n.col_no
   JOIN res r ON d.source_path = r.source_path AND d.sheet_name = r.sheet_name
   GROUP BY d.source_path, d.sheet_name, d.row_no)""") + f"""
SELECT x.source_path, x.sheet_name, x.row_no, {O._mixed_date('raw_date')} AS date, raw_food AS food,
       {O.r(f"CASE WHEN {O._parse_num('raw_insoluble')} IS NOT NULL AND {O._parse_num('raw_soluble')} IS NOT NULL THEN {O._parse_num('raw_insoluble')} + {O._parse_num('raw_soluble')} ELSE {O._parse_num('raw_fiber')} * CASE WHEN contains(lower(raw_fiber), 'mg') THEN 0.001 ELSE 1.0 END END", 4)} AS fiber_g,
       {O.r(O._parse_num('raw_calories_kcal'), 4)} AS calories_kcal, {O.r(O._parse_num('raw_protein_g'), 4)} AS protein_g,
       {O.r(O._parse_num('raw_carb_g'), 4)} AS carb_g, coalesce(raw_subject, w.workbook_subject_id) AS subject_id
FROM rows x LEFT JOIN l_wb w ON x.source_path = w.source_path"""


@register("q_standardize", _std_sql())
def q_standardize(spark, d):
    """I13-I16 + I11/J8: nutrition sheets standardised to food rows (dates,
    nutrients, fiber resolution), subject from the row or the workbook."""
    cells, hr, h = _sheet_stage(spark, d)
    nut = S.nutrition_sheets(h).filter("is_nutrition").select(*S.SHEET)
    res = S.resolve_columns(h.join(nut, S.SHEET, "left_semi"))
    wb = cut_lineage(S.workbook_subject(_tidy_labels(spark, d, (cells, hr, h))))
    out = S.standardize_nutrition(_cells_of(spark, d, nut), hr, res, wb)
    return finalize(out.select(*STD_COLS), default=4)


DAY_SQL = f"""WITH {O.EVENTS},
dd AS (SELECT subject_id, date, avg(CASE WHEN event_type = 'purchase' THEN value END) AS w FROM ev GROUP BY subject_id, date),
sp AS (SELECT subject_id, min(date) AS d0, max(date) AS d1 FROM dd GROUP BY subject_id),
cells_d AS (
  SELECT 'daily/' || CAST(dd.subject_id AS VARCHAR) || '_Sheet1.csv' AS source_path, 'Sheet1' AS sheet_name, 2 AS row_no,
         CAST(4 + datediff('day', sp.d0, dd.date) AS INTEGER) AS col_no, CAST(CAST(floor(w) AS BIGINT) AS VARCHAR) AS value
  FROM dd JOIN sp ON dd.subject_id = sp.subject_id
  UNION ALL SELECT 'daily/' || CAST(subject_id AS VARCHAR) || '_Sheet1.csv', 'Sheet1', 2, 0, 'Weight in the Morning' FROM sp
  UNION ALL SELECT 'daily/' || CAST(subject_id AS VARCHAR) || '_Sheet1.csv', 'Sheet1', 2, 1, 'lbs' FROM sp
  UNION ALL SELECT 'daily/' || CAST(subject_id AS VARCHAR) || '_Sheet1.csv', 'Sheet1', 0, c, v
    FROM sp, (VALUES (0, 'Day'), (1, 'Unit'), (2, 'Goal'), (3, 'Notes')) t(c, v)
  UNION ALL SELECT 'daily/' || CAST(subject_id AS VARCHAR) || '_Sheet1.csv', 'Sheet1', 0,
         CAST(4 + datediff('day', d0, d1) + 1 + k AS INTEGER), v
    FROM sp, (VALUES (0, 'participant_id'), (1, 'category'), (2, 'notes')) t(k, v)),
hit AS (SELECT source_path, sheet_name, min(row_no) AS r FROM cells_d WHERE contains(value, 'Weight in the Morning') GROUP BY ALL),
wid AS (SELECT source_path, sheet_name, max(col_no) + 1 AS w FROM cells_d GROUP BY ALL),
wt AS (SELECT c.source_path, c.sheet_name, c.col_no, c.value, TRY_CAST(c.value AS DOUBLE) AS v FROM cells_d c
       JOIN hit h ON c.source_path = h.source_path AND c.sheet_name = h.sheet_name
       JOIN wid x ON c.source_path = x.source_path AND c.sheet_name = x.sheet_name
       WHERE c.row_no = h.r AND c.col_no >= 4 AND c.col_no < x.w - 3),
pre AS (SELECT * FROM (SELECT *, sum(CASE WHEN v IS NULL OR v < 80 OR v > 400 THEN 1 ELSE 0 END)
          OVER (PARTITION BY source_path, sheet_name ORDER BY col_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bad
        FROM wt WHERE value IS NOT NULL) WHERE bad = 0),
rng AS (SELECT * FROM wt WHERE v BETWEEN 50 AND 500)
SELECT s.source_path, s.sheet_name, CAST(coalesce(p.n_prefix, 0) AS BIGINT) AS n_prefix, p.first_prefix, p.last_prefix,
       CAST(coalesce(g.n_range, 0) AS BIGINT) AS n_range, g.mean_range
FROM (SELECT DISTINCT source_path, sheet_name FROM wt) s
LEFT JOIN (SELECT source_path, sheet_name, count(*) AS n_prefix, arg_min(v, col_no) AS first_prefix, arg_max(v, col_no) AS last_prefix
           FROM pre GROUP BY ALL) p ON s.source_path = p.source_path AND s.sheet_name = p.sheet_name
LEFT JOIN (SELECT source_path, sheet_name, count(*) AS n_range, {O.r('avg(v)', 4)} AS mean_range FROM rng GROUP BY ALL) g
  ON s.source_path = g.source_path AND s.sheet_name = g.sheet_name"""


@register("q_day_sheet", DAY_SQL)
def q_day_sheet(spark, d):
    """I17 + I19 + I20: weights from each day sheet's 'Weight in the Morning'
    row: the valid prefix (80-400, stop at first invalid) and the 50-500
    range filter with day numbers."""
    w = cut_lineage(S.day_sheet_weights(SB.day_sheet_cells(spark, d)))
    pre = S.valid_prefix(w).groupBy(*S.SHEET).agg(
        F.count(F.lit(1)).alias("n_prefix"), F.min_by("v", "col_no").alias("first_prefix"),
        F.max_by("v", "col_no").alias("last_prefix"))
    rng = S.valid_range_filter(w).groupBy(*S.SHEET).agg(F.max("day").alias("n_range"), F.avg("v").alias("mean_range"))
    out = w.select(*S.SHEET).distinct().join(pre, S.SHEET, "left").join(rng, S.SHEET, "left")
    out = out.select(*S.SHEET, F.coalesce("n_prefix", F.lit(0)).cast("bigint").alias("n_prefix"), "first_prefix",
                     "last_prefix", F.coalesce("n_range", F.lit(0)).cast("bigint").alias("n_range"), "mean_range")
    return finalize(out, {"mean_range": 4})


@register("q_summary_sheet", """SELECT 'daily/' || CAST(user_id AS VARCHAR) || '_Summary.csv' AS source_path, 'Summary' AS sheet_name,
  CAST(user_id AS VARCHAR) AS subject_id, CAST(first(value ORDER BY CAST(ts AS DATE), value) AS VARCHAR) AS starting_weight,
  CAST(last(value ORDER BY CAST(ts AS DATE), value) AS VARCHAR) AS ending_weight
FROM events WHERE event_type = 'purchase' AND value IS NOT NULL AND ts IS NOT NULL GROUP BY user_id""")
def q_summary_sheet(spark, d):
    """key/value summary sheets -> subject, starting and final weight."""
    return S.summary_values(SB.summary_cells(spark, d))


# ------------------------------------------------------------------ sources, sinks, reshape, run log

import os  # noqa: E402

from paneldeck import schemas as SC  # noqa: E402
from paneldeck.operators import runlog as RL  # noqa: E402
from paneldeck.session import checkpoint_dir  # noqa: E402
from paneldeck.sources import files as FS  # noqa: E402


def _scratch(spark, name: str) -> str:
    import uuid
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:8]}")


@register("q_sink_roundtrip", O.long_base() + f"""
SELECT CAST(subject_id AS VARCHAR) AS subject_id, date, {O.r('fiber_g_total', 2)} AS fiber_g_total,
       {O.r('calories_kcal_total', 2)} AS calories_kcal_total, {O.r('carb_g_total', 4)} AS carb_g_total,
       {O.r('protein_g_total', 4)} AS protein_g_total, {O.r('fat_g_total', 2)} AS fat_g_total, n_entries FROM daily""")
def q_sink_roundtrip(spark, d):
    """S10 + S11 + S3: daily rollup aligned to the declared long-dialect schema,
    written as CSV and Parquet (partitioned by year) to the shared folder, and
    read back through the typed CSV scan."""
    daily = B.daily_long(spark, d)
    aligned = FS.align_to_schema(daily, SC.DAILY_LONG)
    base = _scratch(spark, "daily_long")
    FS.save_table(aligned, csv_path=base + "/csv", parquet_path=base + "/parquet")
    back = FS.read_typed_csv(spark, base + "/csv", SC.DAILY_LONG, date_cols=("date",))
    return finalize(back, DAILY_SCALES)


@register("q_food_rows_load", f"""WITH {O.FOOD_ROWS},
loaded AS (SELECT *, line_no % 4 = 3 AND order_key % 10 = 0 AS off FROM fr)
SELECT CAST(subject_id AS VARCHAR) AS subject_id, CASE WHEN NOT off THEN date END AS date, count(*) AS n_rows,
  count(food) AS n_foods, {O.r('sum(fiber_g)', 2)} AS fiber_g, {O.r('sum(calories_kcal)', 2)} AS calories_kcal,
  CAST(sum(CASE WHEN off THEN 1 ELSE 0 END) AS BIGINT) AS n_rejected
FROM loaded GROUP BY 1, 2""")
def q_food_rows_load(spark, d):
    """All food rows as CSV, their dates written in four ways and some
    that are none, loaded through the typed scan and added up by subject and day;
    rejected dates are counted; the optional side table is absent, so the left join
    leaves the days as they are."""
    rows, path = B.food_rows(spark, d), _scratch(spark, "food_rows")
    day, way = F.col("date"), F.col("line_no") % 4
    text = (F.when(way == 1, F.date_format(day, "M/d/yyyy")).when(way == 2, F.date_format(day, "MMM d, yyyy"))
            .when((way == 3) & (F.col("order_key") % 10 == 0), F.lit("some day in spring"))
            .when(way == 3, F.date_format(day, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(day, "yyyy-MM-dd")))
    names = SC.NUTRITION_ROWS_LONG.fieldNames()
    written = rows.withColumn("date", text)
    FS.save_table(written.select(*[(F.col(c) if c in written.columns else F.lit(None).cast("string")).alias(c) for c in names]),
                  csv_path=path + "/rows")
    back = FS.read_typed_csv(spark, path + "/rows", SC.NUTRITION_ROWS_LONG, date_cols=("date",), reject_col="rejected")
    days = back.groupBy("subject_id", "date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("food").alias("n_foods"), F.sum("fiber_g").alias("fiber_g"),
        F.sum("calories_kcal").alias("calories_kcal"), F.sum(F.col("rejected").cast("long")).alias("n_rejected"))
    side = FS.first_existing(spark, [(path + "/phases.csv", SC.DAILY_LONG)])
    return finalize(assemble.left_join_or_self(days, side, ["subject_id", "date"]), {"fiber_g": 2, "calories_kcal": 2})


@register("q_glob_provenance", """SELECT 'event_type=' || event_type AS folder, count(*) AS n_rows,
  count(DISTINCT user_id) AS n_participants FROM events GROUP BY event_type""")
def q_glob_provenance(spark, d):
    """Events written as one folder per type, read back by a recursive
    glob with provenance columns (file, folder), grouped by folder."""
    base = _scratch(spark, "events_csv")
    ev = B.read_table(spark, d, "events").select("user_id", "event_type", "value")
    ev.write.mode("overwrite").option("header", True).partitionBy("event_type").csv(base)
    schema = SC._st(("user_id", SC.L), ("value", SC.D))
    g = FS.read_glob(spark, base, schema, pattern="*.csv", exclude_substring="combined")
    return g.groupBy("folder").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user_id").alias("n_participants"))


@register("q_json_roundtrip", None)
def q_json_roundtrip(spark, d):
    """Model coefficients through the JSON sink and typed JSON source."""
    coefs = q_ols(spark, d)
    path = _scratch(spark, "ols_json")
    FS.save_json(coefs, path)
    return FS.read_json(spark, path, regress.COEF_SCHEMA)


@register("q_unpivot", O.long_base() + "\nUNION ALL\n".join(
    f"SELECT subject_id, date, '{n}' AS nutrient, {O.r(n, 4)} AS value FROM daily" for n in B.DAILY_NUTRIENTS))
def q_unpivot(spark, d):
    """U4: daily nutrient totals unpivoted to (subject, date, nutrient, value)."""
    daily = B.daily_long(spark, d)
    return finalize(daily.unpivot(["subject_id", "date"], B.DAILY_NUTRIENTS, "nutrient", "value"), default=4)


UNION_COLS = ["subject_id", "date", "food", "fiber_g", "calories_kcal", "carb_g", "protein_g", "fat_g", "sugar_g",
              "insoluble_fiber_g", "soluble_fiber_g", "sheet_name", "source_path"]


@register("q_union_align", O.long_base(O.EVENTS) + f"""
SELECT CAST(subject_id AS VARCHAR) AS subject_id, date, food, {O.r('fiber_g', 4)} AS fiber_g,
       {O.r('calories_kcal', 4)} AS calories_kcal, {O.r('carb_g', 4)} AS carb_g, {O.r('protein_g', 4)} AS protein_g,
       {O.r('fat_g', 4)} AS fat_g, CAST(NULL AS DOUBLE) AS sugar_g, CAST(NULL AS DOUBLE) AS insoluble_fiber_g,
       CAST(NULL AS DOUBLE) AS soluble_fiber_g, 'lineitem' AS sheet_name, CAST(NULL AS VARCHAR) AS source_path FROM fr
UNION ALL
SELECT CAST(subject_id AS VARCHAR), date, event_type, CAST(NULL AS DOUBLE), {O.r('value', 4)}, NULL, NULL, NULL, NULL, NULL,
       NULL, 'events', CAST(NULL AS VARCHAR) FROM ev""")
def q_union_align(spark, d):
    """U1 + S11: two differently shaped food-row sources unioned by name
    (missing columns NULL) and aligned to the declared nutrition-rows schema."""
    a = B.food_rows(spark, d).drop("category", "order_key", "line_no").withColumn("sheet_name", F.lit("lineitem"))
    e = (B.events_clean(spark, d)
         .select("subject_id", "date", F.col("event_type").alias("food"), F.col("value").alias("calories_kcal"),
                 F.lit("events").alias("sheet_name")))
    u = a.unionByName(e, allowMissingColumns=True)
    return finalize(FS.align_to_schema(u, SC.NUTRITION_ROWS_LONG).select(*UNION_COLS), default=4)


@register("q_panel_stats", O.model_long() + """
SELECT 'analysis_long' AS table_name, count(*) AS n_rows, count(DISTINCT subject_id) AS n_subjects,
       count(DISTINCT week) AS n_weeks FROM al
UNION ALL SELECT 'weekly_long', count(*), count(DISTINCT subject_id), count(DISTINCT week_index) FROM weekly
UNION ALL SELECT 'daily_long', count(*), count(DISTINCT subject_id), CAST(NULL AS BIGINT) FROM daily""")
def q_panel_stats(spark, d):
    """M2 + A12 + O2: rows, subjects and weeks of each pipeline output."""
    parts = [RL.panel_stats(P.analysis_long(spark, d)).select(F.lit("analysis_long").alias("table_name"), "*"),
             RL.panel_stats(P.weekly_long(spark, d), week="week_index").select(F.lit("weekly_long").alias("table_name"), "*"),
             RL.panel_stats(B.daily_long(spark, d), week=None).select(
                 F.lit("daily_long").alias("table_name"), "*", F.lit(None).cast("bigint").alias("n_weeks"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def steps_log(spark, d):
    """The events table read as a step log (run = user, step = event type)."""
    e = B.read_table(spark, d, "events")
    return e.select(F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("step"),
                    F.col("ts").alias("started_at"), F.col("value").alias("seconds"),
                    F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("success")).alias("status"),
                    F.col("event_id").alias("rows_out"))


@register("q_run_metrics", f"""WITH st AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS step, ts AS started_at, value AS seconds,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, event_id AS rows_out FROM events),
lt AS (SELECT max(started_at) AS latest FROM st)
SELECT step, count(*) AS n_runs, count(*) FILTER (WHERE status = 'success') AS n_success,
       count(*) FILTER (WHERE status <> 'success') AS n_failed,
       {O.r("avg(CASE WHEN status = 'success' THEN 1.0 ELSE 0.0 END)")} AS success_rate,
       {O.r('avg(seconds)', 4)} AS mean_seconds, {O.r('quantile_cont(seconds, 0.95)', 4)} AS p95_seconds,
       CAST(coalesce(sum(rows_out), 0) AS BIGINT) AS rows_out,
       CAST(max(CASE WHEN status = 'success' THEN started_at END) AS VARCHAR) AS last_success,
       {O.r("(epoch_us((SELECT latest FROM lt)) - epoch_us(max(CASE WHEN status = 'success' THEN started_at END))) / 3.6e9", 4)} AS freshness_hours
FROM st GROUP BY step""")
def q_run_metrics(spark, d):
    """M3 + M4: per-step success counters, exact p95 duration and freshness."""
    out = RL.step_stats(steps_log(spark, d)).withColumn("last_success", F.col("last_success").cast("string"))
    return finalize(out, {"success_rate": 6}, default=4)


@register("q_run_rollup", """SELECT count(DISTINCT CAST(user_id AS VARCHAR)) AS runs,
  count(*) FILTER (WHERE event_type <> 'error') AS successes, CAST(coalesce(sum(event_id), 0) AS BIGINT) AS total_rows FROM events""")
def q_run_rollup(spark, d):
    """A23 / RP7: runs, successful steps, total rows written."""
    return RL.run_rollup(steps_log(spark, d))


# ------------------------------------------------------------------ more report tables

from paneldeck.functions.dictionaries import DOCUMENT_KEYWORDS  # noqa: E402


@register("q_kw_documents", "SELECT doc_id, " + ", ".join(
    f"CAST({O.flag('t', p)} AS INTEGER) AS {c}_flag, CAST({O.mentions('t', p)} AS INTEGER) AS {c}_mentions"
    for c, p in DOCUMENT_KEYWORDS.items())
          + " FROM (SELECT doc_id, " + O.unicode_words("lower(coalesce(text, ''))")
          + " AS t FROM documents)")
def q_kw_documents(spark, d):
    """A5 on whole texts: per document, keyword flags and mention counts."""
    doc = B.read_table(spark, d, "documents").select("doc_id", "text")
    t = F.lower(F.coalesce(F.col("text"), F.lit("")))
    cols = []
    for c, p in DOCUMENT_KEYWORDS.items():
        cols.append(t.rlike("(?i)" + p).cast("int").alias(f"{c}_flag"))
        cols.append(F.regexp_count(t, F.lit("(?i)" + p)).cast("int").alias(f"{c}_mentions"))
    return doc.select("doc_id", *cols)


@register("q_calories_trend", _with(O.model_long(), O.trend_sql("al", "calories_kcal_total_week_mean", LONG_Y)))
def q_calories_trend(spark, d):
    """RP4 + ST11: calories vs next-observation change with its fitted trend."""
    g = regress.trend_grid(model_panel_long(spark, d), None, "calories_kcal_total_week_mean", LONG_Y)
    return finalize(g.select(F.col("i").cast("int"), "x", "yhat", "se_mean"), default=4)


@register("q_subject_bands", None)
def q_subject_bands(spark, d, n_subjects=8):
    """RP2 + O3 + ST11: trajectory bands (fitted line ± t·se) of the first
    ``n_subjects`` by id (the report's 8), on a 100-point week grid."""
    t = P.trajectories_long(spark, d)
    first = t.select("subject_id").distinct().orderBy("subject_id").limit(n_subjects)
    sub = t.join(F.broadcast(first), "subject_id", "left_semi")
    return regress.trend_grid(sub, "subject_id", "week", "value")


NUTRI_DESCRIBE = ["fiber_g_total", "calories_kcal_total", "n_entries"]


def _describe_sql_over(src_cte: str, cols: list[str]) -> str:
    stats = [("count", "CAST(count({c}) AS DOUBLE)"), ("mean", "avg({c})"), ("std", "stddev_samp({c})"),
             ("min", "min({c})"), ("25%", "quantile_cont({c}, 0.25)"), ("50%", "quantile_cont({c}, 0.5)"),
             ("75%", "quantile_cont({c}, 0.75)"), ("max", "max({c})")]
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS statistic, " + ", ".join(O.r(f.format(c=c), 4) + f' AS "{c}"' for c in cols)
        + f" FROM {src_cte}" for name, f in stats)


@register("q_nutrition_overview", O.long_base() + _describe_sql_over("daily", NUTRI_DESCRIBE))
def q_nutrition_overview(spark, d):
    """RP8 + A14: distribution summary of the daily nutrition totals."""
    return finalize(D.describe(B.daily_long(spark, d), NUTRI_DESCRIBE), default=4)


@register("q_study_summary", O.model_wide() + f"""
, fin AS (SELECT max(week) AS fw FROM traj_w),
lastw AS (SELECT t.delta_from_baseline_kg AS dv FROM traj_w t, fin WHERE t.week = fin.fw AND t.delta_from_baseline_kg IS NOT NULL)
SELECT 'n_subjects' AS metric, CAST(count(DISTINCT subject_id) AS DOUBLE) AS value FROM merged
UNION ALL SELECT 'n_observations', CAST(count(*) AS DOUBLE) FROM merged
UNION ALL SELECT 'study_weeks', CAST(max(week) AS DOUBLE) FROM merged
UNION ALL SELECT 'final_mean_change', {O.r('avg(dv)', 4)} FROM lastw
UNION ALL SELECT 'final_sd_change', {O.r('stddev_samp(dv)', 4)} FROM lastw
UNION ALL SELECT 'final_share_losing', {O.r('avg(CASE WHEN dv < 0 THEN 1.0 ELSE 0.0 END)')} FROM lastw
UNION ALL SELECT 'mean_fiber', {O.r('avg(fiber_g_week)', 4)} FROM merged
UNION ALL SELECT 'sd_fiber', {O.r('stddev_samp(fiber_g_week)', 4)} FROM merged
UNION ALL SELECT 'share_widget_weeks', {O.r('avg(CAST(widget_week AS DOUBLE))')} FROM merged
UNION ALL SELECT 'share_gear_weeks', {O.r('avg(CAST(gear_week AS DOUBLE))')} FROM merged
UNION ALL SELECT 'fiber_next_delta_r', {O.r('CASE WHEN var_pop(fiber_g_week) * var_pop(delta_kg_next) > 0 THEN covar_pop(fiber_g_week, delta_kg_next) / sqrt(var_pop(fiber_g_week) * var_pop(delta_kg_next)) END')} FROM merged""")
def q_study_summary(spark, d):
    """RP9: the study summary panel (A20, A21, A24, ST8) as (metric, value)."""
    m = model_panel_wide(spark, d)
    last = D.outcome_summary(P.trajectories_wide(spark, d), "subject_id", "week", "delta_from_baseline_kg")
    base = m.agg(F.countDistinct("subject_id").cast("double").alias("n_subjects"),
                 F.count(F.lit(1)).cast("double").alias("n_observations"),
                 F.max("week").cast("double").alias("study_weeks"),
                 F.round(F.avg("fiber_g_week"), 4).alias("mean_fiber"),
                 F.round(F.stddev_samp("fiber_g_week"), 4).alias("sd_fiber"),
                 F.round(F.avg(F.col("widget_week").cast("double")), 6).alias("share_widget_weeks"),
                 F.round(F.avg(F.col("gear_week").cast("double")), 6).alias("share_gear_weeks"),
                 F.round(F.try_divide(F.covar_pop("fiber_g_week", "delta_kg_next"),
                                      F.sqrt(F.var_pop("fiber_g_week") * F.var_pop("delta_kg_next"))), 6)
                 .alias("fiber_next_delta_r"))
    fin = last.select(F.round("mean_change", 4).alias("final_mean_change"), F.round("sd_change", 4).alias("final_sd_change"),
                      F.round("share_losing", 6).alias("final_share_losing"))
    b_names = ["n_subjects", "n_observations", "study_weeks", "mean_fiber", "sd_fiber", "share_widget_weeks",
               "share_gear_weeks", "fiber_next_delta_r"]
    f_names = ["final_mean_change", "final_sd_change", "final_share_losing"]
    long = base.unpivot([], b_names, "metric", "value").unionByName(fin.unpivot([], f_names, "metric", "value"))
    return finalize(long)


@register("q_soft_load", O.long_base() + """
SELECT 'tidy' AS name, 'loaded' AS status, (SELECT count(*) FROM meas) AS rows, 'missing' AS strict_load, true AS optional_found
UNION ALL SELECT 'daily', 'loaded', (SELECT count(*) FROM daily), 'missing', true
UNION ALL SELECT 'nutrition_rows', 'missing', CAST(NULL AS BIGINT), 'missing', true""")
def q_soft_load(spark, d):
    """The three pipeline inputs written as CSV to the shared folder,
    then a soft multi-file load where one expected input is absent (status
    table), the strict load's failure list and optional-source discovery."""
    base = _scratch(spark, "inputs")
    m = B.measures_long(spark, d).select(F.col("subject_id").cast("string").alias("subject_id"), "metric", "phase",
                                         "week", "value", "tp_index")
    FS.save_table(FS.align_to_schema(m, SC.MEASURES_LONG), csv_path=base + "/tidy.csv")
    FS.save_table(FS.align_to_schema(B.daily_long(spark, d), SC.DAILY_LONG), csv_path=base + "/daily.csv")
    specs = {"tidy": (base + "/tidy.csv", SC.MEASURES_LONG), "daily": (base + "/daily.csv", SC.DAILY_LONG),
             "nutrition_rows": (base + "/nutrition_rows.csv", SC.NUTRITION_ROWS_LONG)}
    loaded, status = FS.load_soft(spark, specs)
    counts = {k: v.count() for k, v in loaded.items()}
    try:
        FS.load_strict(spark, specs)
        strict = "ok"
    except FileNotFoundError:
        strict = "missing"
    opt = FS.first_existing(spark, [(base + "/nutrition_rows.csv", SC.NUTRITION_ROWS_LONG),
                                    (base + "/daily.csv", SC.DAILY_LONG)])
    rows = F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), F.lit(v))])
    return status.select("name", "status", rows[F.col("name")].cast("bigint").alias("rows"),
                         F.lit(strict).alias("strict_load"), F.lit(opt is not None).alias("optional_found"))


@register("q_within_slope_list", _with(O.model_long(), O.within_slope_list_sql("al", LONG_Y, LONG_X[0], LONG_X[1])))
def q_within_slope_list(spark, d):
    """ST6: the per-subject within-subject fiber coefficients (the list)."""
    s = regress.within_slopes(model_panel_long(spark, d), LONG_Y, LONG_X[0], LONG_X[1], "subject_id")
    return finalize(s.select("subject_id", "coef_x1"), {"coef_x1": 4})


@register("q_reject_counts", """SELECT 'lineitem_food_rows' AS source, reject_reason, CAST(count(*) AS BIGINT) AS n_rows FROM (
  SELECT CASE WHEN o.o_custkey IS NULL THEN 'null_subject_id' WHEN o.o_orderdate IS NULL THEN 'null_date' END AS reject_reason
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)
GROUP BY reject_reason
UNION ALL
SELECT 'events', CASE WHEN user_id IS NULL THEN 'null_subject_id' WHEN ts IS NULL THEN 'null_date' END, CAST(count(*) AS BIGINT)
FROM events GROUP BY 2""")
def q_reject_counts(spark, d):
    """Q8: valid and rejected rows (NULL subject or date) of the two row sources;
    a NULL reason counts the valid rows."""
    from paneldeck.operators import rollup
    parts = [rows.groupBy(rollup.reject_reason(["subject_id", "date"]).alias("reject_reason"))
             .agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("source"), "reject_reason", "n_rows")
             for name, rows in (("lineitem_food_rows", B.food_rows(spark, d)), ("events", B.events_clean(spark, d)))]
    return parts[0].unionByName(parts[1])


@register("q_stream_daily", """SELECT user_id AS subject_id, CAST(ts AS DATE) AS date,
  round(coalesce(sum(CASE WHEN event_type <> 'error' THEN value END), 0.0), 4) AS value_total, count(*) AS n_entries
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""")
def q_stream_daily(spark, d):
    """A1 incrementally: the events table arrives in two portions of files in the
    shared folder; a Structured Streaming query (watermark, one-day event windows,
    update mode, availableNow) takes each in turn, and the latest state of every
    subject-day is read back.  The replay is out of order within a portion, so
    the lateness allowed is the whole span of the table."""
    from paneldeck.streaming.daily_stream import latest_days, run_daily_rollup
    base = _scratch(spark, "stream")
    ev = B.read_table(spark, d, "events").where("ts is not null")
    span = ev.agg(F.percentile_approx("ts", 0.5).alias("cut"),
                  (F.datediff(F.max("ts"), F.min("ts")) + 2).alias("days")).first()
    if span["cut"] is not None:
        for portion in (F.col("ts") < F.lit(span["cut"]), F.col("ts") >= F.lit(span["cut"])):
            ev.filter(portion).write.mode("append").parquet(base + "/src")
            run_daily_rollup(spark, base + "/src", base + "/sink", name=os.path.basename(base),
                             lateness=f"{span['days']} days")
    return finalize(latest_days(spark, base + "/sink"), {"value_total": 4})


@register("q_index_slope", O.wide_base() + f"""
, nn AS (SELECT subject_id, weight_kg,
                CAST(row_number() OVER (PARTITION BY subject_id ORDER BY date) - 1 AS DOUBLE) AS idx
         FROM mw WHERE weight_kg IS NOT NULL)
SELECT subject_id, count(*) AS n_points,
       {O.r('CASE WHEN count(*) >= 3 THEN regr_slope(weight_kg, idx) END', 4)} AS slope
FROM nn GROUP BY subject_id""")
def q_index_slope(spark, d):
    """ST2 + W8: per-subject slope of the daily weight on the 0-based index of
    its valid measurements (NULL below three points)."""
    return finalize(panel.index_slope(B.measures_wide(spark, d), "subject_id", "date", "weight_kg"), {"slope": 4})


from paneldeck.plans import extras  # noqa: E402,F401  (registers its queries)
