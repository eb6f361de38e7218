"""Regression operators over Spark aggregates (ST1-ST6, ST8, ST11, ST13).

No per-row Python and no per-group pandas: every statistic comes from one or
two partial-aggregated passes; the driver solves at most a (k+1)x(k+1) system.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneldeck.functions.dist import norm_two_sided_p, t_two_sided_p
from paneldeck.operators import moments as M
from paneldeck.operators.assemble import complete_cases

Z975 = 1.959963984540054  # fixed value: standard normal 97.5% quantile

COEF_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("term", T.StringType()),
    T.StructField("coef", T.DoubleType()), T.StructField("se", T.DoubleType()),
    T.StructField("stat", T.DoubleType()), T.StructField("p_value", T.DoubleType()),
    T.StructField("ci_lower", T.DoubleType()), T.StructField("ci_upper", T.DoubleType()),
])
FIT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


@dataclass
class ModelResult:
    """Flattened model output: one coefficient row per term + fit metrics."""
    model: str
    status: str
    terms: list[str] = field(default_factory=list)
    coef: np.ndarray | None = None
    se: np.ndarray | None = None
    stat: np.ndarray | None = None
    p: np.ndarray | None = None
    ci: tuple[np.ndarray, np.ndarray] | None = None
    fit: dict[str, float] = field(default_factory=dict)

    def coefficient_rows(self):
        if self.coef is None:
            return []
        out = []
        for i, t in enumerate(self.terms):
            f = lambda a: None if a is None or not np.isfinite(a[i]) else float(a[i])
            lo = f(self.ci[0]) if self.ci else None
            hi = f(self.ci[1]) if self.ci else None
            out.append((self.model, t, f(self.coef), f(self.se), f(self.stat), f(self.p), lo, hi))
        return out

    def coefficients(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.coefficient_rows(), COEF_SCHEMA)

    def model_fit(self, spark: SparkSession) -> DataFrame:
        rows = [(self.model, k, None if v is None or not np.isfinite(v) else float(v)) for k, v in self.fit.items()]
        return spark.createDataFrame(rows, FIT_SCHEMA)


def _solve(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares solution and (pseudo-)inverse of the normal matrix."""
    inv = np.linalg.pinv(a)
    beta = np.linalg.lstsq(a, b, rcond=None)[0]
    return beta, inv


def ols(df: DataFrame, y: str, xs: list[str], model: str = "ols") -> ModelResult:
    """ST3: pooled OLS with intercept: coef, classical se, t, p, R², mse, df."""
    with M.pinned(complete_cases(df.select(y, *xs), [y, *xs])) as data:
        cols = [*xs, y]
        n, means = M.global_means(data, cols)
        k = len(xs)
        if n == 0:
            return ModelResult(model, "no_data", fit={"observations": 0.0})
        m = M.centred_cross(data, cols, means)
    sxx, sxy, syy = m[:k, :k], m[:k, k], m[k, k]
    beta, inv = _solve(sxx, sxy)
    mx, my = means[:k], means[k]
    b0 = my - mx @ beta
    rss = max(syy - 2 * beta @ sxy + beta @ sxx @ beta, 0.0)
    dfr = n - (k + 1)
    mse = rss / dfr if dfr > 0 else np.nan
    var_b = mse * np.diag(inv)
    var_0 = mse * (1.0 / n + mx @ inv @ mx)
    coef = np.concatenate([[b0], beta])
    se = np.sqrt(np.concatenate([[var_0], var_b]))
    with np.errstate(divide="ignore", invalid="ignore"):
        t = coef / se
    p = t_two_sided_p(t, np.full_like(t, dfr, dtype=float))
    r2 = 1 - rss / syy if syy > 0 else np.nan
    return ModelResult(model, "success", ["intercept", *xs], coef, se, t, p, None,
                       {"observations": float(n), "r_squared": r2, "mse": mse, "df_resid": float(dfr)})


def fe_within(df: DataFrame, y: str, xs: list[str], group: str, dof: str = "naive",
              model: str = "fe") -> ModelResult:
    """ST5: pooled within-subject (fixed-effects) OLS without intercept.

    ``dof='naive'`` keeps the reference's n − k (Q6); ``dof='within'`` also
    subtracts the absorbed subject means (n − k − G)."""
    with M.pinned(complete_cases(df.select(group, y, *xs), [group, y, *xs])) as data:
        cols = [*xs, y]
        n, means = M.global_means(data, cols)
        k = len(xs)
        if n == 0:
            return ModelResult(model, "no_data", fit={"observations": 0.0})
        w, n, g = M.within_cross(data, group, cols, means)
    wxx, wxy, wyy = w[:k, :k], w[:k, k], w[k, k]
    beta, inv = _solve(wxx, wxy)
    rss = max(wyy - 2 * beta @ wxy + beta @ wxx @ beta, 0.0)
    dfr = n - k if dof == "naive" else n - k - g
    mse = rss / dfr if dfr > 0 else np.nan
    se = np.sqrt(mse * np.diag(inv))
    with np.errstate(divide="ignore", invalid="ignore"):
        t = beta / se
    p = t_two_sided_p(t, np.full_like(t, dfr, dtype=float))
    r2 = 1 - rss / wyy if wyy > 0 else np.nan
    return ModelResult(model, "success", list(xs), beta, se, t, p, None,
                       {"observations": float(n), "r_squared_within": r2, "mse": mse, "df_resid": float(dfr),
                        "n_subjects": float(g)})


def cluster_ols(df: DataFrame, y: str, xs: list[str], group: str, model: str = "ols_cluster") -> ModelResult:
    """ST4: OLS with subject dummies and cluster-robust (by subject) covariance.

    Frisch–Waugh: the slope block equals the within regression; the cluster
    score of subject g is s_g = W_xy,g − W_xx,g β, all from per-subject
    moments; V = G/(G−1)·(N−1)/(N−K)·B (Σ s_g s_gᵀ) B with K = k + G;
    normal-based inference as in the reference's robust fit."""
    with M.pinned(complete_cases(df.select(group, y, *xs), [group, y, *xs])) as data:
        cols = [*xs, y]
        n, means = M.global_means(data, cols)
        k = len(xs)
        if n == 0:
            return ModelResult(model, "no_data", fit={"observations": 0.0})
        # per-subject moments: the only input of the remaining two passes
        gm = M.group_moment_table(data, group, cols, means).persist()
        gm.count()
    try:
        wexpr = M.within_expr(k + 1)
        aggs = [F.sum(wexpr[(i, j)]).alias(f"w{i}_{j}") for i in range(k + 1) for j in range(i, k + 1)]
        aggs += [F.sum("_ng").alias("_n"), F.count(F.lit(1)).alias("_g")]
        aggs += [F.sum(F.col(f"q{k}_{k}")).alias("_syy"), F.sum(F.col(f"s{k}")).alias("_sy")]
        row = gm.agg(*aggs).first()
        w = np.zeros((k + 1, k + 1))
        for i in range(k + 1):
            for j in range(i, k + 1):
                w[i, j] = w[j, i] = row[f"w{i}_{j}"] or 0.0
        n, g = int(row["_n"]), int(row["_g"])
        wxx, wxy, wyy = w[:k, :k], w[:k, k], w[k, k]
        beta, inv = _solve(wxx, wxy)
        # per-group score s_g (k columns) -> meat = Σ s_g s_gᵀ, one more aggregate
        s = []
        for i in range(k):
            e = wexpr[(i, k)]
            for j in range(k):
                e = e - wexpr[(min(i, j), max(i, j))] * F.lit(float(beta[j]))
            s.append(e)
        meat_row = gm.agg(*[F.sum(s[i] * s[j]).alias(f"m{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    finally:
        gm.unpersist()
    meat = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            meat[i, j] = meat[j, i] = meat_row[f"m{i}_{j}"] or 0.0
    kk = k + g
    c = (g / (g - 1.0)) * ((n - 1.0) / (n - kk)) if g > 1 and n > kk else np.nan
    cov = c * inv @ meat @ inv
    se = np.sqrt(np.diag(cov))
    with np.errstate(divide="ignore", invalid="ignore"):
        z = beta / se
    p = norm_two_sided_p(z)
    rss = max(wyy - 2 * beta @ wxy + beta @ wxx @ beta, 0.0)
    tss = (row["_syy"] or 0.0) - (row["_sy"] or 0.0) ** 2 / n
    r2 = 1 - rss / tss if tss > 0 else np.nan
    return ModelResult(model, "success", list(xs), beta, se, z, p, (beta - Z975 * se, beta + Z975 * se),
                       {"observations": float(n), "r_squared": r2, "n_clusters": float(g)})


def within_slopes(df: DataFrame, y: str, x1: str, x2: str, group: str, min_obs: int = 3) -> DataFrame:
    """ST6: per-subject demeaned two-predictor OLS without intercept (Cramer's
    rule on per-subject moments); returns one row per subject with ≥ min_obs
    complete rows and its coefficients."""
    data = complete_cases(df.select(group, y, x1, x2), [group, y, x1, x2])
    cols = [x1, x2, y]
    _, means = M.global_means(data, cols)
    g = M.group_moment_table(data, group, cols, means).filter(F.col("_ng") >= min_obs)
    w = M.within_expr(3)
    det = w[(0, 0)] * w[(1, 1)] - w[(0, 1)] * w[(0, 1)]
    tr = w[(0, 0)] + w[(1, 1)]
    # rank-deficient systems take the minimum-norm (pseudo-inverse) solution,
    # as the reference's least-squares fit does: W⁺ = W / tr(W)² for rank 1
    full = F.abs(det) > F.lit(1e-9) * tr * tr
    b1 = (F.when(full, (w[(1, 1)] * w[(0, 2)] - w[(0, 1)] * w[(1, 2)]) / det)
          .when(tr == 0, F.lit(0.0))
          .otherwise((w[(0, 0)] * w[(0, 2)] + w[(0, 1)] * w[(1, 2)]) / (tr * tr)))
    b2 = (F.when(full, (w[(0, 0)] * w[(1, 2)] - w[(0, 1)] * w[(0, 2)]) / det)
          .when(tr == 0, F.lit(0.0))
          .otherwise((w[(0, 1)] * w[(0, 2)] + w[(1, 1)] * w[(1, 2)]) / (tr * tr)))
    return g.select(group, F.col("_ng").alias("n_obs"), b1.alias("coef_x1"), b2.alias("coef_x2"))


def summarize_within(slopes: DataFrame) -> DataFrame:
    """ST6 summary: mean, population std and count of the per-subject coefficients."""
    return slopes.agg(F.avg("coef_x1").alias("within_subject_mean"),
                      F.stddev_pop("coef_x1").alias("within_subject_std"),
                      F.count("coef_x1").alias("within_subject_n"))


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """ST8: Pearson r (R7-safe: NULL for a constant column), t and df; one row."""
    d = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    g = d.agg(F.count(F.lit(1)).alias("n"), F.covar_pop("x", "y").alias("cxy"),
              F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"))
    r = F.try_divide(F.col("cxy"), F.sqrt(F.col("vx") * F.col("vy")))
    out = g.select("n", r.alias("r"))
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r")))
    return out.withColumn("t_stat", t)


def trend_grid(df: DataFrame, group: str | None, x: str, y: str, points: int = 100,
               level: float = 0.95) -> DataFrame:
    """ST11: fitted line and mean-confidence band on an evenly spaced grid of
    ``points`` x values between the group's min and max x."""
    from paneldeck.functions.dist import t_quantile_col
    d = df.select(*([group] if group else []), F.col(x).cast("double").alias("x"),
                  F.col(y).cast("double").alias("y")).dropna()
    keys = [group] if group else []
    g = (d.groupBy(*keys) if keys else d.groupBy()).agg(
        F.regr_count("y", "x").alias("n"), F.regr_slope("y", "x").alias("b"), F.regr_intercept("y", "x").alias("a"),
        F.regr_sxx("y", "x").alias("sxx"), F.regr_syy("y", "x").alias("syy"), F.regr_sxy("y", "x").alias("sxy"),
        F.min("x").alias("x_min"), F.max("x").alias("x_max"), F.avg("x").alias("x_bar"))
    g = g.filter(F.col("b").isNotNull())
    s = F.sqrt(F.try_divide(F.greatest(F.lit(0.0), F.col("syy") - F.col("b") * F.col("sxy")), F.col("n") - 2))
    grid = g.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    gx = F.col("x_min") + (F.col("x_max") - F.col("x_min")) * F.col("i") / F.lit(points - 1)
    grid = grid.withColumn("x", gx).withColumn("yhat", F.col("a") + F.col("b") * F.col("x"))
    grid = grid.withColumn("se_mean", s * F.sqrt(1 / F.col("n") + F.try_divide((F.col("x") - F.col("x_bar")) ** 2, F.col("sxx"))))
    tq = t_quantile_col(0.5 + level / 2, F.col("n") - 2)
    grid = grid.withColumn("_t", F.when(F.col("n") > 2, tq))
    return grid.select(*keys, "i", "x", "yhat", "se_mean",
                       (F.col("yhat") - F.col("_t") * F.col("se_mean")).alias("lower"),
                       (F.col("yhat") + F.col("_t") * F.col("se_mean")).alias("upper"))


def group_slopes(df: DataFrame, group: str, x: str, y: str, min_points: int = 2) -> DataFrame:
    """ST1: per-group simple regression y ~ a + b x from one partial-aggregated
    ``groupBy`` (regr_* sums).  slope_se is NULL when n <= 2."""
    xx = F.col(x).cast("double")
    yy = F.col(y).cast("double")
    g = df.groupBy(group).agg(
        F.regr_count(yy, xx).alias("n_points"),
        F.regr_slope(yy, xx).alias("_b"),
        F.regr_intercept(yy, xx).alias("_a"),
        F.regr_sxx(yy, xx).alias("_sxx"),
        F.regr_syy(yy, xx).alias("_syy"),
        F.regr_sxy(yy, xx).alias("_sxy"),
    )
    n = F.col("n_points")
    return g.select(
        group, n.alias("n_points"),
        F.when(n >= min_points, F.col("_b")).alias("slope"),
        F.when(n >= min_points, F.col("_a")).alias("intercept"),
        F.when(n > 2, F.sqrt(F.greatest(F.lit(0.0), F.col("_syy") - F.col("_b") * F.col("_sxy")) / (n - 2) / F.col("_sxx")))
        .alias("slope_se"),
        F.col("_sxx").alias("sxx"),
    )
