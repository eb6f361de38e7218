"""Statistical operators against brute-force numpy on small random panels."""
import itertools
import math

import numpy as np
import pandas as pd
import pytest

from paneldeck.functions.dist import norm_two_sided_p, t_ppf, t_two_sided_p
from paneldeck.operators import mixed, ranks, regress


def _panel(seed=0, groups=12, per=(3, 9), k=2, ties=False):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        n = int(rng.integers(*per))
        u = rng.normal(0, 1.5)
        for _ in range(n):
            x = rng.normal(size=k) * np.array([10.0, 1.0, 0.5][:k]) + np.array([50.0, 3.0, 0.0][:k])
            if ties:
                x = np.round(x)
            y = 2 + x @ np.array([0.3, -1.2, 0.7][:k]) + u + rng.normal()
            if ties:
                y = round(y)
            rows.append((g, *[float(v) for v in x], float(y)))
    cols = ["g"] + [f"x{i}" for i in range(k)] + ["y"]
    return pd.DataFrame(rows, columns=cols)


def test_golden_p_values():
    vec = [(-0.15350984965712958, 431, 0.878068070532471), (-2.2128477563026254, 431, 0.027431464037190656),
           (2.024730172384278, 431, 0.043511153110595835), (-2.3536459455189407, 432, 0.01903745882514629),
           (1.542598259740182, 432, 0.12366045499530043)]
    for t, df, p in vec:
        assert t_two_sided_p(t, df) == pytest.approx(p, abs=1e-12)
    assert float(t_ppf(0.975, 10)) == pytest.approx(2.2281388519649385, abs=1e-10)
    assert float(norm_two_sided_p(1.959963984540054)) == pytest.approx(0.05, abs=1e-12)


def test_ols_matches_lstsq(spark):
    pdf = _panel(1)
    df = spark.createDataFrame(pdf)
    res = regress.ols(df, "y", ["x0", "x1"])
    X = np.column_stack([np.ones(len(pdf)), pdf[["x0", "x1"]].to_numpy()])
    y = pdf["y"].to_numpy()
    beta = np.linalg.lstsq(X, y, rcond=None)[0]
    resid = y - X @ beta
    dfr = len(y) - 3
    se = np.sqrt(np.diag(resid @ resid / dfr * np.linalg.inv(X.T @ X)))
    assert np.allclose(res.coef, beta) and np.allclose(res.se, se)
    assert np.allclose(res.p, t_two_sided_p(beta / se, dfr))
    assert res.fit["r_squared"] == pytest.approx(1 - resid @ resid / ((y - y.mean()) ** 2).sum())


def _demean(pdf, cols):
    return pdf[cols] - pdf.groupby("g")[cols].transform("mean")


def test_fe_within_matches_demeaned_lstsq(spark):
    pdf = _panel(2)
    res = regress.fe_within(spark.createDataFrame(pdf), "y", ["x0", "x1"], "g")
    d = _demean(pdf, ["x0", "x1", "y"])
    X, y = d[["x0", "x1"]].to_numpy(), d["y"].to_numpy()
    beta = np.linalg.lstsq(X, y, rcond=None)[0]
    resid = y - X @ beta
    se = np.sqrt(np.diag(resid @ resid / (len(y) - 2) * np.linalg.inv(X.T @ X)))
    assert np.allclose(res.coef, beta) and np.allclose(res.se, se)
    res_w = regress.fe_within(spark.createDataFrame(pdf), "y", ["x0", "x1"], "g", dof="within")
    assert res_w.fit["df_resid"] == len(y) - 2 - pdf["g"].nunique()


def test_cluster_sandwich_matches_dummy_regression(spark):
    pdf = _panel(3)
    res = regress.cluster_ols(spark.createDataFrame(pdf), "y", ["x0", "x1"], "g")
    groups = sorted(pdf["g"].unique())
    D = np.column_stack([(pdf["g"] == g).astype(float) for g in groups])
    X = np.column_stack([pdf[["x0", "x1"]].to_numpy(), D])
    y = pdf["y"].to_numpy()
    beta = np.linalg.lstsq(X, y, rcond=None)[0]
    u = y - X @ beta
    bread = np.linalg.pinv(X.T @ X)
    meat = np.zeros((X.shape[1], X.shape[1]))
    for g in groups:
        m = (pdf["g"] == g).to_numpy()
        s = X[m].T @ u[m]
        meat += np.outer(s, s)
    n, G, K = len(y), len(groups), X.shape[1]
    cov = G / (G - 1) * (n - 1) / (n - K) * bread @ meat @ bread
    assert np.allclose(res.coef, beta[:2])
    assert np.allclose(res.se, np.sqrt(np.diag(cov))[:2])
    assert res.fit["r_squared"] == pytest.approx(1 - u @ u / ((y - y.mean()) ** 2).sum())


def test_within_slopes_per_subject(spark):
    pdf = _panel(4, groups=8)
    out = {r["g"]: r["coef_x1"] for r in
           regress.within_slopes(spark.createDataFrame(pdf), "y", "x0", "x1", "g").collect()}
    for g, grp in pdf.groupby("g"):
        d = grp[["x0", "x1", "y"]] - grp[["x0", "x1", "y"]].mean()
        b = np.linalg.lstsq(d[["x0", "x1"]].to_numpy(), d["y"].to_numpy(), rcond=None)[0]
        assert out[g] == pytest.approx(b[0], rel=1e-8)


def test_within_slopes_degenerate_is_min_norm(spark):
    pdf = pd.DataFrame({"g": [0, 0, 0], "x0": [1.0, 1.0, 1.0], "x1": [2.0, 2.0, 2.0], "y": [1.0, 2.0, 3.0]})
    r = regress.within_slopes(spark.createDataFrame(pdf), "y", "x0", "x1", "g").first()
    assert r["coef_x1"] == 0.0 and r["coef_x2"] == 0.0


def test_spearman_and_pearson(spark):
    pdf = _panel(5, ties=True)
    df = spark.createDataFrame(pdf)
    r = ranks.spearman(df, "x0", "y", buckets=4).first()
    rho = pdf["x0"].rank().corr(pdf["y"].rank())
    assert r["rho"] == pytest.approx(rho, rel=1e-10) and r["n"] == len(pdf)
    p = regress.pearson(df, "x0", "y").first()
    assert p["r"] == pytest.approx(pdf["x0"].corr(pdf["y"]), rel=1e-10)
    const = spark.createDataFrame(pd.DataFrame({"a": [1.0] * 12, "b": list(map(float, range(12)))}))
    assert regress.pearson(const, "a", "b").first()["r"] is None


def test_average_ranks_match_pandas(spark):
    vals = [3.0, 1.0, 3.0, 2.0, 3.0, 5.0, 1.0, 4.0, 4.0, 9.0, 0.5]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, v double")
    got = {r["i"]: r["rank"] for r in ranks.average_ranks(df, "v", buckets=3).collect()}
    exp = pd.Series(vals).rank().to_dict()
    assert all(got[i] == pytest.approx(exp[i]) for i in exp)


def _mw_brute(a, b):
    n1, n2 = len(a), len(b)
    allv = pd.Series(list(a) + list(b))
    rk = allv.rank().to_numpy()
    u1 = rk[:n1].sum() - n1 * (n1 + 1) / 2
    counts = allv.value_counts().to_numpy()
    tie = float((counts ** 3 - counts).sum())
    return u1, tie


def test_mann_whitney_statistic(spark):
    pdf = _panel(6, ties=True)
    pdf["f"] = (pdf["x1"] > pdf["x1"].median()).astype(int)
    r = ranks.mann_whitney(spark.createDataFrame(pdf), "y", "f", buckets=3).first()
    a, b = pdf.loc[pdf.f == 1, "y"], pdf.loc[pdf.f == 0, "y"]
    u1, tie = _mw_brute(a, b)
    assert r["u_stat"] == pytest.approx(u1) and r["tie_term"] == pytest.approx(tie)
    assert r["median_1"] == pytest.approx(a.median()) and r["n1"] == len(a)


def test_mann_whitney_exact_p():
    a, b = [1.1, 2.3, 3.9], [4.2, 5.0, 6.1, 0.2]
    u1, _ = _mw_brute(a, b)
    # brute force over all splits of the 7 ranks
    ranks_all = list(range(1, 8))
    us = [sum(c) - 6 for c in itertools.combinations(ranks_all, 3)]
    big = max(u1, 12 - u1)
    p = min(1.0, 2 * sum(u >= big for u in us) / len(us))
    assert ranks.mann_whitney_p(3, 4, u1, 0.0) == pytest.approx(p)


def _mixed_brute(pdf, xs, reml):
    """Direct random-intercept likelihood with explicit per-group V matrices."""
    y = pdf["y"].to_numpy()
    X = np.column_stack([np.ones(len(pdf)), pdf[xs].to_numpy()])
    groups = [np.where(pdf["g"].to_numpy() == g)[0] for g in sorted(pdf["g"].unique())]
    n, p = X.shape

    def prof(theta):
        xvx = np.zeros((p, p)); xvy = np.zeros(p); logdet = 0.0
        vinv = []
        for idx in groups:
            V = np.eye(len(idx)) + theta * np.ones((len(idx), len(idx)))
            Vi = np.linalg.inv(V); vinv.append(Vi)
            xvx += X[idx].T @ Vi @ X[idx]; xvy += X[idx].T @ Vi @ y[idx]
            logdet += np.linalg.slogdet(V)[1]
        beta = np.linalg.solve(xvx, xvy)
        qf = sum((y[i] - X[i] @ beta) @ Vi @ (y[i] - X[i] @ beta) for i, Vi in zip(groups, vinv))
        m = n - p if reml else n
        ll = -0.5 * (m * math.log(2 * math.pi) + m * math.log(qf / m) + m + logdet)
        if reml:
            ll -= 0.5 * np.linalg.slogdet(xvx)[1]
        return ll, beta, qf / m, xvx

    grid = np.exp(np.linspace(-10, 5, 3001))
    best = max(grid, key=lambda t: prof(t)[0])
    return best, prof(best)


@pytest.mark.parametrize("reml", [False, True])
def test_mixed_model_matches_direct_likelihood(spark, reml):
    pdf = _panel(7, groups=10)
    res = mixed.random_intercept(spark.createDataFrame(pdf), "y", ["x0", "x1"], "g", reml=reml)
    theta, (ll, beta, scale, xvx) = _mixed_brute(pdf, ["x0", "x1"], reml)
    assert res.fit["log_likelihood"] >= ll - 1e-6  # optimiser at least as good as the grid
    assert res.fit["log_likelihood"] == pytest.approx(ll, abs=1e-3)
    assert np.allclose(res.coef, beta, rtol=1e-3, atol=1e-3)
    assert np.allclose(res.se, np.sqrt(np.diag(scale * np.linalg.inv(xvx))), rtol=1e-2)


def test_t_quantile_column_matches_numpy(spark):
    from pyspark.sql import functions as F
    from paneldeck.functions.dist import t_quantile_col
    dfs = [1, 2, 3, 10, 431, 1000, 1001, 2500, 100000]
    df = spark.createDataFrame([(d,) for d in dfs], "n long")
    got = [r["q"] for r in df.select(t_quantile_col(0.975, F.col("n")).alias("q")).collect()]
    exp = t_ppf(0.975, np.array(dfs, float))
    assert np.allclose(got, exp, rtol=1e-9, atol=1e-10)
    assert df.select(t_quantile_col(0.975, F.lit(0)).alias("q")).first()["q"] is None


def test_exact_quantiles_match_pandas(spark):
    from paneldeck.operators.quantiles import exact_quantiles, exact_quantiles_by
    rng = np.random.default_rng(11)
    # group 0 holds most rows (a hot group), values with many ties
    g = np.where(rng.random(3000) < 0.7, 0, rng.integers(1, 4, 3000))
    v = np.round(rng.normal(size=3000), 1)
    pdf = pd.DataFrame({"g": g.astype(int), "v": v})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    glob = exact_quantiles(df, "v", probs, buckets=5)
    for q in probs:
        assert glob[q] == pytest.approx(pdf["v"].quantile(q))
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles_by(df, ["g"], "v", probs, buckets=5).collect()}
    for (grp, q), val in got.items():
        assert val == pytest.approx(pdf[pdf.g == grp]["v"].quantile(q))
    assert len(got) == 4 * len(probs)


def test_mann_whitney_many_equals_single(spark):
    pdf = _panel(8, ties=True)
    pdf["a"] = (pdf["x0"] > pdf["x0"].median()).astype(int)
    pdf["b"] = (pdf["x1"] > pdf["x1"].median()).astype(int)
    df = spark.createDataFrame(pdf)
    many = {r["flag"]: r for r in ranks.mann_whitney_many(df, "y", ["a", "b"], buckets=3).collect()}
    for f in ("a", "b"):
        one = ranks.mann_whitney(df, "y", f).first()
        for k in ("n1", "n0", "median_1", "median_0", "u_stat", "tie_term"):
            assert many[f][k] == pytest.approx(one[k])


def test_ungrouped_paths_have_no_cross_join(spark):
    from paneldeck.operators.quantiles import exact_quantiles_by
    from paneldeck.operators.ranks import grouped_below
    df = spark.createDataFrame([(float(i % 7),) for i in range(50)], "v double")
    q = exact_quantiles_by(df, [], "v", [0.5])
    assert q.first()["quantile"] == pytest.approx(pd.Series([float(i % 7) for i in range(50)]).median())
    vc = df.groupBy("v").count().withColumnRenamed("count", "cnt")
    plan = grouped_below(vc, [], "v", buckets=3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
