"""Algebraic identities and edge frames."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paneldeck.operators import mixed, ranks, regress, rollup
from paneldeck.operators.quantiles import exact_quantiles
from paneldeck.plans import bindings as B
from paneldeck.plans import panels as P

SMALL = "/root/testdata/sf0.001"


def test_spearman_invariant_to_monotone_maps(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"x": rng.normal(size=200), "y": rng.normal(size=200)})
    pdf["y"] = pdf["y"] + 0.5 * pdf["x"]
    df = spark.createDataFrame(pdf)
    r1 = ranks.spearman(df, "x", "y", buckets=3).first()["rho"]
    mapped = df.select(F.exp("x").alias("x"), (F.col("y") * 3 + 7).alias("y"))
    r2 = ranks.spearman(mapped, "x", "y", buckets=5).first()["rho"]
    assert r1 == pytest.approx(r2, abs=1e-12)


def test_mann_whitney_u_identity(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"v": rng.integers(0, 20, 300).astype(float), "f": rng.integers(0, 2, 300)})
    df = spark.createDataFrame(pdf)
    a = ranks.mann_whitney(df, "v", "f").first()
    flipped = df.withColumn("f", 1 - F.col("f"))
    b = ranks.mann_whitney(flipped, "v", "f").first()
    assert a["u_stat"] + b["u_stat"] == pytest.approx(a["n1"] * a["n0"])


def test_weekly_sums_equal_daily_sums(spark):
    daily = P.daily_flags(spark, SMALL)
    weekly = P.weekly_long(spark, SMALL, daily)
    d = daily.agg(*[F.sum(c).alias(c) for c in B.DAILY_NUTRIENTS], F.sum("n_entries").alias("n")).first()
    w = weekly.agg(*[F.sum(f"{c}_week_sum").alias(c) for c in B.DAILY_NUTRIENTS],
                   F.sum("n_entries_week_sum").alias("n")).first()
    for c in B.DAILY_NUTRIENTS:
        assert w[c] == pytest.approx(d[c], rel=1e-12)
    assert w["n"] == d["n"]


def test_edge_frames(spark):
    empty = spark.createDataFrame([], "g long, x double, y double")
    assert regress.ols(empty, "y", ["x"]).status == "no_data"
    assert regress.fe_within(empty, "y", ["x"], "g").status == "no_data"
    assert mixed.random_intercept(empty, "y", ["x"], "g").status == "no_data"
    assert exact_quantiles(empty, "x", [0.5])[0.5] is None
    one = spark.createDataFrame([(1, 2.0, 3.0)], "g long, x double, y double")
    assert ranks.spearman(one, "x", "y").first()["rho"] is None
    nulls = spark.createDataFrame([(1, None, None), (2, None, None)], "g long, x double, y double")
    assert regress.pearson(nulls, "x", "y").first()["n"] == 0
    const = spark.createDataFrame([(i % 3, 5.0, float(i)) for i in range(30)], "g long, x double, y double")
    assert regress.pearson(const, "x", "y").first()["r"] is None  # R7: no divide-by-zero error
    ties = spark.createDataFrame([(i, 1.0) for i in range(10)], "i long, v double")
    assert {r["rank"] for r in ranks.average_ranks(ties, "v").collect()} == {5.5}


def test_daily_rollup_all_missing_sum_is_zero(spark):
    rows = spark.createDataFrame([("S1", "2023-01-01", None), ("S1", "2023-01-01", None), ("S1", None, 3.0)],
                                 "subject_id string, date string, fiber_g double")
    out = rollup.daily_rollup(rows, {"fiber_g": "fiber_g_total"}).collect()
    assert len(out) == 1 and out[0]["fiber_g_total"] == 0.0 and out[0]["n_entries"] == 2  # R2 + NULL date dropped
