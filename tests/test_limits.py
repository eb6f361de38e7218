"""Numeric limits, distribution of hot groups, single scans and stage tables."""

import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneldeck.functions import clean, dist
from paneldeck.operators import mixed, panel, quality, quantiles, ranks
from paneldeck.session import materialized, stage_path

TABLE = "/root/testdata/sf0.001"


# ---- distribution functions -----------------------------------------------------

def test_t_quantile_beyond_a_thousand():
    assert dist.t_ppf(0.9999, 1.0) == pytest.approx(3183.0988, rel=1e-7)
    assert dist.t_ppf(1 - 1e-12, 1.0) == pytest.approx(1 / (math.pi * 1e-12), rel=1e-3)


def test_t_tail_for_huge_degrees_of_freedom():
    # for df = 1e10 the tail is the normal tail up to about 1e-10
    assert dist.t_two_sided_p(2.0, 1e10) == pytest.approx(math.erfc(2 / math.sqrt(2)), rel=1e-8)
    assert dist.t_two_sided_p(1.0, 1.0) == pytest.approx(0.5, rel=1e-13)
    assert np.isnan(dist.t_two_sided_p(1.0, 0.0))


@pytest.mark.parametrize("df", [dist.HILL_FROM * 0.9, dist.HILL_FROM - 1, dist.HILL_FROM * 1.1])
def test_both_tail_methods_agree_around_their_limit(df):
    t = np.array([0.01, 0.5, 1.5, 3.0, 8.0, 20.0, 35.0])
    x = df / (df + t * t)
    fraction = dist._beta_part(np.full(7, df / 2), np.full(7, 0.5), x, t * t / (df + t * t))
    assert np.allclose(fraction, dist._hill_two_sided(t, np.full(7, df)), rtol=1e-11, atol=0)


@pytest.mark.parametrize("q", [0.9, 0.975, 0.999])
def test_quantile_table_and_series_agree(q):
    z, g = dist._norm_ppf(q), dist._cornish_fisher(dist._norm_ppf(q))
    for df in (900, 999, 1000, 1001, 1100):
        series = z + sum(c / df ** (i + 1) for i, c in enumerate(g))
        assert dist.t_ppf(q, float(df)) == pytest.approx(series, abs=2e-12)


def test_dominating_random_intercept(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(200):
        u = rng.normal(0, math.sqrt(83_000))
        rows += [(g, float(x), float(1 + 2 * x + u + e)) for x, e in zip(rng.normal(size=10), rng.normal(size=10))]
    res = mixed.random_intercept(spark.createDataFrame(rows, "g int, x double, y double"), "y", ["x"], "g")
    assert res.fit["converged"] == 1.0
    assert res.fit["scale"] == pytest.approx(1.0, rel=0.1) and res.fit["re_variance"] > 60_000


@pytest.mark.parametrize("n, ratio", [(10**7, 3.0), (10**8, 3.0), (10**9, 1.5), (10**7, 1e6), (10**7, 0.5)])
def test_tiny_random_intercept_of_large_groups(n, ratio):
    # balanced groups have their maximum in closed form: 1 + n * theta = ratio, or theta = 0
    groups = 20
    rows = n * groups
    within = float(rows)
    between = ratio * groups * within / (rows - groups)

    def evaluate(thetas):
        return [(t, -0.5 * (rows * math.log1p(between / (1 + n * t) / within) + groups * math.log1p(n * t)))
                for t in thetas]

    best, converged = mixed._maximise(evaluate)
    assert converged and best[0] == pytest.approx(max(0.0, (ratio - 1) / n), rel=1e-3)


def test_theta_grid_collects_one_row_per_theta(spark):
    sizes = spark.range(1, 5000).select(F.col("id").cast("double").alias("n"), F.lit(1.0).alias("c"), *[
        F.col("id").cast("double").alias(x) for x in ("a0_0", "a0_1", "a1_1", "b0_0", "b0_1", "b1_1")])
    assert len(mixed._sums(sizes, [0.0, 0.5, 2.0], 2)) == 3


def test_exact_rank_test():
    def brute(u, m, n):
        us = [sum(1 for i in c for j in range(m + n) if j not in c and j < i)
              for c in itertools.combinations(range(m + n), m)]
        return sum(x >= u for x in us) / len(us)
    for m, n in ((1, 1), (2, 5), (4, 4), (3, 6)):
        for u in range(m * n + 2):
            assert ranks._exact_sf(u, m, n) == pytest.approx(brute(u, m, n), rel=1e-12)
    assert 0 < ranks._exact_sf(7_000_000, 8, 1_000_000) < 1e-3  # a million against eight is no trouble
    assert ranks.mann_whitney_method(8, 10**9, False) == "asymptotic"
    assert ranks.mann_whitney_method(8, 1000, False) == "exact"


def test_exact_rank_test_at_any_size():
    n = 20_000_000
    assert ranks.mann_whitney_p(1, n, float(n), 0.0) == pytest.approx(2 / (n + 1), rel=1e-12)
    assert ranks.mann_whitney_p(n, 2, 2.0 * n - 1, 0.0) == pytest.approx(4 / math.comb(n + 2, 2), rel=1e-12)
    assert ranks.mann_whitney_method(8, 10**9, False, cells=None) == "exact"
    for m, n in ((7, 8), (8, 8), (8, 50), (5, 3000)):  # the closed form against the table, added up with whole numbers
        f = [1] + [0] * (m * n)
        for i in range(1, m + 1):
            f = [x - (f[k - n - i] if k >= n + i else 0) for k, x in enumerate(f)]
            for k in range(i, len(f)):
                f[k] += f[k - i]
        assert [ranks._tail_count(t, m, n) for t in range(0, m * n + 1, 7)] == list(itertools.accumulate(f))[::7]


# ---- values of the ingest ---------------------------------------------------------

def test_white_space_is_collapsed_before_the_ends_are_cut(spark):
    df = spark.createDataFrame([("\tFoo  bar\n",), (" A b\x1c",), (None,)], "t string")
    assert [r[0] for r in df.select(clean.norm_text("t")).collect()] == ["foo bar", "a b", ""]


def test_common_date_texts(spark):
    texts = ["Jan 5, 2023", "January 5, 2023", "5 Jan 2023", "2023-01-05T10:00:00", "2023-01-05 10:00", "01-05-2023",
             "1/5/23", "1/5/2023", "2023/1/5", "44931", "2023-01-05T10:00:00Z"]
    df = spark.createDataFrame([(t,) for t in texts + ["week 5", "", None, "nan"]], "t string")
    rows = df.select(clean.parse_mixed_date("t").cast("string").alias("d"), clean.date_rejected("t").alias("r")).collect()
    assert [r.d for r in rows] == ["2023-01-05"] * len(texts) + [None] * 4
    assert [r.r for r in rows] == [False] * len(texts) + [True, False, False, False]


# ---- hot groups -------------------------------------------------------------------

@pytest.fixture
def uncoalesced(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


def _most_in_a_task(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def test_one_global_group_is_ranked_in_many_tasks(spark, uncoalesced):
    path = stage_path(spark, "test-values")
    spark.range(200_000).select(F.rand(3).alias("v"), F.lit(1).alias("cnt")).write.parquet(path)
    below = ranks.grouped_below(spark.read.parquet(path), [], "v")
    assert _most_in_a_task(below) < 100_000
    median = quantiles.exact_quantiles(spark.read.parquet(path), "v", [0.5])[0.5]
    assert median == pytest.approx(np.median([r.v for r in spark.read.parquet(path).collect()]), abs=1e-15)


def test_a_hot_subject_is_spread_over_its_segments(spark, uncoalesced):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500 + 2).alias("s"),
        (F.xxhash64("id") % 52).alias("w"), F.col("id").alias("k"), F.rand(1).alias("v")).repartition(8, "s")
    out = panel.segmented_lead(rows, "s", "w", ["k"], "v", "next")
    assert _most_in_a_task(out.where("s = 1")) < 10_000


# ---- scans and stages --------------------------------------------------------------

def test_all_rules_of_a_table_take_one_scan(spark):
    rules = [quality.Rule("not_null", "o_orderkey"), quality.Rule("between", "o_totalprice", min_value=0),
             quality.Rule("row_count_between", min_value=1), quality.Rule("mean_between", "o_totalprice", min_value=0)]
    out = quality.evaluate(spark.read.parquet(f"{TABLE}/orders.parquet"), "orders", rules)
    assert out.count() == 4
    assert len(re.findall("FileScan parquet", out._jdf.queryExecution().executedPlan().toString())) == 1


def test_stage_tables_are_pruned_and_follow_their_input(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(5).select("id", (F.col("id") * 2).alias("x"), F.lit("t").alias("y")).write.parquet(folder + "/t.parquet")
    build = lambda: spark.read.parquet(folder + "/t.parquet")
    first = materialized(spark, ("test_stage", folder), build)
    assert materialized(spark, ("test_stage", folder), build) is first
    plan = first.select("x")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:bigint>" in plan
    spark.range(9).select("id", F.col("id").alias("x"), F.lit("u").alias("y")).write.mode("append").parquet(
        folder + "/t.parquet")
    assert materialized(spark, ("test_stage", folder), build).count() == 14


def test_study_contracts_hold_their_columns_and_types(spark):
    from paneldeck.plans.catalog import _study_tables
    from paneldeck.plans.contracts import STUDY_SUITES
    for table, df in _study_tables(spark, TABLE).items():
        meta = [r for r in STUDY_SUITES[table] if r.kind in quality.META_KINDS]
        assert len(meta) >= 6 and all(row[-1] for row in quality.check_metadata(df, table, meta))


def test_quantiles_read_the_ranked_rows_once(spark, tmp_path):
    import numpy as np
    from paneldeck.operators.quantiles import exact_quantiles_by
    path = str(tmp_path / "values")
    values = [(i % 3, float(i * 7919 % 1013)) for i in range(3_000)] + [(5, 2.0), (6, None)]
    spark.createDataFrame(values, "g long, v double").write.parquet(path)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    made = lambda ps: exact_quantiles_by(spark.read.parquet(path), ["g"], "v", ps)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    one, all_ = plan(made([0.5])), plan(made(probs))
    for node in ("FileScan", "Exchange"):
        assert one.count(node) == all_.count(node)
    got = {(r.g, r.prob): r.quantile for r in made(probs).collect()}
    want = {(g, q): np.quantile([v for h, v in values if h == g], q) for g in (0, 1, 2, 5) for q in probs}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
