"""Run metrics over a step log ``steps(run_id, step, started_at, seconds,
status, rows_out)`` (A23, M2-M4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def step_stats(steps: DataFrame) -> DataFrame:
    """M3: per step runs, successes, failures, success rate, mean and exact
    p95 duration, rows written; M4: hours between the latest logged step and
    the step's latest success (freshness, independent of wall-clock time)."""
    latest = steps.agg(F.max("started_at").alias("_latest")).first()["_latest"]
    ok = F.col("status") == "success"
    g = steps.groupBy("step").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count(F.when(ok, 1)).alias("n_success"),
        F.count(F.when(~ok, 1)).alias("n_failed"),
        F.avg(ok.cast("double")).alias("success_rate"),
        F.avg("seconds").alias("mean_seconds"),
        F.coalesce(F.sum("rows_out"), F.lit(0)).cast("bigint").alias("rows_out"),
        F.max(F.when(ok, F.col("started_at"))).alias("last_success"))
    # difference of two wall-clock instants; works for TIMESTAMP and TIMESTAMP_NTZ
    latest_col = F.lit(latest).cast(dict(steps.dtypes)["started_at"])
    hours = F.timestamp_diff("MICROSECOND", F.col("last_success"), latest_col) / F.lit(3.6e9)
    from paneldeck.operators.quantiles import exact_quantiles_by
    p95 = exact_quantiles_by(steps, ["step"], "seconds", [0.95]).select("step", F.col("quantile").alias("p95_seconds"))
    return g.withColumn("freshness_hours", hours).join(p95, "step", "left")


def run_rollup(steps: DataFrame) -> DataFrame:
    """Runs, successful step records and total rows written."""
    return steps.agg(F.countDistinct("run_id").alias("runs"),
                     F.count(F.when(F.col("status") == "success", 1)).alias("successes"),
                     F.coalesce(F.sum("rows_out"), F.lit(0)).cast("bigint").alias("total_rows"))


def panel_stats(df: DataFrame, subject: str = "subject_id", week: str | None = "week") -> DataFrame:
    """M2 + A12 + O2: rows, distinct subjects and distinct weeks of a table,
    in one aggregate."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.countDistinct(subject).alias("n_subjects")]
    if week:
        aggs.append(F.countDistinct(week).alias("n_weeks"))
    return df.agg(*aggs)


def observed(df: DataFrame, name: str, subject: str = "subject_id") -> tuple[DataFrame, Observation]:
    """M2 at no extra pass: attach row / distinct-approximate counters that are
    filled in when the pipeline's own action runs (``df.observe``)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"),
                      F.approx_count_distinct(subject).alias("subjects_approx")), obs
