"""Rollups (A1-A3, A7, P13, P14).

All rollups are plain ``groupBy().agg()``: Spark runs a partial aggregate on
the map side, so a hot subject costs one row per map task after the combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneldeck.functions.clean import safe_div, week_index


def zsum(c):
    """R2: pandas sums an all-missing group to 0; Spark gives NULL."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def daily_rollup(rows: DataFrame, nutrients: dict[str, str], subject: str = "subject_id",
                 date: str = "date", count_name: str = "n_entries") -> DataFrame:
    """A1: one row per (subject, date): sum of every nutrient + entry count.

    ``nutrients`` maps input column -> output column (``fiber_g`` -> ``fiber_g_total``).
    Rows with a NULL date or subject are dropped (pandas drops NULL group keys, R3).
    """
    aggs = [zsum(F.col(src)).alias(dst) for src, dst in nutrients.items()]
    aggs.append(F.count(F.lit(1)).alias(count_name))
    return (rows.filter(F.col(date).isNotNull() & F.col(subject).isNotNull())
            .groupBy(subject, date).agg(*aggs))


def add_week_index(df: DataFrame, subject: str = "subject_id", date: str = "date",
                   out: str = "week_index", one_based: bool = False, origin: DataFrame | None = None) -> DataFrame:
    """P5: week number since the subject's origin.

    Without ``origin`` the origin is the subject's first date in ``df`` (a window
    minimum, which reuses the hash(subject) partitioning of the caller).  With an
    ``origin`` table ``(subject, origin_date)`` the week is aligned to an
    external calendar (fix for Q7); that table has one row per subject.
    """
    if origin is None:
        from pyspark.sql import Window
        o = F.min(date).over(Window.partitionBy(subject))
        return df.withColumn(out, week_index(F.col(date), o, one_based))
    return (df.join(origin, subject, "left")
            .withColumn(out, week_index(F.col(date), F.col("origin_date"), one_based))
            .drop("origin_date"))


def subject_origin(df: DataFrame, subject: str = "subject_id", date: str = "date") -> DataFrame:
    """First date per subject: the week origin table of P5 / A11."""
    return df.groupBy(subject).agg(F.min(date).alias("origin_date"))


def weekly_rollup_long(daily: DataFrame, nutrient_cols: list[str], flag_cols: list[str],
                       subject: str = "subject_id", week: str = "week_index",
                       count_col: str | None = "n_entries") -> DataFrame:
    """A2: weekly means and sums of the daily nutrients, summed entry counts,
    share-of-days (mean) and any-day (max) of the daily keyword flags.

    Only columns present in ``daily`` are aggregated, as in the reference.
    """
    have = set(daily.columns)
    aggs = []
    for c in nutrient_cols:
        if c in have:
            aggs += [F.avg(c).alias(f"{c}_week_mean"), zsum(F.col(c)).alias(f"{c}_week_sum")]
    if count_col and count_col in have:
        aggs.append(F.coalesce(F.sum(count_col), F.lit(0)).cast("bigint").alias(f"{count_col}_week_sum"))
    for c in flag_cols:
        if c in have:
            aggs += [F.avg(c).alias(f"share_of_days_{c}"), F.max(c).cast("int").alias(f"any_{c}")]
    return daily.filter(F.col(week).isNotNull()).groupBy(subject, week).agg(*aggs)


def weekly_rollup_wide(daily: DataFrame, subject: str = "subject_id", week: str = "week",
                       calories: str = "total_calories", fiber: str = "total_fiber_g") -> DataFrame:
    """A3 + P14 + P7: weekly mean, sum, sample std and non-null count of calories
    and fiber, their weekly aliases and fiber per 1000 kcal (x/0 -> NULL)."""
    g = daily.filter(F.col(week).isNotNull()).groupBy(subject, week).agg(
        F.avg(calories).alias("calories_mean"),
        zsum(F.col(calories)).alias("calories_sum"),
        F.stddev_samp(calories).alias("calories_std"),
        F.count(calories).alias("calories_days"),
        F.avg(fiber).alias("fiber_g_mean"),
        zsum(F.col(fiber)).alias("fiber_g_sum"),
        F.stddev_samp(fiber).alias("fiber_g_std"),
        F.count(fiber).alias("fiber_days"),
    )
    return g.withColumns({
        "calories_week": F.col("calories_sum"),
        "fiber_g_week": F.col("fiber_g_sum"),
        "calories_day_avg": F.col("calories_mean"),
        "fiber_g_day_avg": F.col("fiber_g_mean"),
        "fiber_per_1000_cal": safe_div(F.col("fiber_g_sum"), F.col("calories_sum")) * 1000,
    })


def reject_reason(required: list[str]):
    """null_<column> for the first required column that is NULL, else NULL."""
    reason = F.lit(None).cast("string")
    for c in reversed(required):
        reason = F.when(F.col(c).isNull(), F.lit(f"null_{c}")).otherwise(reason)
    return reason


def split_rejects(rows: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Q8: rows with a NULL in a required key (e.g. an unparseable date) go to
    a reject table with the reason instead of failing the run."""
    reason = reject_reason(required)
    return rows.filter(reason.isNull()), rows.filter(reason.isNotNull()).withColumn("reject_reason", reason)
