"""Panel assembly: joins and post-join rules.

Every join is an equi left-outer join on (subject, date) or (subject, week).
The weekly tables are grouped by (subject, week) downstream of a
hash(subject) exchange, so with
``spark.sql.requireAllClusterKeysForCoPartition=false`` the joins reuse that
partitioning instead of shuffling again; AQE turns a small side into a
broadcast join only after measuring it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def left_join_or_self(left: DataFrame, right: DataFrame | None, on: list[str]) -> DataFrame:
    """With no right side the left table is returned unchanged."""
    if right is None:
        return left
    return left.join(right, on, "left")


def fill_zero(df: DataFrame, cols: list[str], as_int: bool = True) -> DataFrame:
    """NULL -> 0 for flag columns (after a left join)."""
    present = [c for c in cols if c in df.columns]
    out = df.fillna(0, subset=present)
    if as_int:
        out = out.withColumns({c: F.col(c).cast("int") for c in present})
    return out


def prepare_daily(daily: DataFrame, kw_daily: DataFrame | None, flag_cols: list[str],
                  subject: str = "subject_id", date: str = "date") -> DataFrame:
    """J1 + P8: daily totals left-joined with daily keyword flags, missing flags = 0."""
    out = left_join_or_self(daily, kw_daily, [subject, date])
    return fill_zero(out, flag_cols)


def align_long(trajectories: DataFrame, weekly: DataFrame | None, subject: str = "subject_id",
               week: str = "week", weekly_week: str = "week_index", tie: str | None = "tp_index") -> DataFrame:
    """J2 + W4: trajectories left-joined with weekly features on (subject, week),
    then the next observation's baseline delta (lead over the subject's rows
    ordered by week and the tie-break column, computed per week segment so a
    very large subject is not ordered in a single task)."""
    w = weekly.withColumnRenamed(weekly_week, week) if weekly is not None else None
    out = left_join_or_self(trajectories, w, [subject, week])
    if tie and tie in out.columns:
        # skew-safe: ordered per (subject, week) plus a per-week boundary table
        from paneldeck.operators.panel import segmented_lead
        return segmented_lead(out, subject, week, [tie], "delta_kg", "delta_kg_next")
    win = Window.partitionBy(subject).orderBy(week)
    return out.withColumn("delta_kg_next", F.lead("delta_kg").over(win))


def join_wide(trajectories: DataFrame, weekly: DataFrame | None, keywords: DataFrame | None,
              subject: str = "subject_id", week: str = "week") -> DataFrame:
    """Trajectories ⟕ weekly ⟕ keywords on (subject, week)."""
    out = left_join_or_self(trajectories, weekly, [subject, week])
    return left_join_or_self(out, keywords, [subject, week])


def finish_wide(out: DataFrame, categories: list[str], fill: str = "flags_only", week: str = "week",
                high_flags: bool = True, drop_no_target: bool = True) -> DataFrame:
    """P8 (fill policy) + P9 (median flags) + P11 (rows with a target)."""
    if fill == "reference":
        fill_cols = [c for c in out.columns if c.endswith("_week") and c != week]
        out = out.fillna(0, subset=fill_cols)
    else:
        out = fill_zero(out, [f"{c}_week" for c in categories])
    if high_flags and "fiber_g_week" in out.columns and "calories_week" in out.columns:
        # The two global medians are one aggregate row, evaluated
        # first and inlined as literals (no join at all)
        from paneldeck.operators.quantiles import exact_quantiles_many
        med = exact_quantiles_many(out, ["fiber_g_week", "calories_week"], [0.5])
        fm = F.lit(med["fiber_g_week"][0.5]).cast("double")
        cm = F.lit(med["calories_week"][0.5]).cast("double")
        out = out.withColumns({
            "high_fiber_week": F.coalesce((F.col("fiber_g_week") > fm).cast("int"), F.lit(0)),
            "high_calorie_week": F.coalesce((F.col("calories_week") > cm).cast("int"), F.lit(0)),
        })
    if drop_no_target:
        out = out.filter(F.col("delta_kg_next").isNotNull())
    return out


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    """P10: drop rows with a NULL in any of the (present) model columns."""
    present = [c for c in cols if c in df.columns]
    return df.dropna(subset=present) if present else df
