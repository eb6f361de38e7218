"""Per-subject trajectories and panel windows (P2-P6, W1-W9, A9, ST1, ST2, U2, U6, J4, J5).

Windows are always partitioned by the subject, so every window of a table
shares one hash(subject) exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneldeck.functions.clean import null_nan, safe_div
from paneldeck.functions.dist import t_quantile_col


def weight_trajectories_long(measures: DataFrame, metric: str = "weight", subject: str = "subject_id",
                             week: str = "week", value: str = "value", tp_index: str = "tp_index",
                             exclude_notes: list[str] | None = None) -> DataFrame:
    """G3 trajectories: P1 metric filter, P2 (start & week 0) | end, P3 numeric
    coercion, W6 baseline at week 0 (subjects without one are dropped), P4
    delta / percent change and ST1 per-subject OLS slope on week with 95% CI.

    Plan: one ``groupBy(subject)`` (partial-aggregated regression sums and the
    baseline as a ``min_by``) joined back to the rows on subject; both sides are
    hash(subject) partitioned, so the join adds no exchange.
    """
    rows = (measures
            .filter(F.col("metric") == metric)
            .filter(((F.col("phase") == "start") & (F.col(week) == 0)) | (F.col("phase") == "end"))
            .withColumn(value, null_nan(F.col(value).try_cast("double") if dict(measures.dtypes).get(value) == "string" else F.col(value)))
            .filter(F.col(value).isNotNull()))
    x = F.col(week).cast("double")
    if exclude_notes:
        x = F.when(F.coalesce(F.col("note"), F.lit("")).isin(exclude_notes), F.lit(None)).otherwise(x)
    is0 = F.col(week) == 0
    stats = rows.groupBy(subject).agg(
        F.min_by(F.when(is0, F.col(value)), F.when(is0, F.struct(F.col(tp_index), F.col(value)))).alias("start_weight"),
        F.regr_count(F.col(value), x).alias("_n"),
        F.regr_slope(F.col(value), x).alias("_b"),
        F.regr_sxx(F.col(value), x).alias("_sxx"),
        F.regr_syy(F.col(value), x).alias("_syy"),
        F.regr_sxy(F.col(value), x).alias("_sxy"),
    ).filter(F.col("start_weight").isNotNull())
    slope = F.when(F.col("_n") >= 2, F.col("_b"))
    se = F.when(F.col("_n") > 2, F.sqrt(F.greatest(F.lit(0.0), F.col("_syy") - F.col("_b") * F.col("_sxy"))
                                        / (F.col("_n") - 2) / F.col("_sxx")))
    tcrit = F.when(F.col("_n") > 2, t_quantile_col(0.975, F.col("_n") - 2))
    stats = stats.select(
        subject, "start_weight",
        slope.alias("slope_kg_per_week"),
        (slope - tcrit * se).alias("slope_ci_lower"),
        (slope + tcrit * se).alias("slope_ci_upper"),
    )
    keep = [c for c in [subject, week, value, tp_index, "phase", "note"] if c in rows.columns]
    out = rows.select(*keep).join(stats, subject, "inner")
    return out.select(
        subject, week, value, "start_weight",
        (F.col(value) - F.col("start_weight")).alias("delta_kg"),
        ((safe_div(F.col(value), F.col("start_weight")) - 1) * 100).alias("pct_change"),
        "phase", *(["note"] if "note" in keep else []),
        "slope_kg_per_week", "slope_ci_lower", "slope_ci_upper",
        *([tp_index] if tp_index in keep else []),
    )


def weight_trajectories_wide(measures: DataFrame, subject: str = "subject_id", date: str = "date",
                             weight: str = "weight_kg", min_points: int = 3) -> DataFrame:
    """G4 trajectories: W1-W3 step deltas by date, A9/W7 first valid weight as
    baseline, deltas from baseline, and ST2 slope of weight on the row index of
    the non-null weights (needs ``min_points``)."""
    w = Window.partitionBy(subject).orderBy(date)
    whole = Window.partitionBy(subject)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = measures.withColumn(weight, null_nan(weight))
    df = df.withColumn("weight_kg_prev", F.lag(weight).over(w))
    df = df.withColumn("delta_kg", F.col(weight) - F.col("weight_kg_prev"))
    df = df.withColumn("delta_kg_pct", safe_div(F.col("delta_kg"), F.col("weight_kg_prev")) * 100)
    df = df.withColumn("delta_kg_next", F.lead("delta_kg").over(w))
    df = df.withColumn("baseline_weight_kg",
                       F.first(weight, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    df = df.withColumn("delta_from_baseline_kg", F.col(weight) - F.col("baseline_weight_kg"))
    df = df.withColumn("delta_from_baseline_pct", safe_div(F.col("delta_from_baseline_kg"), F.col("baseline_weight_kg")) * 100)
    idx = F.when(F.col(weight).isNotNull(), F.count(weight).over(running) - 1).cast("double")
    df = df.withColumn("_idx", idx)
    df = df.withColumn("weight_slope_kg_per_week",
                       F.when(F.count(weight).over(whole) >= min_points, F.regr_slope(F.col(weight), F.col("_idx")).over(whole)))
    cols = [subject, date, "week", weight, "energy_1_10", "mood_1_10", "delta_kg", "delta_kg_pct", "delta_kg_next",
            "baseline_weight_kg", "delta_from_baseline_kg", "delta_from_baseline_pct", "weight_slope_kg_per_week"]
    return df.select(*[c for c in cols if c in df.columns])


def index_slope(df: DataFrame, subject: str, order: str, value: str, min_points: int = 3) -> DataFrame:
    """ST2 as a per-subject table: slope of ``value`` on the 0-based index of its
    non-null rows, NULL below ``min_points``.  W8 row index by ``row_number``."""
    nn = df.filter(F.col(value).isNotNull())
    w = Window.partitionBy(subject).orderBy(order)
    nn = nn.withColumn("_idx", (F.row_number().over(w) - 1).cast("double"))
    return nn.groupBy(subject).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.when(F.count(F.lit(1)) >= min_points, F.regr_slope(F.col(value), F.col("_idx"))).alias("slope"),
    )


def calendar_spine(subjects: DataFrame, daily: DataFrame, extra_dates: DataFrame | None,
                   subject: str = "subject_id", date: str = "date") -> DataFrame:
    """U2 + A11 + U6 + J4 + J5: per subject a gap-preserving calendar from the
    earliest to the latest date seen in either date source, left-joined with
    the daily table.  Only subjects in ``subjects`` (semi-join) are kept."""
    dates = daily.select(subject, date)
    if extra_dates is not None:
        dates = dates.unionByName(extra_dates.select(subject, date))
    rng = (dates.filter(F.col(date).isNotNull())
           .join(subjects.select(subject), subject, "left_semi")
           .groupBy(subject).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi")))
    spine = rng.select(subject, F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias(date))
    return spine.join(daily, [subject, date], "left")


def segmented_lead(df: DataFrame, subject: str, segment: str, within: list[str], value: str, out: str) -> DataFrame:
    """W3/W4 without holding a whole subject in one task.

    The next row's ``value`` in (segment, *within) order per subject, computed
    in two levels: a lead inside each (subject, segment) group, and for the
    last row of a segment the first value of the subject's next segment,
    taken from a boundary table with one row per (subject, segment).  A
    subject holding a third of all rows is thus spread over its segments
    (e.g. weeks); only the boundary table, bounded by the number of segments
    per subject, is ordered per subject.  Equal to
    ``lead(value) over (partition by subject order by segment, *within)``."""
    # rows that arrive hashed by subject would satisfy the window: deal them anew
    df = df.repartition(subject, segment)
    w = Window.partitionBy(subject, segment).orderBy(*within)
    rows = df.withColumn("_in_lead", F.lead(value).over(w)) \
             .withColumn("_is_last", F.lead(F.lit(1)).over(w).isNull())
    # the same window's first row: no second sort, as min_by over a struct would need
    first = (df.withColumn("_is_first", F.lag(F.lit(1)).over(w).isNull()).where("_is_first")
             .select(subject, segment, F.col(value).alias("_seg_first")))
    nxt = first.withColumn("_next_first", F.lead("_seg_first").over(Window.partitionBy(subject).orderBy(segment)))
    joined = rows.join(nxt.select(subject, segment, "_next_first"), [subject, segment], "left")
    return joined.withColumn(out, F.when(F.col("_is_last"), F.col("_next_first")).otherwise(F.col("_in_lead"))) \
                 .drop("_in_lead", "_is_last", "_next_first")


def demean(df: DataFrame, subject: str, cols: list[str], suffix: str = "_within") -> DataFrame:
    """Each column minus its subject mean (one window over the
    subject's rows).  The regression operators never need this per-row form:
    they take the same within sums from per-subject moments."""
    w = Window.partitionBy(subject)
    return df.withColumns({f"{c}{suffix}": F.col(c) - F.avg(c).over(w) for c in cols})
