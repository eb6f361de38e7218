"""Descriptive tables (A10, A13-A22, A24, P15, P16, P18, U5, RP5).

Every table is one or two aggregates; medians and quartiles are exact
(``percentile``, linear interpolation like pandas), never sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneldeck.functions.clean import safe_div
from paneldeck.operators.quantiles import exact_quantiles, exact_quantiles_by, exact_quantiles_many

# Duration buckets by number of measurements.
DURATION_BUCKETS = [(28, "4+ Weeks"), (14, "2-4 Weeks"), (7, "1-2 Weeks")]
DURATION_FALLBACK = "< 1 Week"


def participant_changes(df: DataFrame, subject: str, order: list[str], value: str,
                        category: str | None = None, min_points: int = 2) -> DataFrame:
    """A10: first and last valid measurement per participant (in ``order``),
    change, percent change and number of measurements (≥ ``min_points``)."""
    nn = df.filter(F.col(value).isNotNull())
    key = F.struct(*[F.col(c) for c in order])
    aggs = [F.min_by(value, key).alias("starting_weight"), F.max_by(value, key).alias("ending_weight"),
            F.count(F.lit(1)).alias("num_measurements")]
    if category:
        aggs.append(F.min_by(category, key).alias("category"))
    g = nn.groupBy(subject).agg(*aggs).filter(F.col("num_measurements") >= min_points)
    g = g.withColumn("weight_change", F.col("ending_weight") - F.col("starting_weight"))
    return g.withColumn("weight_change_percent", safe_div(F.col("weight_change"), F.col("starting_weight")) * 100)


def duration_bucket(n: Column | str, buckets=DURATION_BUCKETS, fallback: str = DURATION_FALLBACK) -> Column:
    """CASE bucketing of a duration by descending thresholds."""
    c = F.col(n) if isinstance(n, str) else n
    out = None
    for thr, label in buckets:
        out = F.when(c >= thr, F.lit(label)) if out is None else out.when(c >= thr, F.lit(label))
    return out.otherwise(F.lit(fallback))


def cohort_summary(p: DataFrame, change: str = "weight_change", start: str = "starting_weight",
                   duration: str = "num_measurements") -> DataFrame:
    """Participants, mean / median / population-std change, successes
    (change < 0), success rate, mean starting weight and mean duration."""
    med = exact_quantiles(p, change, [0.5])[0.5]
    return p.agg(
        F.count(F.lit(1)).alias("total_participants"),
        F.avg(change).alias("avg_change"),
        F.lit(med).cast("double").alias("median_change"),
        F.stddev_pop(change).alias("std_change"),
        F.count(F.when(F.col(change) < 0, 1)).alias("successful"),
        (F.try_divide(F.count(F.when(F.col(change) < 0, 1)) * 100.0, F.count(F.lit(1)))).alias("success_rate"),
        F.avg(start).alias("avg_starting_weight"),
        F.avg(duration).alias("avg_duration"),
    )


def category_mean(df: DataFrame, category: str, value: str) -> DataFrame:
    """Mean and count of ``value`` by category."""
    return df.groupBy(category).agg(F.avg(value).alias("mean"), F.count(value).alias("count"))


def range_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Min and max of each column, one row."""
    return df.agg(*[F.min(c).alias(f"{c}_min") for c in cols], *[F.max(c).alias(f"{c}_max") for c in cols])


def histogram(df: DataFrame, value: str, bins: int | None = None, max_bins: int = 15) -> DataFrame:
    """RP5: equal-width histogram between min and max, last edge inclusive;
    empty bins are kept.  ``bins=None`` uses min(max_bins, n // 2) (at least 1)."""
    d = df.select(F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    st = d.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    spark = df.sparkSession
    schema = "bin int, bin_lower double, bin_upper double, count bigint"
    if not st["n"]:
        return spark.createDataFrame([], schema)
    lo, hi, n = float(st["lo"]), float(st["hi"]), int(st["n"])
    nb = int(bins) if bins else max(1, min(max_bins, n // 2))
    width = (hi - lo) / nb
    idx = (F.lit(0) if hi == lo else F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(nb - 1))).cast("int")
    counts = d.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    # the bin grid has nb <= max_bins rows: built from the bounds, not the data
    grid = spark.range(nb).select(F.col("id").cast("int").alias("bin"))
    grid = grid.select("bin", (F.lit(lo) + F.col("bin") * F.lit(hi - lo) / F.lit(nb)).alias("bin_lower"),
                       (F.lit(lo) + (F.col("bin") + 1) * F.lit(hi - lo) / F.lit(nb)).alias("bin_upper"))
    return grid.join(counts, "bin", "left").select(
        "bin", "bin_lower", "bin_upper", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))


DESCRIBE_STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pandas-style describe (count, mean, sample std, min, exact
    quartiles, max) with an explicit ``statistic`` column (Q14), one aggregate."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"),
                 F.stddev_samp(x).alias(f"std__{c}"), F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}")]
    # quartiles of every column in one grouped pass over (column, value)
    quart = exact_quantiles_many(df, cols, [0.25, 0.5, 0.75])
    share = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
    entries = [F.struct(F.lit(s).alias("statistic"), *[
        (F.lit(quart[c].get(share[s])).cast("double") if s in share else F.col(f"{s}__{c}")).alias(c) for c in cols])
        for s in DESCRIBE_STATS]
    return df.agg(*aggs).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def pivot_weeks(df: DataFrame, subject: str, week: str, values: list[str], weeks: list[int],
                tie: str | None = None) -> DataFrame:
    """A13 + U5: per subject the value at each listed week (first row of that
    week by ``tie``), one column per (value, week); missing weeks are NULL."""
    key = F.struct(F.col(tie)) if tie else F.lit(0)
    aggs = [F.min_by(F.when(F.col(week) == w, F.col(v)), F.when(F.col(week) == w, key)).alias(f"{v}_week_{w}")
            for w in weeks for v in values]
    return df.groupBy(subject).agg(*aggs)


def early_late(df: DataFrame, subject: str, week: str, values: dict[str, str], split: int = 4) -> DataFrame:
    """A15 + P18: per subject the mean of each value in the early period
    (week < split) and the later period (week >= split), with row counts."""
    early = F.col(week) <= split - 1
    late = F.col(week) >= split
    aggs = []
    for src, name in values.items():
        aggs.append(F.avg(F.when(early, F.col(src))).alias(f"{name}_early_mean"))
        aggs.append(F.avg(F.when(late, F.col(src))).alias(f"{name}_later_mean"))
    aggs += [F.count(F.when(early, 1)).alias("n_early_weeks"), F.count(F.when(late, 1)).alias("n_later_weeks")]
    return df.groupBy(subject).agg(*aggs)


def keyword_crosstab(df: DataFrame, outcome: str, flags: dict[str, str]) -> DataFrame:
    """Per keyword flag, count and median outcome with / without the
    keyword plus the overall median, over rows with a known outcome."""
    d = df.filter(F.col(outcome).isNotNull())
    overall = exact_quantiles(d, outcome, [0.5])[0.5]
    # all flags in one pass: one long row per flag and known flag value
    long = (d.select(F.col(outcome).alias("_o"), F.explode(F.array(*[
        F.struct(F.lit(name).alias("keyword"), F.col(col).cast("int").alias("_f")) for name, col in flags.items()]))
        .alias("_s")).select("_s.*", "_o").filter(F.col("_f").isin(0, 1)))
    med = {(r["keyword"], r["_f"]): r["quantile"]
           for r in exact_quantiles_by(long, ["keyword", "_f"], "_o", [0.5]).collect()}  # two rows per flag
    counts = [F.count(F.when(F.col(col) == v, 1)).alias(f"n{v}_{name}") for name, col in flags.items() for v in (0, 1)]
    entries = [F.struct(
        F.lit(name).alias("keyword"), F.col(f"n1_{name}").alias("n_weeks_with_keyword"),
        F.col(f"n0_{name}").alias("n_weeks_without_keyword"),
        F.lit(med.get((name, 1))).cast("double").alias("median_delta_with_keyword"),
        F.lit(med.get((name, 0))).cast("double").alias("median_delta_without_keyword"),
        F.lit(overall).cast("double").alias("overall_median_delta")) for name in flags]
    return d.agg(*counts).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def group_medians(df: DataFrame, flag: str, value: str) -> DataFrame:
    """Median and size of ``value`` per flag value."""
    d = df.filter(F.col(flag).isNotNull() & F.col(value).isNotNull())
    meds = exact_quantiles_by(d, [flag], value, [0.5]).select(flag, F.col("quantile").alias("median"))
    return d.groupBy(flag).agg(F.count(F.lit(1)).alias("n")).join(meds, flag)


def weekly_mean_sd(df: DataFrame, week: str, value: str) -> DataFrame:
    """Mean and sample std of ``value`` by week across subjects."""
    return df.groupBy(week).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
                                F.count(value).alias("n"))


def weekly_prevalence(df: DataFrame, week: str, flags: list[str]) -> DataFrame:
    """Share of rows with each boolean flag set, by week."""
    return df.groupBy(week).agg(*[F.avg(F.col(f).cast("double")).alias(f"{f}_share") for f in flags])


def outcome_summary(df: DataFrame, subject: str, week: str, value: str) -> DataFrame:
    """A24 + J7: at the final study week (the scalar max, used as a literal filter): mean ± sd of
    the outcome, subjects losing (< 0), their share and the range."""
    final = df.agg(F.max(week).alias("_final")).first()["_final"]
    last = df.filter((F.col(week) == F.lit(final)) & F.col(value).isNotNull())
    return last.agg(
        F.lit(final).cast(dict(df.dtypes)[week]).alias("final_week"),
        F.countDistinct(subject).alias("n_subjects"),
        F.avg(value).alias("mean_change"), F.stddev_samp(value).alias("sd_change"),
        F.count(F.when(F.col(value) < 0, 1)).alias("n_losing"),
        F.avg((F.col(value) < 0).cast("double")).alias("share_losing"),
        F.min(value).alias("min_change"), F.max(value).alias("max_change"))


def point_classes(flag_a: str, flag_b: str, label_a: str, label_b: str) -> list[Column]:
    """Overlapping point classes of a scatter report: ``is_other`` when
    neither flag is set, ``is_<label_a>`` / ``is_<label_b>`` for each set flag
    (a point with both flags belongs to both classes, as in the figure)."""
    a, b = F.col(flag_a), F.col(flag_b)
    return [((a == 0) & (b == 0)).cast("int").alias("is_other"),
            (a == 1).cast("int").alias(f"is_{label_a}"),
            (b == 1).cast("int").alias(f"is_{label_b}")]
