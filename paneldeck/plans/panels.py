"""End-to-end panel builds on the driver tables (both dialects)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneldeck.functions.dictionaries import PART_KEYWORDS
from paneldeck.operators import assemble, keywords, panel, rollup
from paneldeck.plans import bindings as B
from paneldeck.session import materialized


def kw_daily(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    rows = rows if rows is not None else B.food_rows(spark, d)
    rows = rows.filter(F.col("date").isNotNull() & F.col("subject_id").isNotNull())
    return keywords.keyword_flags(rows, ["subject_id", "date"], "food", PART_KEYWORDS, prefix="kw_")


def daily_with_flags(spark: SparkSession, d: str) -> DataFrame:
    """J1 + P8 as written in the reference: daily totals ⟕ daily flags."""
    rows = B.food_rows(spark, d)
    return assemble.prepare_daily(B.daily_long(spark, d, rows), kw_daily(spark, d, rows), B.KW_FLAGS)


def daily_flags(spark: SparkSession, d: str) -> DataFrame:
    """Daily totals + flags in one aggregate over the food rows, materialised
    once in the shared checkpoint folder: the weekly rollup, the week origin
    and the measurements all read this (much smaller) table instead of
    re-running the lineitem ⋈ orders ⋈ part join."""
    return materialized(spark, ("daily_flags", d), lambda: keywords.daily_totals_and_flags(
        B.food_rows(spark, d, bits=True), ["subject_id", "date"], B.NUTRIENTS, "food", PART_KEYWORDS, bits="kw_bits"))


def weekly_long(spark: SparkSession, d: str, daily: DataFrame | None = None) -> DataFrame:
    dflags = daily if daily is not None else daily_flags(spark, d)
    dflags = rollup.add_week_index(dflags, out="week_index")
    return rollup.weekly_rollup_long(dflags, B.DAILY_NUTRIENTS, B.KW_FLAGS)


def trajectories_long(spark: SparkSession, d: str, daily: DataFrame | None = None) -> DataFrame:
    daily = daily if daily is not None else daily_flags(spark, d)
    m = B.measures_long(spark, d, daily.select("subject_id", "date"))
    return panel.weight_trajectories_long(m)


def analysis_long(spark: SparkSession, d: str) -> DataFrame:
    """The long-dialect analysis panel, written once per session and input
    (the feature-stage output every model reads)."""
    def build():
        daily = daily_flags(spark, d)
        return assemble.align_long(trajectories_long(spark, d, daily), weekly_long(spark, d, daily))
    return materialized(spark, ("analysis_long", d), build)


def trajectories_wide(spark: SparkSession, d: str) -> DataFrame:
    return panel.weight_trajectories_wide(B.measures_wide(spark, d))


def weekly_wide(spark: SparkSession, d: str) -> DataFrame:
    return rollup.weekly_rollup_wide(B.daily_wide(spark, d))


def keywords_wide(spark: SparkSession, d: str) -> DataFrame:
    """Weekly food-keyword table (a stage output of its own), written once."""
    def build():
        origin = rollup.subject_origin(daily_flags(spark, d))
        return keywords.weekly_keywords_wide(B.food_rows_wide(spark, d, origin), PART_KEYWORDS)
    return materialized(spark, ("keywords_wide", d), build)


def analysis_wide(spark: SparkSession, d: str, fill: str = "flags_only") -> DataFrame:
    """The wide-dialect analysis panel for one fill policy, written once per
    session and input."""
    joined = materialized(spark, ("wide_joined", d), lambda: assemble.join_wide(
        trajectories_wide(spark, d), weekly_wide(spark, d), keywords_wide(spark, d)))
    return materialized(spark, ("analysis_wide", d, fill),
                        lambda: assemble.finish_wide(joined, list(PART_KEYWORDS), fill=fill))
