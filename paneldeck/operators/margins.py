"""Several grains from one set of mergeable partials: cubes and stored sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HLL_BITS = 14  # relative standard error 1.04 / sqrt(2 ** 14) = 0.8 %
KLL_K = 800  # normalised rank error about 0.4 %


def partials(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n, n_value, total, low, high: one mergeable row for each group.  The
    only shuffle of raw rows, combined on the map side."""
    v = F.col(value)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count(v).alias("n_value"), F.sum(v).alias("total"),
                                   F.min(v).alias("low"), F.max(v).alias("high"))


def cube_margins(parts: DataFrame, keys: list[str]) -> DataFrame:
    """All margins of ``partials`` with ``margin`` (the grouping id: bit set = key
    summed over, last key lowest), merged from the partials alone."""
    return (parts.cube(*keys).agg(
        F.grouping_id().cast("long").alias("margin"), F.sum("n").alias("n"), F.sum("n_value").alias("n_value"),
        F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))
        .withColumn("mean", F.try_divide("total", "n_value")))


def sketches(rows: DataFrame, keys: list[str], member: str, value: str) -> DataFrame:
    """keys, n, members, values: a distinct-count sketch of ``member`` and a quantile
    sketch of ``value`` for each group, of a size that does not grow with it."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(member, HLL_BITS).alias("members"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), KLL_K).alias("values"))


def merged_sketches(stored: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """keys, n, n_members and the quantiles ``q<percent>`` from stored sketches: no
    raw row is read again.  Empty quantile sketches give null."""
    merged = stored.groupBy(*keys).agg(F.sum("n").alias("n"), F.hll_union_agg("members").alias("members"),
                                       F.kll_merge_agg_double("values").alias("values"))
    some = F.kll_sketch_get_n_double("values") > 0
    return merged.select(*keys, "n", F.hll_sketch_estimate("members").alias("n_members"), *[
        F.when(some, F.kll_sketch_get_quantile_double("values", F.lit(float(p)))).alias(f"q{round(100 * p)}") for p in probs])
