"""Exact quantiles (linear interpolation between order statistics, as pandas,
``numpy.percentile`` and SQL ``quantile_cont``) without buffering a group.

Spark's exact ``percentile`` / ``median`` aggregates keep a map of every
distinct value of a group and merge it in one task, so a global median of a
large continuous column ends in a single task.  Here values collapse to a
value-count table, each distinct value gets the number of rows below it
(bucketed prefix sums, see ``ranks.value_rank_table``), and only the rows
holding the wanted order statistics — at most two per probability — are
returned to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, value: str, probs: list[float], buckets: int | None = None) -> dict[float, float | None]:
    """Global exact quantiles of ``value`` (NULLs ignored) -> {prob: value}.
    One job: the grouped plan with a single group."""
    from paneldeck.operators.ranks import _zero_key
    rows = exact_quantiles_by(df.withColumn("__all", _zero_key(value)), ["__all"], value, probs, buckets).collect()
    got = {r["prob"]: r["quantile"] for r in rows}
    return {q: got.get(q) for q in probs}


def exact_quantiles_many(df: DataFrame, cols: list[str], probs: list[float],
                         buckets: int | None = None) -> dict[str, dict[float, float | None]]:
    """Exact quantiles of several columns in one job -> {column: {prob: value}}."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "__col", "__val")
    out = {c: {q: None for q in probs} for c in cols}
    for r in exact_quantiles_by(long, ["__col"], "__val", probs, buckets).collect():
        out[r["__col"]][r["prob"]] = r["quantile"]
    return out


def exact_quantiles_by(df: DataFrame, by: list[str], value: str, probs: list[float],
                       buckets: int | None = None) -> DataFrame:
    """Exact quantiles per group -> rows (by..., prob, quantile).

    Rows collapse to (group, value, count); the number of rows below each
    distinct value comes from ``ranks.grouped_below`` (per-group range
    buckets), so neither a hot group nor a hot value is ever ordered or
    buffered in a single task."""
    from paneldeck.operators.ranks import grouped_below
    if not by:
        from paneldeck.operators.ranks import _zero_key
        return exact_quantiles_by(df.withColumn("__grp", _zero_key(value)), ["__grp"], value, probs,
                                  buckets).drop("__grp")
    vc = (df.select(*by, F.col(value).cast("double").alias("_q"))
          .filter(F.col("_q").isNotNull() & ~F.isnan("_q"))
          .groupBy(*by, "_q").agg(F.count(F.lit(1)).alias("cnt")))
    vc = grouped_below(vc, by, "_q", buckets=buckets)
    n = vc.groupBy(*by).agg(F.sum("cnt").alias("n"))
    vc = vc.join(n, by)

    def holds(i):
        return (F.col("below") <= i) & (i < F.col("below") + F.col("cnt"))

    def order_statistics(prob):
        """Wanted position and the two ranks around it."""
        pos = prob * (F.col("n") - 1)
        lo = F.floor(pos)
        return pos, lo, F.least(lo + 1, F.col("n") - 1)

    # The ranked rows are read once: each names the probabilities it bears on, at
    # most two rows per group and probability do.
    wanted = []
    for q in probs:
        _, lo, hi = order_statistics(F.lit(float(q)))
        wanted.append(F.when(holds(lo) | holds(hi), F.lit(float(q))))
    hit = vc.select(*by, "_q", "cnt", "below", "n", F.explode(F.array_compact(F.array(*wanted))).alias("prob"))
    pos, lo, hi = order_statistics(F.col("prob"))
    return hit.groupBy(*by, "prob").agg(
        F.max(F.when(holds(lo), F.col("_q"))).alias("__q_lo"),
        F.max(F.when(holds(hi), F.col("_q"))).alias("__q_hi"),
        F.max(pos - lo).alias("__q_frac")).select(
        *by, "prob", (F.col("__q_lo") + F.col("__q_frac") * (F.col("__q_hi") - F.col("__q_lo"))).alias("quantile"))
