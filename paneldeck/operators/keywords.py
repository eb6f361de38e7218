"""Keyword category flags and mention counts.

A dictionary ``{category: regex}`` becomes one wide aggregate: every category
is a ``max(rlike)`` flag (and optionally a ``sum(regexp_count)`` mention
count) in the same ``groupBy``, over text lower-cased once in a projection.

Matching is done per row and combined with ``max``/``sum`` (partial-aggregable,
so a hot subject never needs its whole text in one task).  ``joined=True``
adds the reference's cross-entry phrase matches (quirk Q17) from each entry's
next few neighbours, never by gathering a group's texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _ci(pattern: str) -> str:
    return "(?i)" + pattern


def _max_words(dictionary: dict[str, str]) -> int:
    """Longest alternative (in words) of the dictionary's phrase patterns."""
    best = 1
    for pat in dictionary.values():
        inner = pat.replace("\\b", "").strip("()")
        for alt in inner.split("|"):
            best = max(best, len(alt.strip().split(" ")))
    return best


def match_bits(text, dictionary: dict[str, str]):
    """A long whose bit i is set where the text matches the dictionary's category i
    (63 at most).  A NULL text counts as ''."""
    t = F.lower(F.coalesce(text, F.lit("")))
    bits = F.lit(0).cast("long")
    for i, pattern in enumerate(dictionary.values()):
        bits = bits.bitwiseOR(F.when(t.rlike(_ci(pattern)), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def keyword_flags(rows: DataFrame, keys: list[str], text: str, dictionary: dict[str, str],
                  prefix: str = "kw_", suffix: str = "", mentions_suffix: str | None = None,
                  joined: bool = False, order_col: str | None = None) -> DataFrame:
    """A4 / A5: per-group flags (and mention counts) for each dictionary category.

    Returns one row per ``keys`` group with ``{prefix}{cat}{suffix}`` int flags and,
    when ``mentions_suffix`` is given, ``{cat}{mentions_suffix}`` counts.
    A NULL text counts as '' (row kept, all flags 0).

    ``joined=True`` gives the reference's "join the group's entries with
    spaces, then search" semantics (quirk Q17) without gathering a group: a
    phrase of w words can span at most w consecutive entries, so every entry
    is also matched together with its next w - 1 entries (leads over the
    group ordered by ``order_col``).  Flags are exact; mention counts add the
    matches that start in an entry and end in a later one.
    """
    if text not in rows.columns:
        return rows  # reference: missing text column -> input unchanged
    t = "__kw_text"
    base = rows.select(*keys, F.lower(F.coalesce(F.col(text), F.lit(""))).alias(t),
                       *([order_col] if joined and order_col else []))
    aggs = []
    if joined:
        span = _max_words(dictionary)
        w = Window.partitionBy(*keys).orderBy(F.col(order_col) if order_col else F.lit(0))
        nxt = [F.lead(t, k).over(w) for k in range(1, span)]
        base = base.withColumn("__kw_win", F.concat_ws(" ", F.col(t), *nxt)) \
                   .withColumn("__kw_rest", F.concat_ws(" ", *nxt) if nxt else F.lit(""))
    for cat, pat in dictionary.items():
        rx = _ci(pat)
        src = F.col("__kw_win") if joined else F.col(t)
        aggs.append(F.max(src.rlike(rx).cast("int")).alias(f"{prefix}{cat}{suffix}"))
        if mentions_suffix is not None:
            cnt = F.regexp_count(F.col(t), F.lit(rx))
            if joined:  # + matches spanning from this entry into the next ones
                cnt = cnt + F.greatest(F.lit(0), F.regexp_count(F.col("__kw_win"), F.lit(rx)) - cnt
                                       - F.regexp_count(F.col("__kw_rest"), F.lit(rx)))
            aggs.append(F.coalesce(F.sum(cnt), F.lit(0)).cast("int").alias(f"{cat}{mentions_suffix}"))
    return base.groupBy(*keys).agg(*aggs)


def weekly_keywords_wide(rows: DataFrame, dictionary: dict[str, str], subject: str = "subject_id",
                         week: str = "week", text: str = "food_item", joined: bool = False,
                         order_col: str | None = None) -> DataFrame:
    """A5 + A6 + A7: weekly ``{cat}_week`` flag, ``{cat}_mentions`` count,
    ``food_variety_categories`` and ``food_entries_week``.  ``joined``: search the
    week's entries joined by spaces in ``order_col`` order, so that a phrase may
    begin in one entry and end in the next (see ``keyword_flags``)."""
    if joined:
        known = rows.filter(F.col(week).isNotNull())
        flags = keyword_flags(known, [subject, week], text, dictionary, prefix="", suffix="_week",
                              mentions_suffix="_mentions", joined=True, order_col=order_col)
        entries = known.groupBy(subject, week).agg(F.count(F.lit(1)).cast("int").alias("food_entries_week"))
        variety = sum((F.col(f"{c}_week") for c in dictionary), F.lit(0))
        return flags.join(entries, [subject, week]).withColumn("food_variety_categories", variety.cast("int"))
    t = "__kw_text"
    base = rows.filter(F.col(week).isNotNull()).select(
        subject, week, F.lower(F.coalesce(F.col(text), F.lit(""))).alias(t))
    aggs = []
    for cat, pat in dictionary.items():
        aggs.append(F.max(F.col(t).rlike(_ci(pat)).cast("int")).alias(f"{cat}_week"))
        aggs.append(F.coalesce(F.sum(F.regexp_count(F.col(t), F.lit(_ci(pat)))), F.lit(0))
                    .cast("int").alias(f"{cat}_mentions"))
    aggs.append(F.count(F.lit(1)).cast("int").alias("food_entries_week"))
    g = base.groupBy(subject, week).agg(*aggs)
    variety = sum((F.col(f"{c}_week") for c in dictionary), F.lit(0))
    return g.withColumn("food_variety_categories", variety.cast("int"))


def keyword_prevalence(flags: DataFrame, categories: list[str], prefix: str = "kw_") -> DataFrame:
    """Per category the number of positive groups, total groups and percent.

    One aggregate pass, then an unpivot of the single result row.
    """
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.coalesce(F.sum(f"{prefix}{c}"), F.lit(0)).cast("bigint").alias(c) for c in categories]
    one = flags.agg(*aggs)
    long = one.unpivot(["total"], categories, "keyword", "positive")
    return long.select(
        "keyword",
        F.col("positive").cast("bigint").alias("positive"),
        F.col("total").cast("bigint").alias("total"),
        (F.try_divide(F.col("positive") * 100.0, F.col("total"))).alias("pct"),
    )


def daily_totals_and_flags(rows: DataFrame, keys: list[str], sums: dict[str, str], text: str,
                           dictionary: dict[str, str], prefix: str = "kw_", count_name: str = "n_entries",
                           bits: str | None = None) -> DataFrame:
    """A1 + A4 fused: totals, entry count and keyword flags of the same rows in
    ONE ``groupBy``.  Because flags and totals share keys and rows, this equals
    the daily-totals ⟕ daily-flags join (J1 + P8) without a second scan, join
    or shuffle of the food rows.  The flags of a group are the union of its rows'
    ``match_bits``, one number in the aggregate; rows that bring them as the column
    ``bits`` (matched once per text before a join) are not matched again."""
    b = "__kw_bits"
    base = rows.filter(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())
    base = base.withColumn(b, F.col(bits) if bits else match_bits(F.col(text), dictionary))
    aggs = [F.coalesce(F.sum(src), F.lit(0.0)).alias(dst) for src, dst in sums.items()]
    aggs.append(F.count(F.lit(1)).alias(count_name))
    out = base.groupBy(*keys).agg(*aggs, F.bit_or(b).alias(b))
    return out.select(*[c for c in out.columns if c != b],
                      *[F.getbit(b, F.lit(i)).cast("int").alias(f"{prefix}{c}") for i, c in enumerate(dictionary)])
