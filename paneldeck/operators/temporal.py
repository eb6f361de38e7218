"""Joins and frames over time: as-of, interval and overlap joins, rolling frames.

Time is cut into segments.  Rows meet inside (key, segment), so a subject with a
third of all rows is spread over its segments; what crosses a segment's border is
carried by a table with one row for each segment, or by a halo of copied rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneldeck.session import INITIAL_PARTITIONS

MICROS = 1_000_000
STRETCH = 16  # bins of an overlap join whose rows are dealt together


def segment_of(time: Column, seconds: int) -> Column:
    """Number of the segment that holds a timestamp or date."""
    return F.floor(F.unix_micros(time.cast("timestamp")) / (seconds * MICROS)).cast("long")


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str,
              values: dict[str, str], order: list[str] | None = None, tolerance: int | None = None,
              segment: int = 86_400) -> DataFrame:
    """``left`` with the columns ``values`` (right column -> new name) of the latest
    row of ``right`` at or before ``left_time`` with the same ``by``; null where
    there is none within ``tolerance`` seconds.

    Of right rows at one time the last by ``order`` counts.  Rows with a null key
    or time never match; left rows all stay, right rows without a time are left
    out.  Both sides are united and the last right row is taken within (by,
    segment of ``segment`` seconds); a carry table with one row for each of these
    hands the last one on to later segments.  Only the carry table is ordered by
    key alone.
    """
    order = order or []
    own = F.struct(*[F.col(c) for c in left.columns])
    told = F.struct(F.col(right_time).cast("timestamp").alias("time"), *[F.col(c).alias(f"order_{i}") for i, c in enumerate(order)],
                    *[F.col(c).alias(n) for c, n in values.items()])
    side = lambda df, time, mine, theirs, no: df.select(
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col(time).cast("timestamp").alias("_time"),
        F.lit(no).alias("_side"), mine.alias("_left"), theirs.alias("_right"))
    left_type = left.select(own.alias("x")).schema["x"].dataType
    known = right.where(F.col(right_time).isNotNull() & F.greatest(*[F.col(c).isNull() for c in [*by, by[0]]]).eqNullSafe(False))
    right_type = known.select(told.alias("x")).schema["x"].dataType
    both = side(left, left_time, own, F.lit(None).cast(right_type), 1).unionByName(
        side(known, right_time, F.lit(None).cast(left_type), told, 0)).withColumn("_segment", segment_of(F.col("_time"), segment))
    keys = [f"_by{i}" for i in range(len(by))]
    # at one time right rows come first, in their order
    upto = Window.partitionBy(*keys, "_segment").orderBy("_time", "_side", "_right").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    within = both.withColumn("_found", F.last("_right", ignorenulls=True).over(upto))
    earlier = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    carry = (both.groupBy(*keys, "_segment").agg(F.max("_right").alias("_last"))
             .withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).drop("_last"))
    joined = (within.where("_side = 1").join(carry, [*keys, "_segment"], "left")
              .withColumn("_found", F.coalesce("_found", "_carried")))
    fits = F.lit(True) if tolerance is None else (
        F.unix_micros("_time") - F.unix_micros("_found.time") <= tolerance * MICROS)
    return joined.select("_left.*", *[F.when(fits, F.col(f"_found.{n}")).alias(n) for n in values.values()])


def split_bins(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """keys, pieces: into how many pieces each bin of ``rows`` is split so that
    none holds much more than ``most``."""
    return rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("_pieces")).where("_pieces > 1")


def overlap_join(left: DataFrame, right: DataFrame, by: list[str], left_span: tuple[str, str], right_span: tuple[str, str],
                 bin_seconds: int = 86_400, most: int = 50_000) -> DataFrame:
    """All pairs of rows with the same ``by`` whose half-open spans [start, stop)
    overlap.  The two sides must not share column names but ``by``.

    Spans are copied to every bin of time that they touch, and rows meet by (by,
    bin).  A pair that meets in several bins belongs to the one in which the later
    of the two starts lies.  Rows are dealt by stretches of ``STRETCH`` bins, few of
    which a span touches, and copied to a stretch's bins only where they then lie.
    Stretches with more than ``most`` left rows are split: left rows are dealt over
    the pieces and right rows copied to each, so no pair is lost or doubled.  Spans
    that are empty, reversed or null, and null keys, match nothing.
    """
    width = bin_seconds * MICROS
    spark = left.sparkSession
    count = 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(INITIAL_PARTITIONS, None) or 1))

    def bins(name: str, wide: int) -> tuple[Column, Column]:
        return F.floor(F.col(f"_{name}0") / wide).cast("long"), F.floor((F.col(f"_{name}1") - 1) / wide).cast("long")

    def stretched(df: DataFrame, span: tuple[str, str], name: str) -> DataFrame:
        start, stop = (F.unix_micros(F.col(c).cast("timestamp")) for c in span)
        whole = df.where(start < stop).withColumns({f"_{name}0": start, f"_{name}1": stop})
        return whole.withColumn("_stretch", F.explode(F.sequence(*bins(name, STRETCH * width))))

    def binned(df: DataFrame, name: str) -> DataFrame:
        first, last = bins(name, width)
        begin = F.col("_stretch") * STRETCH
        return df.repartition(count, *keys, "_piece").withColumn("_bin", F.explode(F.sequence(
            F.greatest(first, begin), F.least(last, begin + (STRETCH - 1)))))

    keys = [*by, "_stretch"]
    a, b = stretched(left, left_span, "a"), stretched(right, right_span, "b")
    pieces = split_bins(a, keys, most)
    parts = F.coalesce("_pieces", F.lit(1))
    row = F.xxhash64(*[F.col(c) for c in left.columns if c not in by])
    # one row for each ``most`` left rows and more: small enough to broadcast, which
    # saves both sides a shuffle
    pieces = F.broadcast(pieces)
    a = a.join(pieces, keys, "left").withColumn("_piece", F.pmod(row, parts).cast("int")).drop("_pieces")
    b = b.join(pieces, keys, "left").withColumn("_piece", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_pieces")
    later = F.floor(F.greatest("_a0", "_b0") / width).cast("long")
    return (binned(a, "a").join(binned(b, "b"), [*keys, "_piece", "_bin"])
            .where((F.col("_a0") < F.col("_b1")) & (F.col("_b0") < F.col("_a1")) & (F.col("_bin") == later))
            .drop("_stretch", "_bin", "_piece", "_a0", "_a1", "_b0", "_b1"))


def interval_join(points: DataFrame, spans: DataFrame, by: list[str], time: str, span: tuple[str, str],
                  bin_seconds: int = 86_400, most: int = 50_000) -> DataFrame:
    """All pairs of a point in time and a half-open span [start, stop) that holds
    it, with the same ``by``: an overlap join of spans one microsecond long."""
    at = F.col(time).cast("timestamp")
    ends = points.withColumn("_until", F.timestamp_micros(F.unix_micros(at) + 1))
    return overlap_join(ends, spans, by, (time, "_until"), span, bin_seconds, most).drop("_until")


def rolling(rows: DataFrame, by: list[str], date: str, value: str, days: int, prefix: str,
            segment_days: int = 91) -> DataFrame:
    """``rows`` with the count, mean and slope per day of ``value`` over the
    ``days`` calendar days that end on the row's ``date`` (all rows of that date
    included), as ``prefix`` + ``_n``, ``_mean`` and ``_slope``.

    Rows are framed within (by, segment); each segment also gets a halo, copies of
    the rows of the ``days`` before it, so no frame is cut.  Null values count as
    missing, null dates have no frame; the slope is null below two dates.
    """
    day = F.unix_date(F.col(date).cast("date"))
    own = F.floor(day / segment_days).cast("long")
    last = F.floor((day + days - 1) / segment_days).cast("long")
    dealt = (rows.withColumns({"_day": day.cast("long"), "_own": own})
             .withColumn("_segment", F.explode_outer(F.sequence(own, last))))
    frame = Window.partitionBy(*by, "_segment").orderBy("_day").rangeBetween(-(days - 1), 0)
    v = F.col(value).cast("double")
    x = F.when(v.isNotNull(), (F.col("_day") - F.col("_segment") * segment_days).cast("double"))
    n, sx, sy = F.count(v).over(frame), F.sum(x).over(frame), F.sum(v).over(frame)
    sxx, sxy = F.sum(x * x).over(frame), F.sum(x * v).over(frame)
    spread = n * sxx - sx * sx
    framed = dealt.withColumns({
        f"{prefix}_n": F.when(F.col("_day").isNotNull(), n), f"{prefix}_mean": F.when(F.col("_day").isNotNull(), F.avg(v).over(frame)),
        f"{prefix}_slope": F.when(F.col("_day").isNotNull() & (spread > 0), (n * sxy - sx * sy) / spread)})
    return framed.where(F.col("_segment").eqNullSafe(F.col("_own"))).drop("_day", "_own", "_segment")
