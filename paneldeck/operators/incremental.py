"""Weight trajectories kept up to date delivery by delivery.

A subject's history is a mergeable state: rows and valid values so far, the first
valid value, the last row, and the moments of value against index.  A delivery is
cut into (subject, calendar week) segments; each gives a state of its own, the states of a
subject are chained in order onto the stored one, and history is never read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneldeck.functions.clean import null_nan, safe_div
from paneldeck.session import stage_path

STATE = ("subject_id long, last_date date, last_weight double, baseline double, n long, "
         "si double, sw double, siw double, sii double")
ROWS = "subject_id long, date date, week int, weight_kg double, weight_kg_prev double, delta_kg double"
AFTER = "subject_id long, date date, delta_kg_next double"
LATE = "subject_id long, date date, week int, weight_kg double"


def calendar_week() -> Column:
    """The piece of a delivery that a row falls into."""
    return F.floor(F.unix_date("date") / 7)


class TrajectoryStore:
    """Deliveries below ``path`` (a new folder unless given).  Each has its own
    folders ``rows``, ``after`` (the step that follows the last row of an earlier
    delivery), ``late`` and ``state``, so a repeated delivery replaces itself and
    a store is reopened by its path.

    A delivery holds subject_id, date, week and weight_kg, one row for a subject
    and date.  Rows not after the subject's last date so far are kept in ``late``
    and change nothing; null subjects and dates likewise.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or stage_path(spark, "trajectories")

    def folder(self, kind: str, delivery: int | None = None) -> str:
        return f"{self.path}/{kind}" + ("" if delivery is None else f"/delivery={delivery:06d}")

    def _read(self, kind: str, schema: str, delivery: int | None = None) -> DataFrame:
        read = self.spark.read.schema(schema + (", delivery int" if delivery is None else ""))
        return read.parquet(self.folder(kind, delivery))

    def state(self, delivery: int) -> DataFrame:
        """The state after ``delivery`` deliveries (numbered from 1)."""
        if delivery < 1:
            return self.spark.createDataFrame([], STATE)
        return self._read("state", STATE, delivery)

    def deliver(self, batch: DataFrame, delivery: int) -> None:
        """Add delivery number ``delivery``; the one before must be there."""
        known = self.state(delivery - 1)
        told = batch.select("subject_id", F.col("date").cast("date").alias("date"), F.col("week").cast("int").alias("week"),
                            null_nan(F.col("weight_kg")).alias("weight_kg"))
        dated = told.join(known.select("subject_id", "last_date"), "subject_id", "left")
        fresh = F.col("subject_id").isNotNull() & F.col("date").isNotNull() & (
            F.col("last_date").isNull() | (F.col("date") > F.col("last_date")))
        write = lambda df, kind: df.write.mode("overwrite").parquet(self.folder(kind, delivery))
        write(dated.where(~fresh).select("subject_id", "date", "week", "weight_kg"), "late")
        rows = dated.where(fresh).drop("last_date").withColumn("seg", calendar_week())

        # the first and last row of each segment, handed to its neighbours
        inside = Window.partitionBy("subject_id", "seg").orderBy("date")
        ends = rows.groupBy("subject_id", "seg").agg(F.max_by("weight_kg", "date").alias("last_weight"), F.min("date").alias("from"))
        over = Window.partitionBy("subject_id").orderBy("from")
        before = (ends.withColumn("handed", F.lag(F.struct("last_weight")).over(over))
                  .join(known.select("subject_id", F.struct(F.col("last_weight")).alias("kept")), "subject_id", "left")
                  .select("subject_id", "seg", F.coalesce("handed", "kept").alias("before")))
        stepped = (rows.join(before, ["subject_id", "seg"])
                   .withColumn("no", F.row_number().over(inside))
                   .withColumn("weight_kg_prev", F.when(F.col("no") == 1, F.col("before.last_weight"))
                               .otherwise(F.lag("weight_kg").over(inside)))
                   .withColumn("delta_kg", F.col("weight_kg") - F.col("weight_kg_prev")))
        write(stepped.select("subject_id", "date", "week", "weight_kg", "weight_kg_prev", "delta_kg"), "rows")
        stepped = self._read("rows", ROWS, delivery).withColumn("seg", calendar_week())

        firsts = stepped.groupBy("subject_id").agg(F.min_by("delta_kg", "date").alias("delta_kg_next"))
        write(firsts.join(known.select("subject_id", F.col("last_date").alias("date")), "subject_id")
              .select("subject_id", "date", "delta_kg_next"), "after")
        write(self._chained(stepped, known), "state")

    def _chained(self, rows: DataFrame, known: DataFrame) -> DataFrame:
        """The stored states with those of the new segments behind them."""
        valid = Window.partitionBy("subject_id", "seg").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        w = F.col("weight_kg")
        i = F.when(w.isNotNull(), F.count(w).over(valid) - 1).cast("double")
        segments = (rows.withColumn("i", i).groupBy("subject_id", "seg").agg(
            F.max("date").alias("last_date"), F.max_by("weight_kg", "date").alias("last_weight"),
            F.min_by("weight_kg", F.when(w.isNotNull(), F.col("date"))).alias("baseline"),
            F.count(w).alias("n"), *[F.coalesce(F.sum(x), F.lit(0.0)).alias(n) for n, x in (
                ("si", F.col("i")), ("sw", w), ("siw", F.col("i") * w), ("sii", F.col("i") * F.col("i")))]).drop("seg"))
        pieces = known.unionByName(segments)
        earlier = Window.partitionBy("subject_id").orderBy("last_date").rowsBetween(Window.unboundedPreceding, -1)
        shift = F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("double")
        moved = pieces.withColumn("o", shift).select(
            "subject_id", "last_date", "last_weight", "baseline", "n",
            (F.col("si") + F.col("o") * F.col("n")).alias("si"), "sw", (F.col("siw") + F.col("o") * F.col("sw")).alias("siw"),
            (F.col("sii") + 2 * F.col("o") * F.col("si") + F.col("o") * F.col("o") * F.col("n")).alias("sii"))
        last = lambda c: F.max_by(c, "last_date").alias(c)
        return moved.groupBy("subject_id").agg(
            F.max("last_date").alias("last_date"), last("last_weight"),
            F.min_by("baseline", F.when(F.col("baseline").isNotNull(), F.col("last_date"))).alias("baseline"),
            F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in ("si", "sw", "siw", "sii")])

    def trajectories(self, deliveries: int, min_points: int = 3) -> DataFrame:
        """The step-delta table of all rows of the first ``deliveries`` deliveries."""
        upto = F.col("delivery") <= deliveries
        rows = self._read("rows", ROWS).where(upto).withColumn("seg", calendar_week())
        after = self._read("after", AFTER).where(upto).drop("delivery")
        inside = Window.partitionBy("subject_id", "delivery", "seg").orderBy("date")
        # the next step within a segment, from the subject's next segment of the delivery, or from a later one
        heads = rows.groupBy("subject_id", "delivery", "seg").agg(F.min_by("delta_kg", "date").alias("head"), F.min("date").alias("from"))
        over = Window.partitionBy("subject_id", "delivery").orderBy("from")
        heads = heads.withColumn("following", F.lead("head").over(over)).select("subject_id", "delivery", "seg", "following")
        state = self.state(deliveries)
        n = F.col("n").cast("double")
        slope = F.when((F.col("n") >= min_points), safe_div(n * F.col("siw") - F.col("si") * F.col("sw"),
                                                            n * F.col("sii") - F.col("si") * F.col("si")))
        facts = state.select("subject_id", F.col("baseline").alias("baseline_weight_kg"), slope.alias("weight_slope_kg_per_week"))
        out = (rows.withColumn("no", F.row_number().over(inside.orderBy(F.desc("date"))))
               .withColumn("delta_in", F.lead("delta_kg").over(inside))
               .join(heads, ["subject_id", "delivery", "seg"]).join(after, ["subject_id", "date"], "left").join(facts, "subject_id"))
        following = F.when(F.col("no") > 1, F.col("delta_in")).otherwise(F.coalesce("following", "delta_kg_next"))
        from_base = F.col("weight_kg") - F.col("baseline_weight_kg")
        return out.select(
            "subject_id", "date", "week", "weight_kg", "delta_kg",
            (safe_div(F.col("delta_kg"), F.col("weight_kg_prev")) * 100).alias("delta_kg_pct"), following.alias("delta_kg_next"),
            "baseline_weight_kg", from_base.alias("delta_from_baseline_kg"),
            (safe_div(from_base, F.col("baseline_weight_kg")) * 100).alias("delta_from_baseline_pct"), "weight_slope_kg_per_week")
