"""What "subject", "date", "food" and "weight" mean on the driver tables.

Long dialect (string-free, bigint subjects) — the orders panel:
  * food rows   = lineitem ⋈ orders ⋈ part; subject = o_custkey,
    date = o_orderdate, food = p_name, nutrients from line amounts
  * daily       = A1 rollup of the food rows
  * measures    = one 'weight' measurement per order (o_totalprice), week
    counted from the subject's first food date (external origin, Q7 fix),
    phase 'start' at week <= 0 else 'end', tp_index = o_orderkey
Wide dialect — the events panel:
  * measures    = per (user, day): weight = avg purchase value, energy = avg
    click value, mood = avg view value; error events carry a NULL value
  * daily       = per (user, day): calories = sum of values, fiber = sum of
    click values; week is 1-based from the user's first day
  * food rows   = the long food rows, week 1-based from the first food date
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneldeck.functions.clean import week_index
from paneldeck.functions.dictionaries import PART_KEYWORDS
from paneldeck.operators import keywords, rollup
from paneldeck.sources.tables import join_side, read_table

NUTRIENTS = {
    "fiber_g": "fiber_g_total",
    "calories_kcal": "calories_kcal_total",
    "carb_g": "carb_g_total",
    "protein_g": "protein_g_total",
    "fat_g": "fat_g_total",
}
DAILY_NUTRIENTS = list(NUTRIENTS.values())
PART_CATEGORIES = list(PART_KEYWORDS)
KW_FLAGS = [f"kw_{c}" for c in PART_CATEGORIES]
# the two categories used as model predictors (beans / potato in the study)
MODEL_KW = ("widget", "gear")


def food_rows(spark: SparkSession, d: str, bits: bool = False) -> DataFrame:
    """Lines with their part and order.  Orders are joined last, so that an order's
    lines lie together and a day's totals are summed before they are shuffled.
    ``bits``: with the column ``kw_bits``, matched once for each part."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                                 "l_extendedprice", "l_discount", "l_tax")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = read_table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_size")
    if bits:
        p = p.withColumn("kw_bits", keywords.match_bits(F.col("p_name"), PART_KEYWORDS))
    j = li.join(join_side(p, d, "part"), F.col("l_partkey") == F.col("p_partkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("p_name").alias("food"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").alias("fiber_g"),
        F.col("l_extendedprice").alias("calories_kcal"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("carb_g"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("protein_g"),
        F.col("p_size").cast("double").alias("fat_g"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_no"),
        *(["kw_bits"] if bits else []),
    )


def daily_long(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    rows = rows if rows is not None else food_rows(spark, d)
    return rollup.daily_rollup(rows, NUTRIENTS)


def measures_long(spark: SparkSession, d: str, daily: DataFrame | None = None) -> DataFrame:
    daily = daily if daily is not None else daily_long(spark, d)
    origin = rollup.subject_origin(daily)
    o = read_table(spark, d, "orders").select(
        F.col("o_custkey").alias("subject_id"), F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("tp_index"))
    m = o.join(origin, "subject_id", "inner").withColumn("week", week_index(F.col("date"), F.col("origin_date")))
    return m.select(
        "subject_id", F.lit("weight").alias("metric"),
        F.when(F.col("week") <= 0, F.lit("start")).otherwise(F.lit("end")).alias("phase"),
        "week", "value", "tp_index", F.lit(None).cast("string").alias("note"), "date")


def events_clean(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events").select("user_id", "ts", "event_type", "value")
    return e.select(
        F.col("user_id").alias("subject_id"), F.col("ts").cast("date").alias("date"), "event_type",
        F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value")).alias("value"))


def measures_wide(spark: SparkSession, d: str) -> DataFrame:
    e = events_clean(spark, d)
    g = e.groupBy("subject_id", "date").agg(
        F.avg(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("weight_kg"),
        F.avg(F.when(F.col("event_type") == "click", F.col("value"))).alias("energy_1_10"),
        F.avg(F.when(F.col("event_type") == "view", F.col("value"))).alias("mood_1_10"),
    )
    return rollup.add_week_index(g, out="week", one_based=True)


def daily_wide(spark: SparkSession, d: str) -> DataFrame:
    e = events_clean(spark, d)
    g = e.groupBy("subject_id", "date").agg(
        F.sum("value").alias("total_calories"),
        F.sum(F.when(F.col("event_type") == "click", F.col("value"))).alias("total_fiber_g"),
    )
    return rollup.add_week_index(g, out="week", one_based=True)


def food_rows_wide(spark: SparkSession, d: str, origin: DataFrame | None = None) -> DataFrame:
    """Food rows with their 1-based week.  ``origin``: first date per subject, one
    small row each; the raw rows are joined with it, not ordered by subject."""
    r = food_rows(spark, d).select("subject_id", "date", F.col("food").alias("food_item"), "category",
                                   F.col("calories_kcal").alias("calories"), F.col("fiber_g"))
    origin = rollup.subject_origin(daily_long(spark, d)) if origin is None else origin
    return rollup.add_week_index(r, out="week", one_based=True, origin=origin)
