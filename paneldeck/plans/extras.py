"""Queries beyond the study's own: joins and frames over time, sessions, stores
kept up to date, margins, sketches and delivery differences."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from paneldeck.operators import diff, margins, semistructured, temporal
from paneldeck.operators.incremental import TrajectoryStore
from paneldeck.plans import bindings as B
from paneldeck.plans import oracle as O
from paneldeck.plans.catalog import WIDE_TRAJ_SCALES, _scratch, register
from paneldeck.plans.finalize import finalize
from paneldeck.session import cut_lineage, spread

# Moves exact decimal ties, which engines round either way, to one side.
OFF_TIE = 1e-9

KINDS = "event_id, user_id, ts, value FROM events WHERE event_type = "


def _events(spark, d):
    return B.read_table(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "value")


@register("q_asof_click", f"""SELECT p.event_id, p.user_id, CASE WHEN p.ts - c.ts <= INTERVAL 12 HOUR THEN c.event_id END AS click_id,
  CASE WHEN p.ts - c.ts <= INTERVAL 12 HOUR THEN {O.r('c.value', 4)} END AS click_value
FROM (SELECT {KINDS} 'purchase') p ASOF LEFT JOIN (SELECT {KINDS} 'click' AND ts IS NOT NULL) c
  ON p.user_id = c.user_id AND p.ts >= c.ts""")
def q_asof_click(spark, d):
    """As-of join with a tolerance: each purchase with the user's latest click of
    the 12 hours before it."""
    e = _events(spark, d)
    out = temporal.asof_join(e.where("event_type = 'purchase'").drop("event_type"), e.where("event_type = 'click'"), ["user_id"],
                             "ts", "ts", {"event_id": "click_id", "value": "click_value"}, order=["event_id"], tolerance=12 * 3600)
    return finalize(out.select("event_id", "user_id", "click_id", "click_value"), {"click_value": 4})


@register("q_asof_order_day", f"""SELECT s.l_orderkey, s.l_linenumber, s.o_custkey, o.day AS order_day, o.n_orders, {O.r('o.day_total', 2)} AS day_total
FROM (SELECT l_orderkey, l_linenumber, o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey) s
ASOF LEFT JOIN (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders, sum(o_totalprice) AS day_total
                FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2) o ON s.o_custkey = o.o_custkey AND s.l_shipdate >= o.day""")
def q_asof_order_day(spark, d):
    """As-of join: each shipment with the customer's latest order day up to it."""
    orders = B.read_table(spark, d, "orders")
    lines = B.read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    shipped = lines.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    days = (orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("day_total")))
    out = temporal.asof_join(shipped, days, ["o_custkey"], "l_shipdate", "day",
                             {"day": "order_day", "n_orders": "n_orders", "day_total": "day_total"}, segment=91 * 86_400)
    return finalize(out.drop("l_shipdate"), {"day_total": 2})


@register("q_exposure_windows", f"""SELECT w.event_id, w.user_id, count(*) AS n_events, {O.r('sum(e.value)', 4)} AS total
FROM events w JOIN events e ON e.user_id = w.user_id AND e.ts >= w.ts AND e.ts < w.ts + INTERVAL 36 HOUR
WHERE w.event_type = 'error' GROUP BY 1, 2""")
def q_exposure_windows(spark, d):
    """Interval join: the events within 36 hours from each error of the same user."""
    e = _events(spark, d)
    windows = e.where("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), "user_id", F.col("ts").alias("from_ts"), F.expr("ts + interval 36 hours").alias("to_ts"))
    pairs = temporal.interval_join(e.select("event_id", "user_id", "ts", "value"), windows, ["user_id"], "ts", ("from_ts", "to_ts"))
    out = pairs.groupBy(F.col("error_id").alias("event_id"), "user_id").agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total"))
    return finalize(out, {"total": 4})


SPANS = """SELECT o_custkey, o_orderdate AS s, l_shipdate AS t FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderdate < l_shipdate AND l_returnflag = """


@register("q_overlap_shipments", f"""SELECT a.o_custkey AS subject_id, count(*) AS n_pairs,
  CAST(sum(datediff('day', greatest(a.s, b.s), least(a.t, b.t))) AS BIGINT) AS shared_days
FROM ({SPANS} 'R') a JOIN ({SPANS} 'A') b ON a.o_custkey = b.o_custkey AND a.s < b.t AND b.s < a.t GROUP BY 1""")
def q_overlap_shipments(spark, d):
    """Overlap join: pairs of a returned and an accepted line of one customer that
    were under way at the same time, and for how many days."""
    lines = B.read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
    orders = B.read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # written once: the overlap join reads each side to count its bins and to pair it
    spans = cut_lineage(lines.where(F.col("l_returnflag").isin("R", "A")).join(orders, F.col("l_orderkey") == F.col("o_orderkey")))
    side = lambda flag, x: spans.where(F.col("l_returnflag") == flag).select(
        "o_custkey", F.col("l_orderkey").alias(f"key_{x}"), F.col("l_linenumber").alias(f"line_{x}"),
        F.col("o_orderdate").alias(f"s_{x}"), F.col("l_shipdate").alias(f"t_{x}"))
    pairs = temporal.overlap_join(side("R", "a"), side("A", "b"), ["o_custkey"], ("s_a", "t_a"), ("s_b", "t_b"), bin_seconds=30 * 86_400)
    return pairs.groupBy(F.col("o_custkey").alias("subject_id")).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.sum(F.datediff(F.least("t_a", "t_b"), F.greatest("s_a", "s_b"))).cast("long").alias("shared_days"))


def _rolling_sql(days: int) -> str:
    w = f"(PARTITION BY subject_id ORDER BY day RANGE BETWEEN {days - 1} PRECEDING AND CURRENT ROW)"
    return (f"count(v) OVER {w} AS d{days}_n, {O.r(f'avg(v) OVER {w} + {OFF_TIE}', 6)} AS d{days}_mean, "
            f"{O.r(f'regr_slope(v, CASE WHEN v IS NOT NULL THEN day END) OVER {w} + {OFF_TIE}', 6)} AS d{days}_slope")


@register("q_rolling_days", f"""WITH e AS (SELECT user_id AS subject_id, CAST(ts AS DATE) AS date,
    sum(CASE WHEN event_type <> 'error' THEN value END) AS v FROM events GROUP BY 1, 2),
n AS (SELECT *, CAST(date - DATE '1970-01-01' AS BIGINT) - 19000 AS day FROM e WHERE date IS NOT NULL)
SELECT subject_id, date, {_rolling_sql(7)}, {_rolling_sql(28)} FROM n""")
def q_rolling_days(spark, d):
    """Rolling calendar frames: count, mean and slope per day of the daily totals
    over the last 7 and 28 calendar days."""
    daily = B.events_clean(spark, d).where("date is not null").groupBy("subject_id", "date").agg(F.sum("value").alias("v"))
    out = temporal.rolling(daily, ["subject_id"], "date", "v", 7, "d7", segment_days=14)
    out = temporal.rolling(out, ["subject_id"], "date", "v", 28, "d28", segment_days=28)
    means = [f"d{n}_{c}" for n in (7, 28) for c in ("mean", "slope")]
    return finalize(out.drop("v").withColumns({c: F.col(c) + OFF_TIE for c in means}))


# Late by a whole delivery: every eleventh event.
DELIVERY = "CAST(least(3, floor(event_id * 4.0 / {n}) + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END) AS INTEGER)"


@register("q_sessions", f"""WITH e AS (SELECT *, {DELIVERY.format(n='(SELECT max(event_id) + 1 FROM events)')} AS delivery
  FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL),
h AS (SELECT delivery, max(max(ts)) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest
      FROM e GROUP BY delivery),
j AS (SELECT e.*, latest IS NOT NULL AND ts < latest - INTERVAL 1 DAY AS late FROM e JOIN h USING (delivery)),
s AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 3 HOUR THEN 0 ELSE 1 END AS first
      FROM j WHERE NOT late),
g AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM s)
SELECT 'session' AS kind, user_id, min(ts) AS start, max(ts) AS stop, count(*) AS n_events, {O.r('sum(value)', 4)} AS total
FROM g GROUP BY user_id, run
UNION ALL SELECT 'late', user_id, min(ts), max(ts), count(*), {O.r('sum(value)', 4)} FROM j WHERE late GROUP BY user_id""")
def q_sessions(spark, d):
    """Session windows with late data: the events arrive in four deliveries, some
    of them one delivery late; sessions end after three quiet hours, and what comes
    more than a day late is counted per user instead."""
    from paneldeck.streaming.sessions import late_rows, read_sessions, run_sessions
    base = _scratch(spark, "sessions")
    events = B.read_table(spark, d, "events")
    size = events.agg(F.max("event_id") + 1).first()[0]
    if size is None:
        empty = spark.createDataFrame([], "kind string, user_id long, start timestamp_ntz, stop timestamp_ntz, n_events long, total double")
        return empty
    delivery = F.expr(DELIVERY.format(n=f"CAST({size} AS DOUBLE)"))
    for k in range(4):
        events.where(delivery == k).write.mode("append").parquet(base + "/src")
        query = run_sessions(spark, base + "/src", base + "/sink", name=os.path.basename(base), gap=3 * 3600, lateness=86_400)
    last = max(p["batchId"] for p in query.recentProgress)
    sessions = read_sessions(spark, base + "/sink", last).select(F.lit("session").alias("kind"), "*")
    late = (late_rows(spark, base + "/sink").where("ts is not null and user_id is not null").groupBy("user_id")
            .agg(F.min("ts").alias("start"), F.max("ts").alias("stop"), F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total"))
            .select(F.lit("late").alias("kind"), "*"))
    out = sessions.unionByName(late)
    return finalize(out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "stop")}), {"total": 4})


STEP_COLS = ["weight_kg", "delta_kg", "delta_kg_pct", "delta_kg_next", "baseline_weight_kg", "delta_from_baseline_kg",
             "delta_from_baseline_pct", "weight_slope_kg_per_week"]


@register("q_step_delta_store", O.wide_base() + "SELECT subject_id, date, week, " + ", ".join(
    O.r(c, WIDE_TRAJ_SCALES.get(c, 6)) + f" AS {c}" for c in STEP_COLS) + " FROM traj_w")
def q_step_delta_store(spark, d):
    """The step-delta table from a store that got its history in three deliveries."""
    rows = cut_lineage(B.measures_wide(spark, d).select("subject_id", "date", "week", "weight_kg"))
    day = F.unix_date("date")
    low, high = rows.agg(F.min(day), F.max(day)).first()
    store = TrajectoryStore(spark)
    part = F.least(F.lit(2), F.floor((day - (low or 0)) * 3 / ((high or 0) - (low or 0) + 1)))
    for k in range(3):
        store.deliver(rows.where(part == k), k + 1)
    return finalize(store.trajectories(3), WIDE_TRAJ_SCALES)


def _lines(spark, d):
    lines = B.read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    orders = B.read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts, people = B.read_table(spark, d, "part").select("p_partkey", "p_type"), B.read_table(spark, d, "customer")
    week = F.floor(F.datediff(F.col("o_orderdate"), F.lit("1970-01-01").cast("date")) / 7).cast("long")
    return (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .join(people.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("p_type").alias("category"), week.alias("week"), F.col("c_mktsegment").alias("segment"),
                    F.col("o_custkey").alias("subject_id"), F.col("l_extendedprice").alias("price")))


LINES = """x AS (SELECT p_type AS category, CAST(floor(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) / 7.0) AS BIGINT) AS week,
  c_mktsegment AS segment, o_custkey AS subject_id, l_extendedprice AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey)"""
CUBE = ["category", "week", "segment"]


@register("q_cube_margins", f"""WITH {LINES} SELECT category, week, segment, CAST(grouping(category, week, segment) AS BIGINT) AS margin,
  count(*) AS n, count(price) AS n_value, {O.r('sum(price)', 2)} AS total, {O.r('min(price)', 2)} AS low, {O.r('max(price)', 2)} AS high,
  {O.r(f'avg(price) + {OFF_TIE}', 4)} AS mean FROM x GROUP BY CUBE (category, week, segment)""")
def q_cube_margins(spark, d):
    """Category x week x segment with all margins, from one set of partials."""
    out = margins.cube_margins(margins.partials(_lines(spark, d), CUBE, "price"), CUBE)
    return finalize(out.select(*CUBE, "margin", *[F.col(c).cast("long").alias(c) for c in ("n", "n_value")], "total", "low", "high", (F.col("mean") + OFF_TIE).alias("mean")),
                    {"total": 2, "low": 2, "high": 2, "mean": 4})


@register("q_sketch_ranges", f"""WITH {LINES}, y AS (SELECT *, CAST(floor(week / 13.0) AS BIGINT) AS quarter FROM x)
SELECT quarter, segment, count(*) AS n, count(DISTINCT subject_id) AS n_members, true AS members_close, true AS median_close, true AS p90_close
FROM y GROUP BY quarter, segment""")
def q_sketch_ranges(spark, d):
    """Distinct customers and price quantiles by quarter and segment, merged from
    sketches stored by week and segment, beside the exact counts: within 4 % for
    the number of customers and within 2 % of rank for the quantiles."""
    rows = _lines(spark, d)
    quarter = F.floor(F.col("week") / 13).cast("long").alias("quarter")
    stored = cut_lineage(margins.sketches(rows, ["week", "segment"], "subject_id", "price"))
    told = margins.merged_sketches(stored.withColumn("quarter", quarter), ["quarter", "segment"], [0.5, 0.9])
    below = lambda q: (F.count_if(F.col("price") < F.col(q)) / F.count("price"), F.count_if(F.col("price") <= F.col(q)) / F.count("price"))
    close = lambda q, p: ((below(q)[0] <= p + 0.02) & (below(q)[1] >= p - 0.02)).alias
    exact = (rows.withColumn("quarter", quarter).join(F.broadcast(told.select("quarter", "segment", F.col("n_members").alias("guess"), "q50", "q90")),
                                                      ["quarter", "segment"])
             .groupBy("quarter", "segment").agg(
                 F.count(F.lit(1)).alias("n"), F.count_distinct("subject_id").alias("n_members"), F.first("guess").alias("guess"),
                 close("q50", 0.5)("median_close"), close("q90", 0.9)("p90_close")))
    return exact.select("quarter", "segment", "n", "n_members",
                        (F.abs(F.col("guess") - F.col("n_members")) <= F.greatest(F.lit(1.0), 0.04 * F.col("n_members"))).alias("members_close"),
                        "median_close", "p90_close")


NEXT_ORDERS = """v1 AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders),
v2 AS (SELECT o_orderkey, o_custkey, o_totalprice + CASE WHEN o_orderkey % 10 = 1 THEN 1 ELSE 0 END AS o_totalprice FROM v1 WHERE o_orderkey % 10 <> 0
  UNION ALL SELECT * FROM v1 WHERE o_orderkey % 10 IN (2, 3)
  UNION ALL SELECT -1 - o_orderkey, o_custkey, o_totalprice FROM v1 WHERE o_orderkey % 10 = 4)"""


def _order_versions(spark, d):
    v1 = B.read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    digit = F.col("o_orderkey") % 10
    v2 = v1.where(digit != 0).withColumn("o_totalprice", F.col("o_totalprice") + F.when(digit == 1, 1).otherwise(0))
    return v1, (v2.unionByName(v1.where(digit.isin(2, 3)))
                .unionByName(v1.where(digit == 4).withColumn("o_orderkey", -1 - F.col("o_orderkey"))))


@register("q_delivery_changes", f"""WITH {NEXT_ORDERS},
c AS (SELECT o_orderkey, o_custkey, o_totalprice, sum(a) AS a, sum(b) AS b FROM (
  SELECT *, 1 AS a, 0 AS b FROM v1 UNION ALL SELECT *, 0, 1 FROM v2) GROUP BY ALL)
SELECT o_orderkey, CAST(sum(a) AS BIGINT) AS n_old, CAST(sum(b) AS BIGINT) AS n_new,
  CASE WHEN sum(a) = 0 THEN 'added' WHEN sum(b) = 0 THEN 'removed' WHEN bool_and(a = b) THEN 'same'
       WHEN bool_and((a > 0) = (b > 0)) THEN 'repeated' ELSE 'changed' END AS change
FROM c GROUP BY o_orderkey""")
def q_delivery_changes(spark, d):
    """Change classes by order between the orders and a second delivery of them."""
    return diff.change_classes(*_order_versions(spark, d), ["o_orderkey"])


@register("q_delivery_except", f"""WITH {NEXT_ORDERS}
SELECT 'gone' AS side, * FROM (SELECT * FROM v1 EXCEPT ALL SELECT * FROM v2)
UNION ALL SELECT 'new', * FROM (SELECT * FROM v2 EXCEPT ALL SELECT * FROM v1)
UNION ALL SELECT 'kept', * FROM (SELECT * FROM v1 INTERSECT ALL SELECT * FROM v2)""")
def q_delivery_except(spark, d):
    """EXCEPT ALL both ways and INTERSECT ALL of the two deliveries."""
    v1, v2 = _order_versions(spark, d)
    named = lambda df, side: df.select(F.lit(side).alias("side"), "*")
    return (named(diff.except_all(v1, v2), "gone").unionByName(named(diff.except_all(v2, v1), "new"))
            .unionByName(named(diff.intersect_all(v1, v2), "kept")))


# A nested JSON text for each event: some cut off, some missing, some of another shape.
MESSY_JSON = """CASE event_id % 40 WHEN 0 THEN '{"props": ' || CAST(user_id AS STRING) WHEN 1 THEN NULL
  WHEN 2 THEN '{"who": {"id": "n' || CAST(user_id AS STRING) || '"}, "props": null}'
  ELSE '{"who": {"id": ' || CAST(user_id AS STRING) || ', "tags": ["' || event_type || '", ' || CAST(event_id % 3 AS STRING)
    || ', ' || CAST(CAST(event_id % 7 AS DECIMAL(6, 2)) AS STRING) || ']}, "props": ' || props || '}' END"""
MESSY_CTE = f"""raws AS (SELECT event_id, {MESSY_JSON} AS raw FROM events),
docs AS (SELECT event_id, raw, CASE WHEN json_valid(raw) THEN CAST(raw AS JSON) END AS doc FROM raws)"""


def _messy(spark, d):
    return B.read_table(spark, d, "events").select("event_id", F.expr(MESSY_JSON).alias("raw"))


@register("q_json_paths", f"""WITH {MESSY_CTE}, found AS (
  SELECT '$' AS path, CASE WHEN raw IS NULL THEN 'missing' WHEN doc IS NULL THEN 'bad' ELSE json_type(doc) END AS t FROM docs
  UNION ALL SELECT '$.who', json_type(doc, '$.who') FROM docs
  UNION ALL SELECT '$.who.id', json_type(doc, '$.who.id') FROM docs
  UNION ALL SELECT '$.who.tags', json_type(doc, '$.who.tags') FROM docs
  UNION ALL SELECT '$.who.tags[*]', json_type(tag) FROM (SELECT unnest(json_extract(doc, '$.who.tags[*]')) AS tag FROM docs)
  UNION ALL SELECT '$.props', json_type(doc, '$.props') FROM docs
  UNION ALL SELECT '$.props.k', json_type(doc, '$.props.k') FROM docs)
SELECT path, CASE t WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number'
  WHEN 'VARCHAR' THEN 'string' ELSE lower(t) END AS kind, count(*) AS n
FROM found WHERE t IS NOT NULL GROUP BY 1, 2""")
def q_json_paths(spark, d):
    """Paths and kinds found in a JSON column, texts that do not parse counted."""
    return semistructured.path_table(spread(_messy(spark, d), "event_id"), "raw")


@register("q_json_shred", f"""WITH {MESSY_CTE}
SELECT event_id, TRY_CAST(doc ->> '$.who.id' AS BIGINT) AS who, doc ->> '$.who.tags[0]' AS tag,
  CAST(doc ->> '$.who.tags[2]' AS DOUBLE) AS weekday, CAST(doc ->> '$.props.k' AS BIGINT) AS k,
  CASE WHEN raw IS NULL THEN 'missing' WHEN doc IS NULL THEN 'bad' ELSE 'ok' END AS json_state,
  CASE WHEN event_id % 40 = 2 THEN 1 ELSE 0 END AS misfits
FROM docs""")
def q_json_shred(spark, d):
    """A JSON column as typed columns, with its state and misfits row by row."""
    return semistructured.shred(_messy(spark, d), "raw", {
        "who": ("$.who.id", "bigint"), "tag": ("$.who.tags[0]", "string"), "weekday": ("$.who.tags[2]", "double"),
        "k": ("$.props.k", "bigint")}).drop("raw")
