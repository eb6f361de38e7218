"""As-of, interval and overlap joins, rolling frames, sessions, the trajectory
store, margins, sketches and delivery differences against brute force."""

import datetime as dt
import json
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paneldeck.operators import diff, margins, semistructured, temporal
from paneldeck.operators.incremental import TrajectoryStore
from paneldeck.operators.panel import weight_trajectories_wide
from paneldeck.session import stage_path

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)



@pytest.mark.parametrize("tolerance", [None, 600])
def test_asof_join_equals_brute_force(spark, tolerance):
    """A hot key with most rows, ties, nulls, far gaps between segments."""
    rng = random.Random(1)
    key = lambda: rng.choice([1, 1, 1, 1, 2, 3, None])
    left = [(i, key(), rng.choice([None, *range(0, 9000, 7)])) for i in range(300)]
    right = [(i, key(), rng.choice([None, *range(0, 9000, 35)])) for i in range(200)]
    a = spark.createDataFrame([(i, k, at(m)) for i, k, m in left], "id long, k long, ts timestamp_ntz")
    b = spark.createDataFrame([(i, k, at(m)) for i, k, m in right], "id long, k long, ts timestamp_ntz")
    out = temporal.asof_join(a, b, ["k"], "ts", "ts", {"id": "found"}, order=["id"], tolerance=tolerance, segment=3600)
    want = {}
    for i, k, m in left:
        known = [(n, j) for j, q, n in right if None not in (q, k, n, m) and q == k and n <= m]
        n, j = max(known, default=(None, None))
        want[i] = j if n is not None and (tolerance is None or (m - n) * 60 <= tolerance) else None
    assert {r.id: r.found for r in out.collect()} == want
    assert out.columns == ["id", "k", "ts", "found"]
    assert temporal.asof_join(a.limit(0), b, ["k"], "ts", "ts", {"id": "found"}).count() == 0
    assert temporal.asof_join(a, b.limit(0), ["k"], "ts", "ts", {"id": "found"}).where("found is not null").count() == 0


def test_asof_join_orders_no_raw_rows_of_a_whole_key(spark):
    e = spark.range(2000).select(F.lit(1).alias("k"), F.col("id"), F.timestamp_seconds(F.col("id") * 600).alias("ts"))
    out = temporal.asof_join(e, e, ["k"], "ts", "ts", {"id": "found"}, order=["id"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("_segment" in line.split("], [")[1] for line in windows) == 1
    assert out.where("found = id").count() == 2000


def test_overlap_and_interval_join_equal_brute_force(spark):
    rng = random.Random(2)
    def spans(n):
        out = []
        for i in range(n):
            s = rng.choice([None, *range(0, 3000, 11)])
            out.append((i, rng.choice([1, 1, 1, 2, None]), s, None if s is None else s + rng.choice([-5, 0, 1, 30, 700])))
        return out
    left, right = spans(150), spans(120)
    frame = lambda rows, x: spark.createDataFrame([(i, k, at(s), at(t)) for i, k, s, t in rows],
                                                  f"{x} long, k long, s_{x} timestamp_ntz, t_{x} timestamp_ntz")
    a, b = frame(left, "a"), frame(right, "b")
    ok = lambda k, s, t: None not in (k, s, t) and s < t
    want = sorted((i, j) for i, k, s, t in left for j, q, u, v in right
                  if k == q and ok(k, s, t) and ok(q, u, v) and s < v and u < t)
    for most in (50_000, 3):  # small bins are split
        out = temporal.overlap_join(a, b, ["k"], ("s_a", "t_a"), ("s_b", "t_b"), 3600, most)
        assert sorted((r.a, r.b) for r in out.collect()) == want
    points = temporal.interval_join(a.drop("t_a"), b, ["k"], "s_a", ("s_b", "t_b"), 3600, 3)
    held = sorted((i, j) for i, k, s, _ in left for j, q, u, v in right
                  if k == q and None not in (k, s) and ok(q, u, v) and u <= s < v)
    assert sorted((r.a, r.b) for r in points.collect()) == held
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_rolling_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2]), rng.choice([None, *range(60)]), rng.choice([None, 1.5, 2.0, 9.25])) for _ in range(200)]
    day = lambda n: None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)
    df = spark.createDataFrame([(k, day(n), v) for k, n, v in rows], "k long, day date, v double")
    out = temporal.rolling(df, ["k"], "day", "v", 7, "r", segment_days=10).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.day is None:
            assert r.r_n is None and r.r_mean is None
            continue
        n = (r.day - dt.date(2024, 1, 1)).days
        seen = [(m, v) for k, m, v in rows if k == r.k and m is not None and n - 7 < m <= n and v is not None]
        assert r.r_n == len(seen)
        assert (r.r_mean is None) == (not seen) and (not seen or abs(r.r_mean - sum(v for _, v in seen) / len(seen)) < 1e-9)
        x = [m for m, _ in seen]
        if len(set(x)) > 1:
            mx, my = sum(x) / len(x), sum(v for _, v in seen) / len(x)
            slope = sum((m - mx) * (v - my) for m, v in seen) / sum((m - mx) ** 2 for m in x)
            assert abs(r.r_slope - slope) < 1e-9
        else:
            assert r.r_slope is None


def brute_sessions(batches, gap, lateness):
    latest, on_time, late = None, [], []
    for rows in batches:
        for i, u, m in rows:
            (late if None in (u, m) or latest is not None and m < latest - lateness else on_time).append((i, u, m))
        latest = max([m for _, _, m in rows if m is not None] + ([] if latest is None else [latest]), default=None)
    out = []
    for u in {u for _, u, _ in on_time}:
        run = []
        for m in sorted(m for _, q, m in on_time if q == u):
            if run and m - run[-1] > gap:
                out.append((u, run[0], run[-1], len(run)))
                run = []
            run.append(m)
        out.append((u, run[0], run[-1], len(run)))
    return sorted(out), sorted(i for i, _, _ in late)


def test_sessions_with_late_rows(spark):
    """Out-of-order files: closed and open sessions, late rows, and a state that does not grow."""
    from paneldeck.streaming.sessions import late_rows, read_sessions, run_sessions
    rng = random.Random(4)
    batches, number = [], 0
    for k in range(3):
        rows = []
        for _ in range(150):
            m = rng.choice([None] + [k * 1000 + rng.randint(-200, 1000) for _ in range(40)])
            rows.append((number, rng.choice([1, 1, 1, 2, 3, None]), m))
            number += 1
        batches.append(rows)
    base, held = stage_path(spark, "sessions-test"), []
    for rows in batches:
        df = spark.createDataFrame([(i, at(m), u, "x", 1.0, None) for i, u, m in rows],
                                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
        df.write.mode("append").parquet(base + "/src")
        q = run_sessions(spark, base + "/src", base + "/sink", name="sessions-" + base[-12:], gap=30 * 60, lateness=60 * 60, segment=3600)
        last = max(p["batchId"] for p in q.recentProgress)
        held.append(spark.read.parquet(f"{base}/sink/open/batch={last}").count())
    minutes = lambda t: int((t - T0).total_seconds() // 60)
    got = sorted((r.user_id, minutes(r.start), minutes(r.stop), r.n_events) for r in read_sessions(spark, base + "/sink", last).collect())
    sessions, late = brute_sessions(batches, 30, 60)
    assert got == sessions and sorted(r.event_id for r in late_rows(spark, base + "/sink").collect()) == late
    assert len(late) > 20 and max(held) < len(sessions) / 3


@pytest.mark.parametrize("cuts", [[40], [7, 20, 55], list(range(5, 80, 5))])
def test_any_split_into_deliveries_gives_the_whole_table(spark, cuts):
    rng = random.Random(len(cuts))
    rows = [(s, n, rng.choice([None, float("nan"), 70.0, 70.5, 71.25, 0.0])) for s in (1, 2, 3) for n in range(80) if rng.random() < 0.6 or s == 1]
    rows += [(4, 3, None), (4, 50, 66.0)]
    day = F.expr("date_add(date'2024-01-01', cast(n as int))")
    df = spark.createDataFrame(rows, "subject_id long, n long, weight_kg double").select(
        "subject_id", day.alias("date"), (F.floor(F.col("n") / 7) + 1).cast("int").alias("week"), "weight_kg", "n")
    store = TrajectoryStore(spark)
    for k, (low, high) in enumerate(zip([0, *cuts], [*cuts, 80]), 1):
        part = df.where((F.col("n") >= low) & (F.col("n") < high)).drop("n")
        store.deliver(part, k)
        if k == 2:
            store.deliver(part, k)  # a repeated delivery changes nothing
    want = weight_trajectories_wide(df.drop("n"))
    got = TrajectoryStore(spark, store.path).trajectories(len(cuts) + 1)  # reopened
    keyed = lambda d: {(r.subject_id, r.date): r.asDict() for r in d.collect()}
    a, b = keyed(got), keyed(want)
    assert a.keys() == b.keys()
    for k in b:
        for c, v in a[k].items():
            w = b[k][c]
            assert (v is None) == (w is None) and (v is None or not isinstance(v, float) or abs(v - w) < 1e-9), (k, c, v, w)


def test_rows_that_come_after_their_time_are_kept_apart(spark):
    schema = "subject_id long, date date, week int, weight_kg double"
    store = TrajectoryStore(spark)
    d = lambda n: dt.date(2024, 1, n)
    store.deliver(spark.createDataFrame([(1, d(5), 1, 70.0)], schema), 1)
    store.deliver(spark.createDataFrame([(1, d(5), 1, 60.0), (1, d(4), 1, 61.0), (None, d(9), 1, 5.0), (1, None, 1, 5.0), (1, d(6), 1, 71.0)], schema), 2)
    assert store.trajectories(2).count() == 2 and store._read("late", "subject_id long", 2).count() == 4
    assert store.trajectories(2).where("date = '2024-01-06'").first().delta_kg == 1.0


def test_margins_come_from_partials_alone(spark):
    rows = spark.createDataFrame([("a", 1, "x", 2.0), ("a", 1, "x", None), ("a", 2, None, 4.0), (None, 2, "y", 8.0)], "c string, w long, s string, v double")
    parts = margins.partials(rows, ["c", "w", "s"], "v")
    out = margins.cube_margins(parts, ["c", "w", "s"])
    want = {tuple(r) for r in rows.cube("c", "w", "s").agg(F.grouping_id(), F.count(F.lit(1)), F.count("v"), F.sum("v"), F.min("v"), F.max("v"), F.avg("v")).collect()}
    assert {tuple(r) for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.index("sum(v"), "the raw rows are grouped below the expansion"


def test_sketches_merge_within_their_bounds(spark):
    rows = spark.range(60_000).select((F.col("id") % 12).alias("week"), (F.hash("id") % 5000).alias("m"), F.pow(F.rand(3), 2.0).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(99, None, None)], "week long, m int, v double"))
    rows.cache()
    stored = margins.sketches(rows, ["week"], "m", "v")
    one = margins.merged_sketches(stored.withColumn("half", F.col("week") < 6), ["half"], [0.1, 0.5, 0.9])
    for r in one.collect():
        own = rows.where((F.col("week") < 6) == r.half)
        exact = own.agg(F.count_distinct("m")).first()[0]
        assert abs(r.n_members - exact) <= 4 * 0.0082 * exact and r.n == own.count()
        for p, q in ((0.1, r.q10), (0.5, r.q50), (0.9, r.q90)):
            assert abs(own.where(F.col("v") <= q).count() / own.count() - p) < 0.02
    empty = margins.merged_sketches(margins.sketches(rows.where("week = 99"), ["week"], "m", "v"), ["week"], [0.5]).first()
    assert empty.n_members == 0 and empty.q50 is None


def test_delivery_differences_count_repeats(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None), (4, "d"), (None, "n"), (6, "f"), (6, "g")], "k long, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (5, "e"), (None, "n"), (6, "g"), (6, "f")], "k long, v string")
    rows = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert rows(diff.except_all(old, new)) == rows(old.exceptAll(new))
    assert rows(diff.except_all(new, old)) == rows(new.exceptAll(old))
    assert rows(diff.intersect_all(old, new)) == rows(old.intersectAll(new))
    out = {r.k: (r.n_old, r.n_new, r.change) for r in diff.change_classes(old, new, ["k"]).collect()}
    assert out == {1: (2, 1, "repeated"), 2: (1, 1, "changed"), 3: (1, 1, "same"), 4: (1, 0, "removed"), 5: (0, 1, "added"),
                   None: (1, 1, "same"), 6: (2, 2, "same")}
    assert diff.change_classes(old.limit(0), new.limit(0), ["k"]).count() == 0


def test_path_table_equals_a_walk_of_the_parsed_texts(spark):
    rng = random.Random(5)

    def made(depth):
        pick = rng.randrange(9 if depth else 7)
        if pick == 7:
            return {rng.choice(["a", "b", "a b", "x.y"]): made(depth - 1) for _ in range(rng.randrange(4))}
        if pick == 8:
            return [made(depth - 1) for _ in range(rng.randrange(4))]
        return [None, True, rng.randrange(10**12), -3, 2.5, "", "text"][pick]

    texts = [json.dumps({"a": made(3), "c": made(2)}) for _ in range(200)]
    texts += [None, None, "", "{", '{"a": 1, "a": 2}', "[]", "7", "null"] + ['{"a": {"b": 1}}'] * 300  # a hot text
    want = Counter()

    def walk(path, value):
        kinds = {type(None): "null", bool: "boolean", int: "integer", float: "number", str: "string", dict: "object", list: "array"}
        want[path, kinds[type(value)]] += 1
        if isinstance(value, dict):
            for key, inner in value.items():
                walk(path + ("." + key if re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", key) else f"['{key}']"), inner)
        elif isinstance(value, list):
            for inner in value:
                walk(path + "[*]", inner)

    for text in texts:
        if text is None:
            want["$", "missing"] += 1
        elif text in ("", "{", '{"a": 1, "a": 2}'):
            want["$", "bad"] += 1
        else:
            walk("$", json.loads(text))
    rows = spark.createDataFrame([(t, "x") for t in texts], "raw string, value string")
    assert {(r.path, r.kind): r.n for r in semistructured.path_table(rows, "raw").collect()} == dict(want)
    assert semistructured.path_table(rows.limit(0), "raw").count() == 0


def test_shred_keeps_every_row_and_counts_what_does_not_fit(spark):
    rows = spark.createDataFrame([(1, '{"a": {"n": 5}, "s": "x"}'), (2, '{"a": {"n": "no"}, "s": null}'), (3, None),
                                  (4, "{"), (5, '{"a": 1}'), (5, '{"a": 1}'), (6, "")], "id long, raw string")
    out = semistructured.shred(rows, "raw", {"n": ("$.a.n", "bigint"), "s": ("$.s", "string")})
    assert sorted((r.id, r.n, r.s, r.json_state, r.misfits) for r in out.collect()) == [
        (1, 5, "x", "ok", 0), (2, None, None, "ok", 1), (3, None, None, "missing", 0), (4, None, None, "bad", 0),
        (5, None, None, "ok", 0), (5, None, None, "ok", 0), (6, None, None, "bad", 0)]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        semistructured.shred(rows, "raw", {"ID": ("$.a", "string")})
