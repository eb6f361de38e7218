"""Trajectories, weekly rollups and alignment: cases ported from the studied
pipeline's week-alignment tests."""
import datetime as dt

import pytest

from paneldeck.operators import assemble, panel, rollup

MEAS = "subject_id string, metric string, phase string, week int, value double, tp_index long, note string"


def _traj(spark, rows):
    df = spark.createDataFrame(rows, MEAS)
    return panel.weight_trajectories_long(df)


def test_baseline_deltas(spark):
    rows = [("S1", "weight", "start", 0, 70.0, 0, None), ("S1", "weight", "end", 4, 68.5, 1, None),
            ("S1", "weight", "end", 8, 67.0, 2, None), ("S2", "weight", "start", 0, 85.0, 0, None),
            ("S2", "weight", "end", 4, 83.5, 1, None)]
    t = {(r["subject_id"], r["week"]): r for r in _traj(spark, rows).collect()}
    assert [t[("S1", w)]["delta_kg"] for w in (0, 4, 8)] == [0.0, -1.5, -3.0]
    assert [round(t[("S1", w)]["pct_change"], 2) for w in (0, 4, 8)] == [0.0, -2.14, -4.29]
    assert t[("S1", 8)]["start_weight"] == 70.0
    assert t[("S1", 0)]["slope_kg_per_week"] == pytest.approx(-0.375)
    # perfect fit: CI collapses onto the slope
    assert t[("S1", 0)]["slope_ci_lower"] == pytest.approx(-0.375)
    # two points: slope defined, CI not
    assert t[("S2", 0)]["slope_kg_per_week"] == pytest.approx(-0.375)
    assert t[("S2", 0)]["slope_ci_lower"] is None


def test_subject_without_baseline_dropped(spark):
    rows = [("S1", "weight", "end", 4, 68.5, 1, None), ("S2", "weight", "start", 0, 85.0, 0, None)]
    assert [r["subject_id"] for r in _traj(spark, rows).collect()] == ["S2"]


def test_slope_ci_matches_textbook(spark):
    import numpy as np
    from paneldeck.functions.dist import t_ppf
    w = [0, 2, 4, 8, 12]
    v = [80.0, 79.1, 78.9, 77.2, 76.8]
    rows = [("S1", "weight", "start" if x == 0 else "end", x, y, i, None) for i, (x, y) in enumerate(zip(w, v))]
    r = _traj(spark, rows).first()
    x, y = np.array(w, float), np.array(v)
    b, a = np.polyfit(x, y, 1)
    res = y - (a + b * x)
    se = np.sqrt(res @ res / 3 / ((x - x.mean()) ** 2).sum())
    tq = float(t_ppf(0.975, 3))
    assert r["slope_kg_per_week"] == pytest.approx(b)
    assert r["slope_ci_lower"] == pytest.approx(b - tq * se)
    assert r["slope_ci_upper"] == pytest.approx(b + tq * se)


def test_alignment_and_lead(spark):
    traj = spark.createDataFrame([("S1", 0, 0.0, 0), ("S1", 4, -1.5, 1), ("S1", 8, -3.0, 2)],
                                 "subject_id string, week int, delta_kg double, tp_index long")
    weekly = spark.createDataFrame([("S1", 0, 15.0), ("S1", 4, 20.0), ("S1", 8, 25.0)],
                                   "subject_id string, week_index int, fiber double")
    out = assemble.align_long(traj, weekly).orderBy("week").collect()
    assert len(out) == 3
    assert [r["delta_kg_next"] for r in out] == [-1.5, -3.0, None]
    assert [r["fiber"] for r in out] == [15.0, 20.0, 25.0]


def test_weekly_mean_share_any(spark):
    d0 = dt.date(2023, 1, 1)
    fib = [10, 12, 15, 8, 20, 18, 16, 22, 24, 19, 21, 25, 23, 20]
    beans = [1, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 1, 1, 0]
    daily = spark.createDataFrame([("S1", d0 + dt.timedelta(i), float(f), b) for i, (f, b) in enumerate(zip(fib, beans))],
                                  "subject_id string, date date, fiber_g_total double, kw_beans int")
    daily = rollup.add_week_index(daily)
    w = {r["week_index"]: r for r in rollup.weekly_rollup_long(daily, ["fiber_g_total"], ["kw_beans"], count_col=None).collect()}
    assert sorted(w) == [0, 1]
    assert w[0]["fiber_g_total_week_mean"] == pytest.approx(99 / 7)
    assert w[0]["share_of_days_kw_beans"] == pytest.approx(2 / 7)
    assert w[0]["any_kw_beans"] == 1
    assert w[1]["share_of_days_kw_beans"] == pytest.approx(3 / 7)


def test_left_join_keeps_gaps(spark):
    traj = spark.createDataFrame([("S1", 0, 0.0, 0), ("S1", 4, -1.0, 1), ("S1", 8, -2.0, 2)],
                                 "subject_id string, week int, delta_kg double, tp_index long")
    weekly = spark.createDataFrame([("S1", 4, 20.0)], "subject_id string, week_index int, fiber double")
    out = {r["week"]: r for r in assemble.align_long(traj, weekly).collect()}
    assert len(out) == 3 and out[0]["fiber"] is None and out[8]["fiber"] is None and out[4]["fiber"] == 20.0


def test_lead_does_not_cross_subjects(spark):
    traj = spark.createDataFrame([("S1", 0, 0.0, 0), ("S1", 4, -1.0, 1), ("S2", 0, 0.0, 0), ("S2", 4, -2.0, 1)],
                                 "subject_id string, week int, delta_kg double, tp_index long")
    out = {(r["subject_id"], r["week"]): r["delta_kg_next"] for r in assemble.align_long(traj, None).collect()}
    assert out[("S1", 4)] is None and out[("S2", 4)] is None
    assert out[("S1", 0)] == -1.0 and out[("S2", 0)] == -2.0


def test_empty_and_weight_only(spark):
    empty = spark.createDataFrame([], MEAS)
    assert panel.weight_trajectories_long(empty).count() == 0
    traj = spark.createDataFrame([("S1", 0, 0.0, 0)], "subject_id string, week int, delta_kg double, tp_index long")
    assert assemble.align_long(traj, None).count() == 1


def test_step_deltas_wide(spark):
    d0 = dt.date(2023, 1, 1)
    m = spark.createDataFrame([(1, d0 + dt.timedelta(7 * i), i + 1, w, None, None) for i, w in
                               enumerate([80.0, None, 79.0, 78.0, 77.5])],
                              "subject_id long, date date, week int, weight_kg double, energy_1_10 double, mood_1_10 double")
    out = panel.weight_trajectories_wide(m).orderBy("date").collect()
    assert [r["delta_kg"] for r in out] == [None, None, None, -1.0, -0.5]
    assert [r["delta_kg_next"] for r in out] == [None, None, -1.0, -0.5, None]
    assert out[0]["baseline_weight_kg"] == 80.0
    # slope over the index 0..3 of the four valid weights
    import numpy as np
    assert out[0]["weight_slope_kg_per_week"] == pytest.approx(np.polyfit([0, 1, 2, 3], [80, 79, 78, 77.5], 1)[0])


def test_segmented_lead_equals_plain_lead(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(3)
    rows = [(int(s), int(w), int(k), None if rng.random() < 0.1 else float(rng.normal()))
            for k, (s, w) in enumerate(zip(rng.integers(0, 4, 300), rng.integers(0, 12, 300)))]
    pdf = pd.DataFrame(rows, columns=["s", "w", "k", "v"]).sort_values(["s", "w", "k"])
    pdf["exp"] = pdf.groupby("s")["v"].shift(-1)
    df = spark.createDataFrame(rows, "s long, w int, k long, v double")
    got = {r["k"]: r["nxt"] for r in panel.segmented_lead(df, "s", "w", ["k"], "v", "nxt").collect()}
    for k, e in zip(pdf["k"], pdf["exp"]):
        assert (got[k] is None and pd.isna(e)) or got[k] == pytest.approx(e)


def test_demean_matches_pandas(spark):
    import pandas as pd
    pdf = pd.DataFrame({"s": [1, 1, 1, 2, 2], "x": [1.0, 2.0, 6.0, 5.0, None]})
    out = panel.demean(spark.createDataFrame(pdf), "s", ["x"]).orderBy("s", "x").collect()
    exp = (pdf["x"] - pdf.groupby("s")["x"].transform("mean")).tolist()
    got = {(r["s"], r["x"]): r["x_within"] for r in out}
    assert got[(1, 1.0)] == pytest.approx(exp[0]) and got[(1, 6.0)] == pytest.approx(exp[2])
    assert got[(2, 5.0)] == pytest.approx(0.0)
