"""What a task holds, and how often a value is worked out, must not grow with the input."""

import datetime as dt
import os

import pandas as pd
from pyspark.sql import functions as F

from paneldeck import session
from paneldeck.functions import clean as C
from paneldeck.functions.dictionaries import PART_KEYWORDS
from paneldeck.operators import keywords, panel, ranks, semistructured, temporal
from paneldeck.operators import sheets as S
from paneldeck.plans import bindings as B
from paneldeck.plans import catalog, extras
from paneldeck.plans import sheet_bindings as SB


def _plan(df, form="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), form)().toString()


def _tables(spark, folder):
    """Two customers: a plain order of two lines and an urgent one of one line."""
    day = lambda n: dt.datetime(2024, 1, n)
    tables = {
        "orders": ([(1, 7, "F", 10.0, day(2), "1-URGENT"), (2, 8, "O", 20.0, day(9), "5-LOW")],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                   "o_orderpriority string"),
        "lineitem": ([(1, 5, 1, 3.0, 9.5, 0.0, 0.07, "R", day(20)), (2, 5, 1, 4.0, 8.5, 0.0, 0.01, "A", day(21)),
                      (2, 6, 2, 5.0, 7.5, 0.0, 0.02, "R", day(22))],
                     "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp"),
        "part": ([(5, "a widget", "T", 3), (6, "a gear", "T", 4)], "p_partkey bigint, p_name string, p_type string, p_size int"),
        "events": ([(3, 1, day(1), "view", 1.0, '{"k": 5}')],
                   "event_id bigint, user_id bigint, ts timestamp, event_type string, value double, props string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_partitions_follow_the_input(spark, tmp_path):
    kept = {k: spark.conf.get(k, None) for k in (session.INITIAL_PARTITIONS, session.ADVISORY_BYTES)}
    try:
        with open(tmp_path / "big", "wb") as f:
            os.truncate(f.fileno(), 1000 * session.PARTITION_BYTES)  # takes no room
        session.apply_plan_conf(spark, str(tmp_path))
        assert int(spark.conf.get(session.INITIAL_PARTITIONS)) == 2000
        assert spark.conf.get(session.ADVISORY_BYTES) == f"{session.PARTITION_BYTES}b"
        spark.conf.set(session.ADVISORY_BYTES, "1m")  # the submitter's smaller one stays
        session.apply_plan_conf(spark, str(tmp_path))
        assert spark.conf.get(session.ADVISORY_BYTES) == f"{1 << 20}b"
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_segmented_lead_sorts_once_a_segment(spark):
    rows = spark.createDataFrame([(1, 1, 1, 5.0), (1, 1, 2, None), (1, 3, 1, 7.0), (2, None, 1, 1.0)],
                                 "s int, w int, k int, v double")
    out = panel.segmented_lead(rows, "s", "w", ["k"], "v", "nxt")
    assert "SortAggregate" not in _plan(out, "sparkPlan")
    assert {(r.s, r.w, r.k): r.nxt for r in out.collect()} == {
        (1, 1, 1): None, (1, 1, 2): 7.0, (1, 3, 1): None, (2, None, 1): None}


def test_row_statistics_are_hashed(spark):
    cells = spark.createDataFrame([("p", "s", 0, 0, "x"), ("p", "s", 0, 1, "x"), ("p", "s", 1, 0, "a"), ("p", "s", 1, 1, "b"),
                                   ("p", "s", 2, 0, None)], "source_path string, sheet_name string, row_no int, col_no int, value string")
    stats = S._row_stats(cells)
    assert "SortAggregate" not in _plan(stats, "sparkPlan")
    assert {r.row_no: r.differ for r in stats.collect()} == {0: False, 1: True, 2: None}


def test_packed_sheets_hold_the_same_cells(spark, tmp_path):
    d = _tables(spark, tmp_path / "t")
    cells = SB.food_log_cells(spark, d)
    assert _plan(cells).count("Join Inner") == 2  # one pass: no branch for the headers
    got = sorted(tuple(r) for r in cells.where("sheet_name = 'order_1'").collect())
    head = [("logs/customer_7.xlsx", "order_1", 1, i, v) for i, v in enumerate(SB.FOOD_HEADER)]
    data = ["45293", "a widget", "3 g", "~9", "7g/day", "7"]
    assert got == sorted([("logs/customer_7.xlsx", "order_1", 0, 0, "Daily food log"), *head,
                          *[("logs/customer_7.xlsx", "order_1", 2, i, v) for i, v in enumerate(data)]])
    assert cells.where("sheet_name = 'order_2'").count() == 18
    measures = sorted((r.row_no, r.col_no, r.value) for r in SB.label_cells(spark, d).where("source_path like '%_8.xlsx'").collect())
    assert measures == [(0, 0, "Label"), (0, 1, "Timepoint 1"), (1, 0, "Subject ID"), (1, 1, "8"), (2, 0, "Starting Weight"),
                        (2, 1, "20.0"), (3, 0, "Starting Energy"), (3, 1, "1"), (4, 0, "Starting Mood"), (4, 1, "0")]
    std = {(r.sheet_name, r.row_no): (r.food, r.subject_id) for r in catalog.q_standardize(spark, d).collect()}
    assert std == {("order_1", 2): ("a widget", "7"), ("order_2", 1): ("a widget", "8"), ("order_2", 2): ("a gear", None)}


def test_dates_try_only_patterns_that_can_match(spark, tmp_path):
    texts = ["2023-05-07", "2023-05-07T10:00", "2023-05-07t10:00:00Z", "5/7/2023 10:00:01", "5/7/23", "2023/5/7", "5-7-2023",
             "May 7, 2023", "may 7 2023", "7 May 2023", "7-May-2023"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", C.parse_text_date("t").alias("now"), F.coalesce(*[F.try_to_timestamp("t", F.lit(p)) for p in C.DATE_PATTERNS])
        .cast("date").alias("all")).collect()
    assert all(r.now == r["all"] for r in got) and [r.now for r in got].count(dt.date(2023, 5, 7)) >= 9
    assert C._fixed_characters("yyyy-MM-dd'T'HH:mm") == "%-%-%t%:%"
    d = _tables(spark, tmp_path / "t")
    assert catalog.q_serial_date(spark, d).rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism


def test_numbers_are_cast_only_from_their_forms(spark):
    texts = ["1", "-1.5", "+.5", "5.", "1e5", "1E-5", "1d", "2.5F", "0x1p3", "NaN", "-Infinity", "inf", " 7 ", "7\t\n", "", ".", "e5", "3 g",
             "2024-01-05", "7g/day", "~9", "1e", "--1", "text", "0x", "1_0", "1,0", None, "1" * 400, "infinit", "+nan", "\u00a07"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", C.to_double("t").alias("now"), F.col("t").try_cast("double").alias("all"), F.col("t").rlike(C.NUMBER_FORM).alias("tried"))
    for r in got.collect():
        assert str(r.now) == str(r["all"]), r
        assert not (r.tried and r.t in ("3 g", "2024-01-05", "7g/day", "~9", "text")), r


def test_json_is_parsed_once_a_level(spark):
    rows = spark.createDataFrame([('{"a": 1}',)], "raw string")
    made = semistructured.once(rows, value=F.try_parse_json("raw"))
    assert _plan(made.where("value is not null").select("value", F.schema_of_variant("value"))).count("parse_json") <= 1
    kind = _plan(rows.select(semistructured.kind_of(F.try_parse_json("raw"))))
    assert kind.count("schema_of_variant") <= 1


def test_overlap_reads_its_spans_from_a_stage(spark, tmp_path):
    d = _tables(spark, tmp_path / "t")
    out = extras.q_overlap_shipments(spark, d)
    assert all("paneldeck-stages" in f for f in out.inputFiles())
    assert [tuple(r) for r in out.collect()] == [(8, 1, 12)]


def test_rank_buckets_follow_the_input(spark, monkeypatch):
    kept, real, cuts = spark.conf.get(session.INITIAL_PARTITIONS, None), ranks.value_rank_table, []
    monkeypatch.setattr(ranks, "value_rank_table", lambda *a, **k: cuts.append(k["cuts"]) or real(*a, **k))
    rows = pd.DataFrame({"x": [float(i * 37 % 1009 % 700) for i in range(1000)], "y": [float(i * i % 997) for i in range(1000)]})
    count = max(40, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        spark.conf.set(session.INITIAL_PARTITIONS, str(count))
        got = ranks.spearman(spark.createDataFrame(rows), "x", "y").first()
    finally:
        spark.conf.unset(session.INITIAL_PARTITIONS) if kept is None else spark.conf.set(session.INITIAL_PARTITIONS, kept)
    assert [len(set(c)) > 0.9 * count for c in cuts] == [True, True]  # before: as many as the submitter's partitions
    assert got.n == 1000 and abs(got.rho - rows["x"].rank().corr(rows["y"].rank())) < 1e-9


def _with(spark, conf, made):
    """``made()`` under other settings of the session."""
    kept = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return made()
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_table_is_not_broadcast_for_its_file_size(spark, tmp_path):
    d = _tables(spark, tmp_path / "t")
    stored = sum(n for _, n, _ in session.input_listing(spark, f"{d}/part.parquet"))
    plan = lambda limit: _with(spark, {"spark.sql.autoBroadcastJoinThreshold": str(limit)}, lambda: _plan(
        B.food_rows(spark, d).select("subject_id", "food", "fat_g"), "sparkPlan"))
    assert plan(100 * stored).count("BroadcastHashJoin") == 2  # small as rows, too
    few = plan(4 * stored)  # the file fits, its rows may not
    assert few.count("SortMergeJoin") >= 1 and few.count("BroadcastHashJoin") <= 1
    assert plan(-1).count("SortMergeJoin") == 2


def test_daily_flags_match_each_part_once_and_group_by_order(spark, tmp_path):
    d = _tables(spark, tmp_path / "t")
    made = lambda: keywords.daily_totals_and_flags(B.food_rows(spark, d, bits=True), ["subject_id", "date"], B.NUTRIENTS, "food",
                                                   PART_KEYWORDS, bits="kw_bits")
    plan = _with(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}, lambda: _plan(made(), "sparkPlan"))
    assert "l_orderkey" in plan.split("SortMergeJoin")[1][:60]  # the last join: a day's lines meet before they are summed
    assert "p_name" not in plan.split("SortMergeJoin")[1]  # matched below the joins
    got = {r.subject_id: (r.n_entries, r.kw_widget, r.kw_gear) for r in made().collect()}
    assert got == {7: (1, 1, 0), 8: (2, 1, 1)}
    rows = spark.createDataFrame([(1, "d", "Old Widget", 1.0), (1, "d", None, 2.0), (2, "d", None, None), (None, "d", "gear", 1.0)],
                                 "s int, t string, food string, v double")
    flags = keywords.daily_totals_and_flags(rows, ["s", "t"], {"v": "v_total"}, "food", PART_KEYWORDS)
    assert {r.s: (r.v_total, r.n_entries, r.kw_widget, r.kw_age, r.kw_gear) for r in flags.collect()} == {1: (3.0, 2, 1, 1, 0), 2: (0.0, 1, 0, 0, 0)}
    assert flags.schema["kw_age"].dataType.simpleString() == "int"


def test_sheets_are_shuffled_once_before_they_have_cells(spark, tmp_path):
    d = _tables(spark, tmp_path / "t")
    no_broadcast = {"spark.sql.autoBroadcastJoinThreshold": "-1"}

    def plans():
        cells, hr, h = catalog._sheet_stage(spark, d)
        rows = SB.food_log_rows(spark, d, 4)
        return [_plan(x, "executedPlan") for x in (S.label_sheets(cells, hr), S.nutrition_sheets(h), S.normalized_headers(cells, hr),
                                                   catalog._cells_of(spark, d, h.select(*S.SHEET)), S.resolve_columns(h),
                                                   S.choose_header_row(SB.unpack(rows)))]
    *later, dealt = _with(spark, no_broadcast, plans)
    assert [p.count("Exchange") for p in later] == [0] * 5
    by_sheet = next(x for x in dealt.splitlines() if "REPARTITION_BY_NUM" in x)
    assert dealt.count("REPARTITION_BY_NUM") == 1 and "Dietary Fiber" not in dealt[dealt.index(by_sheet):]
    cells, hr, h = catalog._sheet_stage(spark, d)
    books = spark.createDataFrame([("logs/customer_8.xlsx", "book")], "source_path string, workbook_subject_id string")
    std = S.standardize_nutrition(cells, hr, S.resolve_columns(h), books)
    plan = _with(spark, {**no_broadcast, "spark.sql.shuffle.partitions": "4", session.INITIAL_PARTITIONS: "4"}, lambda: _plan(std, "sparkPlan"))
    assert "LeftOuter" not in "".join(x for x in plan.splitlines() if "Join [source_path" in x and "sheet_name" not in x)  # by sheet
    assert {(r.sheet_name, r.row_no): r.subject_id for r in std.where("sheet_name <> 'measures'").collect()} == {
        ("order_1", 2): "7", ("order_2", 1): "8", ("order_2", 2): "book"}
    kinds = {(r.sheet_name, r.is_nutrition, r.is_label) for r in catalog.q_sheet_kind(spark, d).collect()}
    assert {k for k in kinds if k[0] != "measures"} == {("order_1", True, False), ("order_2", True, False)}


def test_overlap_copies_spans_to_bins_only_where_they_lie(spark):
    hour = lambda n: dt.datetime(1970, 1, 1) + dt.timedelta(hours=n)
    left = [(i % 2, i, hour(i * 7 - 90), hour(i * 7 - 90 + i * 5)) for i in range(30)]
    right = [(i % 2, i, hour(i * 11 - 130), hour(i * 11 - 130 + 3 + i * 2)) for i in range(30)]
    a = spark.createDataFrame(left, "k int, a int, s_a timestamp_ntz, t_a timestamp_ntz")
    b = spark.createDataFrame(right, "k int, b int, s_b timestamp_ntz, t_b timestamp_ntz")
    for most in (2, 1000):
        out = temporal.overlap_join(a, b, ["k"], ("s_a", "t_a"), ("s_b", "t_b"), 3600, most)
        want = {(x[1], y[1]) for x in left for y in right if x[0] == y[0] and x[2] < y[3] and y[2] < x[3] and x[2] < x[3]}
        got = [(r.a, r.b) for r in out.collect()]
        assert len(got) == len(want) and set(got) == want
    plan = _plan(out, "sparkPlan")
    side = plan[plan.index("SortMergeJoin"):] if "SortMergeJoin" in plan else plan
    assert 0 < side.index("[_bin#") < side.index("REPARTITION_BY_NUM")
