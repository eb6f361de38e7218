"""Cleaning / parsing expressions: vectors ported from the studied ingest's self-tests."""
import datetime as dt

from pyspark.sql import functions as F

from paneldeck.functions import clean as C


def _col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_parse_number(spark):
    vals = ["12 g", "~8.5", "3,221", "5g/day", "", "nan", "42", "3.14", "850 mg", None, "None", "2-3", "1e5"]
    assert _col(spark, vals, C.parse_number) == [12.0, 8.5, 3221.0, 5.0, None, None, 42.0, 3.14, 850.0, None, None,
                                                 None, 15.0]


def test_trailing_int(spark):
    assert _col(spark, ["weight_15", "timepoint_3", "energy", "mood_end_60", None], C.trailing_int) == [15, 3, None, 60, None]


def test_norm_text(spark):
    assert _col(spark, ["  Hello   World ", None, "A\tB"], C.norm_text) == ["hello world", "", "a b"]


def test_mixed_dates(spark):
    out = _col(spark, ["44928", "2023-01-05", "1/7/2023", "not a date", None], C.parse_mixed_date)
    assert out == [dt.date(2023, 1, 2), dt.date(2023, 1, 5), dt.date(2023, 1, 7), None, None]


def test_zero_to_null_only_for_end(spark):
    df = spark.createDataFrame([("end", 0.0), ("start", 0.0), ("end", 70.0)], "phase string, v double")
    out = [r["o"] for r in df.select(C.zero_to_null_for_end("v", "phase").alias("o")).collect()]
    assert out == [None, 0.0, 70.0]


def test_fiber_resolution(spark):
    df = spark.createDataFrame([(1.5, 0.9, 9.0, "9"), (None, 0.9, 850.0, "850 mg"), (None, None, 4.0, "4 g")],
                               "ins double, sol double, gen double, raw string")
    out = [r["o"] for r in df.select(C.resolve_fiber("ins", "sol", "gen", "raw").alias("o")).collect()]
    assert out[0] == 2.4 and abs(out[1] - 0.85) < 1e-12 and out[2] == 4.0


def test_safe_div_and_nan(spark):
    df = spark.createDataFrame([(1.0, 0.0), (float("nan"), 2.0)], "a double, b double")
    r = df.select(C.safe_div("a", "b").alias("d"), C.null_nan("a").alias("n")).collect()
    assert r[0]["d"] is None and r[1]["n"] is None
