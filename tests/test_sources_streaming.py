"""File sources / sinks and the streaming daily rollup."""
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneldeck import schemas as SC
from paneldeck.sources import files as FS

SMALL = "/root/testdata/sf0.001"


def _tmp(tmp_path, name):
    return str(tmp_path / f"{name}-{uuid.uuid4().hex[:6]}")


def test_typed_csv_missing_and_corrupt(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType()),
                           T.StructField("v", T.DoubleType())])
    assert FS.read_typed_csv(spark, _tmp(tmp_path, "nope"), schema).count() == 0
    p = tmp_path / "x.csv"
    p.write_text("id,d,v\n1,2023-01-02,3.5\n2,not-a-date,4\nthree,2023-01-03,x\n")
    df = FS.read_typed_csv(spark, str(p), schema, date_cols=("d",), keep_corrupt=True)
    rows = {r["v"]: r for r in df.collect()}
    assert rows[3.5]["d"].isoformat() == "2023-01-02" and rows[4.0]["d"] is None
    assert any(r["_corrupt"] for r in df.collect())  # the malformed line is kept, not fatal


def test_typed_csv_reads_dates_in_common_forms_and_marks_rejects(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType())])
    day = ["2023-01-05", "1/5/2023", "\"Jan 5, 2023\"", "2023-01-05 10:11:12", "2023-01-05T10:11:12.250", "5 Jan 2023", "1-5-2023"]
    none = ["", "NaN", "none"]
    bad = ["spring", "13/45/2023", "44000", "2023-02-30"]
    p = tmp_path / "dates.csv"
    p.write_text("id,d\n" + "".join(f"{i},{t}\n" for i, t in enumerate(day + none + bad)))
    rows = sorted(FS.read_typed_csv(spark, str(p), schema, date_cols=("d",), reject_col="off").collect())
    assert [str(r.d) for r in rows] == ["2023-01-05"] * len(day) + ["None"] * (len(none) + len(bad))
    assert [r.off for r in rows] == [False] * (len(day) + len(none)) + [True] * len(bad)
    gone = FS.read_typed_csv(spark, _tmp(tmp_path, "nope"), schema, date_cols=("d",), reject_col="off")
    assert gone.columns == ["id", "d", "off"] and gone.count() == 0


def test_strict_soft_and_first_existing(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType())])
    p = tmp_path / "a.csv"
    p.write_text("a\n1\n2\n")
    missing = _tmp(tmp_path, "missing.csv")
    with pytest.raises(FileNotFoundError):
        FS.load_strict(spark, {"a": (str(p), schema), "b": (missing, schema)})
    loaded, status = FS.load_soft(spark, {"a": (str(p), schema), "b": (missing, schema)})
    assert set(loaded) == {"a"} and {r["name"]: r["status"] for r in status.collect()} == {"a": "loaded", "b": "missing"}
    assert FS.first_existing(spark, [(missing, schema), (str(p), schema)]).count() == 2


def test_glob_provenance_and_align(spark, tmp_path):
    base = _tmp(tmp_path, "glob")
    ev = spark.read.parquet(f"{SMALL}/events.parquet").select("user_id", "event_type", "value")
    ev.write.option("header", True).partitionBy("event_type").csv(base)
    g = FS.read_glob(spark, base, T.StructType([T.StructField("user_id", T.LongType()),
                                                T.StructField("value", T.DoubleType())]))
    counts = {r["folder"]: r["count"] for r in g.groupBy("folder").count().collect()}
    exp = {f"event_type={r['event_type']}": r["count"] for r in ev.groupBy("event_type").count().collect()}
    assert counts == exp
    aligned = FS.align_to_schema(spark.createDataFrame([("7", "2023-01-01")], "subject_id string, date string"),
                                 SC.DAILY_LONG)
    assert aligned.columns == [f.name for f in SC.DAILY_LONG.fields] and aligned.first()["n_entries"] is None


def test_sink_and_json_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("m", "x", 1.0, 0.1, 10.0, 0.5, 0.8, 1.2)],
                               "model string, term string, coef double, se double, stat double, p_value double, "
                               "ci_lower double, ci_upper double")
    p = _tmp(tmp_path, "json")
    FS.save_json(df, p)
    from paneldeck.operators.regress import COEF_SCHEMA
    assert FS.read_json(spark, p, COEF_SCHEMA).collect() == df.collect()
    base = _tmp(tmp_path, "tbl")
    FS.save_table(df, csv_path=base + "/csv", parquet_path=base + "/pq", partition_by=["model"])
    assert spark.read.parquet(base + "/pq").filter(F.col("model") == "m").count() == 1


def test_streaming_daily_rollup_matches_batch(spark, tmp_path):
    from paneldeck.streaming.daily_stream import latest_days, run_daily_rollup
    src, sink = _tmp(tmp_path, "src"), _tmp(tmp_path, "sink")
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    name = f"t-{uuid.uuid4().hex[:6]}"
    # two portions arriving one after the other (split by event time), the second resumed
    for portion in ("ts < '2024-01-15'", "ts >= '2024-01-15'"):
        ev.filter(portion).write.mode("append").parquet(src)
        run_daily_rollup(spark, src, sink, name=name, lateness="400 days")
    got = latest_days(spark, sink)
    v = F.when(F.col("event_type") == "error", None).otherwise(F.col("value"))
    batch = (ev.groupBy(F.col("user_id").alias("subject_id"), F.col("ts").cast("date").alias("date"))
             .agg(F.coalesce(F.sum(v), F.lit(0.0)).alias("value_total"), F.count(F.lit(1)).alias("n_entries")))
    j = got.join(batch, ["subject_id", "date"])  # every day is there, the last ones too
    assert got.count() == batch.count() == j.count()
    assert j.filter((F.abs(got.value_total - batch.value_total) > 1e-9) | (got.n_entries != batch.n_entries)).count() == 0
