"""Keyword flags: cases ported from the studied pipeline's unit tests."""
import datetime as dt

from paneldeck.functions.dictionaries import FOOD_KEYWORDS_LONG
from paneldeck.operators.keywords import keyword_flags, keyword_prevalence, weekly_keywords_wide

D = dt.date(2023, 1, 1)


def _flags(spark, rows, **kw):
    df = spark.createDataFrame(rows, "subject_id string, date date, food string")
    out = keyword_flags(df, ["subject_id", "date"], "food", FOOD_KEYWORDS_LONG, **kw)
    return {(r["subject_id"], r["date"]): r.asDict() for r in out.collect()}


def test_dictionary_keys():
    assert list(FOOD_KEYWORDS_LONG) == ["potato", "beans", "rice", "oats", "bread", "fruit", "vegetables",
                                        "dairy", "meat", "egg", "nuts"]


def test_basic_matches(spark):
    rows = [("S1", D, "baked potato with butter"), ("S1", D, "black beans and rice"),
            ("S2", D, "kidney beans"), ("S2", D, "steamed broccoli"), ("S3", D, "whole wheat bread and eggs")]
    f = _flags(spark, rows)
    s1, s2, s3 = f[("S1", D)], f[("S2", D)], f[("S3", D)]
    assert s1["kw_potato"] == s1["kw_beans"] == s1["kw_rice"] == 1
    assert s2["kw_beans"] == s2["kw_vegetables"] == 1 and s2["kw_potato"] == 0
    assert s3["kw_bread"] == s3["kw_egg"] == 1


def test_case_insensitive(spark):
    f = _flags(spark, [("S1", D, "BAKED POTATO and Black Beans")])
    assert f[("S1", D)]["kw_potato"] == 1 and f[("S1", D)]["kw_beans"] == 1


def test_plural_forms(spark):
    rows = [("S1", D, "potato"), ("S1", D + dt.timedelta(1), "potatoes"),
            ("S1", D + dt.timedelta(2), "bean"), ("S1", D + dt.timedelta(3), "beans")]
    f = _flags(spark, rows)
    assert sum(v["kw_potato"] for v in f.values()) == 2
    assert sum(v["kw_beans"] for v in f.values()) == 2


def test_word_boundaries(spark):
    rows = [("S1", D, "potato chips"), ("S1", D + dt.timedelta(1), "sweet potato bread")]
    f = _flags(spark, rows)
    assert sum(v["kw_potato"] for v in f.values()) == 2
    assert sum(v["kw_bread"] for v in f.values()) == 1


def test_null_food_kept_with_zero_flags(spark):
    f = _flags(spark, [("S1", D, None)])
    assert all(v == 0 for k, v in f[("S1", D)].items() if k.startswith("kw_"))


def test_missing_text_column_returns_input(spark):
    df = spark.createDataFrame([("S1", D)], "subject_id string, date date")
    assert keyword_flags(df, ["subject_id", "date"], "food", FOOD_KEYWORDS_LONG) is df


def test_joined_mode_matches_cross_entry_phrase(spark):
    # "steel" and "cut" in two entries of one day: only the exact joined mode sees "steel cut"
    rows = [("S1", D, "steel"), ("S1", D, "cut")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "subject_id string, date date, food string, pos int")
    per_row = keyword_flags(df, ["subject_id", "date"], "food", FOOD_KEYWORDS_LONG).first()
    joined = keyword_flags(df, ["subject_id", "date"], "food", FOOD_KEYWORDS_LONG, joined=True, order_col="pos").first()
    assert per_row["kw_oats"] == 0 and joined["kw_oats"] == 1


def test_weekly_mentions_and_variety(spark):
    from paneldeck.functions.dictionaries import FOOD_KEYWORDS_WIDE
    df = spark.createDataFrame([(1, 1, "potato and potatoes"), (1, 1, "rice"), (1, 2, "apple")],
                               "subject_id long, week int, food_item string")
    out = {r["week"]: r for r in weekly_keywords_wide(df, FOOD_KEYWORDS_WIDE).collect()}
    assert out[1]["potato_mentions"] == 2 and out[1]["potato_week"] == 1
    assert out[1]["food_variety_categories"] == 2 and out[1]["food_entries_week"] == 2
    assert out[2]["fruit_week"] == 1 and out[2]["food_variety_categories"] == 1


def test_prevalence(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (0, 1), (0, 0)], "kw_a int, kw_b int")
    out = {r["keyword"]: r for r in keyword_prevalence(df, ["a", "b"]).collect()}
    assert out["a"]["positive"] == 2 and out["a"]["total"] == 4 and out["a"]["pct"] == 50.0


def test_joined_mode_mentions_match_python(spark):
    import re
    from paneldeck.functions.dictionaries import FOOD_KEYWORDS_WIDE
    entries = ["hard", "boiled egg and steel", "cut oats", "eggs", "fried", "egg"]
    df = spark.createDataFrame([("S1", D, e, i) for i, e in enumerate(entries)],
                               "subject_id string, date date, food string, pos int")
    out = keyword_flags(df, ["subject_id", "date"], "food", FOOD_KEYWORDS_WIDE, prefix="", suffix="_flag",
                        mentions_suffix="_mentions", joined=True, order_col="pos").first()
    text = " ".join(entries).lower()
    for cat, pat in FOOD_KEYWORDS_WIDE.items():
        assert out[f"{cat}_flag"] == int(bool(re.search(pat, text, re.IGNORECASE)))
        assert out[f"{cat}_mentions"] == len(re.findall(pat, text, re.IGNORECASE)), cat
