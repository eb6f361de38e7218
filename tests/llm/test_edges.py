"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing column names, for every operator."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from paneldeck.llm.chat import format_chats
from paneldeck.llm.exact_dedup import exact_dedup
from paneldeck.llm.jaccard_join import drop_near_copies, jaccard_components
from paneldeck.llm.line_dedup import dedup_lines
from paneldeck.llm.mixing import mix, mixed
from paneldeck.llm.pii import find_pii
from paneldeck.llm.quality_rules import judge_quality
from paneldeck.llm.sentencepieces import encode
from paneldeck.llm.token_counts import count_tokens
from paneldeck.llm.toxicity import score_toxicity

LONG = "a long line of words that goes on " * 20_000
ROWS = [(1, "one two three four five six\nsome line that many documents hold\nend", "a"),
        (2, "some line that many documents hold", "a"), (3, "Some line that many documents HOLD  ", "b"),
        (4, None, None), (5, "", "b"), (6, " \t\n ", None), (7, LONG, "a"), (7, LONG, "a"),
        (None, "some line that many documents hold", "b"), (None, None, None), (8, "x", "a"), (8, "y", "a")]
CLASHING = ["id", "row", "n", "size", "key", "kept", "spans", "target", "value", "toxic", "ids", "_lines", "_gone",
            "_words", "_id", "_above", "_segmented", "_stay", "label", "features", "chunk", "n_lines"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return df.withColumns({c: F.lit("mine") for c in CLASHING}).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (2, 1), (None, 1), (3, None)], "doc_id long, toxic int")


BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
OPERATORS = {
    "exact": lambda d, l: exact_dedup(d), "quality": lambda d, l: judge_quality(d), "lines": lambda d, l: dedup_lines(d),
    "pii": lambda d, l: find_pii(d), "toxicity": lambda d, l: score_toxicity(d, l, min_docs=1),
    "pieces": lambda d, l: encode(d, PIECES), "mix": lambda d, l: mix(d),
    "jaccard": lambda d, l: jaccard_components(d), "tokens": lambda d, l: count_tokens(d, BPE),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(docs, labels, name):
    assert OPERATORS[name](docs, labels).count() == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, labels, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0)).count() == 0


def test_exact_dedup_ties_and_nulls(docs):
    rows = exact_dedup(docs).collect()
    of = lambda i: [r for r in rows if r.doc_id == i]
    assert [r.keep_id for r in of(4)] == [4] and [r.keep_id for r in of(5)] == [4]
    assert of(4)[0].group_size == 3  # two nulls and the empty text
    assert sorted(r.kept for r in of(7)) == [False, True]
    assert all(r.keep_id == 2 for r in rows if r.text_sha256 == of(2)[0].text_sha256)
    assert of(5)[0].text_sha256 == hashlib.sha256(b"").hexdigest()
    assert of(6)[0].text_sha256 == hashlib.sha256(b" ").hexdigest()


def test_line_dedup_keeps_other_columns(docs):
    out = dedup_lines(docs)
    rows = {r.doc_id: r for r in out.where("doc_id in (1, 2, 3)").collect()}
    assert rows[1].text == "one two three four five six\nend" and rows[1].n_dropped == 1
    assert rows[2].text == "" and rows[3].n_dropped == 0  # the largest id holds the line
    assert rows[1]._lines == "mine" and rows[1]._gone == "mine" and rows[1].n_lines == 3
    assert out.where("doc_id = 4").first().text is None


def test_jaccard_nulls_and_repeated_ids(docs):
    rows = jaccard_components(docs).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {
        (1, 1), (2, 2), (3, 2), (4, 4), (5, 5), (6, 6), (7, 7), (8, 8), (None, None)} | {
        (None, r.component_id) for r in rows if r.doc_id is None}
    kept = drop_near_copies(docs)
    assert kept.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").count() == 0
    assert kept.where("doc_id = 3").count() == 0 and kept.where("doc_id is null").count() == 2
    assert set(kept.columns) == set(docs.columns)


def test_mix_and_its_rows_agree(docs):
    plan = mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    for r in plan.collect():
        assert abs(r.taken - r.target) <= 0.5 + 1e-6
    rows = mixed(docs)
    assert rows.columns == docs.columns
    words = rows.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert words == sum(r.taken for r in plan.collect())


def test_chat_nulls_ties_and_empty(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "bot", "yes"), (1, 1, "bot", "yes"), (2, 5, "user", "hi"), (3, 0, "user", "hi"),
            (3, 1, "bot", "yes"), (4, None, None, None), (None, 0, "user", "lost"), (5, 0, "user", "other")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("kept", F.lit(1))
    out = {r.conv_id: r for r in format_chats(conv).collect()}
    assert {c: r.kept for c, r in out.items()} == {1: True, 2: False, 3: False, 4: True, None: True, 5: True}
    assert out[1].chat == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>bot\nyes<|im_end|>\n" and out[1].n_turns == 2
    assert out[4].chat == "<|im_start|>\n<|im_end|>\n" and out[2].chat is None
    assert format_chats(conv.limit(0)).count() == 0
