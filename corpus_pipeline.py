"""The corpus pipeline: from the documents table to encoded training text.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents.  All but the last return
the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneldeck.llm.jaccard_join import drop_near_copies
from paneldeck.llm.line_dedup import dedup_lines
from paneldeck.llm.mixing import mixed
from paneldeck.llm.sentencepieces import encode
from paneldeck.llm.toxicity import score_toxicity
from paneldeck.session import write_stage
from paneldeck.sources.tables import table_path


def _same_columns(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of the documents, with n_chars counted anew."""
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of any toxic grade is under one half; the
    model is fitted on a bounded sample of the labelled documents."""
    labels = spark.read.parquet(table_path(sf_dir, "labels"))
    return score_toxicity(docs, labels).where("not toxic").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long lines that three or more hold, but for the last
    holder.  No document is dropped."""
    return _same_columns(dedup_lines(docs), docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similarity 0.75 or more connect."""
    return drop_near_copies(docs).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by weight: documents repeated, left out or cut at
    their source's budget."""
    return _same_columns(mixed(docs), docs)


def sentencepieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the ids of its best segmentation, their number, the
    scores and a digest of the best few and whether its text comes back."""
    out = encode(docs, public_tokenizers.path("piece_bpe_32k.model"), check=True, digest=True)
    return out.select(*docs.columns, "ids", F.size("ids").cast("long").alias("n_tokens"), "scores",
                      "n_best_hash", "round_trip")


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mixing", mixing),
    ("sentencepieces", sentencepieces),
]

# Neither the fitted model nor the piece lattice can be expressed in SQL; tests/llm
# compares the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
