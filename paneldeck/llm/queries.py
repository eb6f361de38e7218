"""The registered queries of this subpackage: thin uses of the operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneldeck.llm import oracles
from paneldeck.llm.chat import format_chats
from paneldeck.llm.exact_dedup import exact_dedup
from paneldeck.llm.jaccard_join import jaccard_components
from paneldeck.llm.line_dedup import dedup_lines
from paneldeck.llm.merkle import fold, manifest_proofs
from paneldeck.llm.mixing import mix
from paneldeck.llm.pii import find_pii, span_text
from paneldeck.llm.quality_rules import judge_quality
from paneldeck.llm.repair import repair_conversations
from paneldeck.llm.sentencepieces import encode
from paneldeck.llm.text import whole
from paneldeck.llm.token_counts import count_tokens
from paneldeck.llm.token_files import read_token_files, write_token_files
from paneldeck.llm.toxicity import score_toxicity
from paneldeck.sources.tables import table_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document that stays for its text."""
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its counts and the verdict of the weighed rules."""
    out = judge_quality(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", F.round("p_good", 6).alias("p_good"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with how many lines it loses and the digest of the rest."""
    out = dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(whole("text"), 256).alias("kept_sha256"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data: counts, a digest and the spans."""
    out = find_pii(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *[count(kind) for kind in ("email", "ip", "card", "phone")],
                      F.sha2(span_text(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
                      span_text(F.col("spans")).alias("spans"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its expected severity and grade."""
    out = score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", F.round("severity", 4).alias("severity"), "grade", "toxic")


def op6_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its pieces, the scores and a digest of its best
    segmentations and whether its text comes back from the best."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    out = encode(_table(spark, sf_dir, "documents"), model, check=True, digest=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.transform("scores", lambda s: F.round(s, 4)).alias("scores"),
                      F.xxhash64("ids").alias("ids_hash"), "n_best_hash", "round_trip")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    return mix(_table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation: whether it is kept, and the size and digest of its chat."""
    out = format_chats(_table(spark, sf_dir, "conversations"))
    return out.select("conv_id", "n_turns", "kept", F.length("chat").cast("long").alias("n_chars"),
                      F.sha2("chat", 256).alias("chat_sha256"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its set and its component."""
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number of tokens."""
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage by the hash of ``conv_id:turn`` (nulls as one space)."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(told("text"), "[.!?]", "")).otherwise(told("text"))
    role = F.when(code == 4, "user").otherwise(told("role"))
    return (conversations.where(code != 0)
            .select("conv_id", "turn", role.alias("role"), text.alias("text"),
                    F.explode(F.when(code == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
            .drop("copy"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation with its faults after damage and its cheapest repair."""
    conversations = _table(spark, sf_dir, "conversations")
    return repair_conversations(damaged(conversations), conversations.select("conv_id"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its leaf, roots and proof, and whether the row as
    tampered with (every other text loses its line ends) still proves the root."""
    docs = _table(spark, sf_dir, "documents")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    out = manifest_proofs(docs, claimed={"text": tampered})
    out = out.withColumn("folded_root", fold(F.col("claimed_leaf"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("path", ""), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the token files."""
    files = write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, files).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    "op1_exact_dedup": (op1_exact_dedup, oracles.OP1),
    "op2_quality_rules": (op2_quality_rules, None),
    "op3_line_dedup": (op3_line_dedup, oracles.OP3),
    "op4_pii": (op4_pii, None),
    "op5_toxicity": (op5_toxicity, None),
    "op6_sentencepieces": (op6_sentencepieces, None),
    "op7_mixing": (op7_mixing, oracles.OP7),
    "op8_chat": (op8_chat, oracles.OP8),
    "op9_jaccard_join": (op9_jaccard_join, None),
    "op10_token_counts": (op10_token_counts, None),
    "op11_structure_repair": (op11_structure_repair, oracles.OP11),
    "op12_merkle_manifest": (op12_merkle_manifest, oracles.OP12),
    "op13_token_files": (op13_token_files, None),
}
