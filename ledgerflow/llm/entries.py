"""Registered queries of the corpus operators, each over its whole table, and their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import chat, exact_dedup, merkle, mixing, pairwise_quality, pii, piece_encoding, quality, simhash, source_audit, substring_dedup, token_counts, urls
from ledgerflow.llm.common import table


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")
    return quality.judge_all(docs, ["doc_id"]).select("row.doc_id", *[F.col(f"quality_{n}").alias(n) for n in names])


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(rows.unionByName(chat.planted(spark))))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encoding.round_trip(table(spark, sf_dir, "documents"))


def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("row_key")


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents")).drop("row_key")


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages")).drop("tokens", "score")


def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence(table(spark, sf_dir, "documents"))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"), merkle.every_seventh())


def pairwise_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_quality_divergence": quality_rules,
    "op2_chat_round_trip": chat_formatting,
    "op3_pivotal_mixing": source_mixing,
    "op4_piece_lattice": piece_round_trip,
    "op5_token_counts": count_tokens,
    "op6_repeated_passages": repeated_passages,
    "op7_personal_data": personal_data,
    "op8_exact_copies": exact_copies,
    "op9_near_copies": near_copies,
    "op10_url_filter": url_filter,
    "op11_source_divergence": source_divergence,
    "op12_merkle_manifest": merkle_manifest,
    "op13_pairwise_quality": pairwise_scores,
}

_EXACT_SQL = """
WITH normal AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
),
grouped AS (
    SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM normal
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM grouped
"""

CHECKS = {"op2_chat_round_trip": chat.SQL, "op8_exact_copies": _EXACT_SQL, "op11_source_divergence": source_audit.SQL, "op12_merkle_manifest": merkle.SQL}
