"""A corpus from documents: quality rules, exact dedup, near dedup, mixing, encoding.

Every stage works on all its predecessor kept, reread from Parquet; all but the
last return the columns of documents. Part of the subpackage `ledgerflow.llm`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import exact_dedup, mixing, piece_encoding, quality, simhash
from ledgerflow.llm.common import stored, table


#: text of a chunk of the last stage, half of the operator's own: executors still hold memory of the stages before
CHUNK_BYTES = 4 << 20


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or diverge from their language go."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest doc_id stays."""
    return simhash.keep_first(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, with the digest of its text and of what they decode to."""
    return piece_encoding.round_trip(docs, chunk_bytes=CHUNK_BYTES)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding and decoding", token_ids),
]

#: hashes, draws and token ids are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
