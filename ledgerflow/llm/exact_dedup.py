"""Exact dedup by a Golomb-coded exchange of fingerprints (operator 8).

Senders are chunks of the table (one Arrow batch each). A chunk sends every
owner its sorted distinct 64-bit fingerprints as Golomb-Rice coded gaps; the
owner of a range of fingerprints merges what it got and answers each chunk with
a bitmap of the ones that occur more than once anywhere. Only rows so marked
are suspects: their texts are shuffled and compared byte by byte.

Texts are equal when identical after lower-casing A-Z; null counts as empty.
Rows are told apart by doc_id alone, so rows that repeat a doc_id share their
fate. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import columns_of, hot_join, partitions, stored, whole_rows

#: fingerprints that one owner merges at once, on average
PER_OWNER = 1 << 20
#: bits of the filter that tells senders which texts to ship; a fixed size, so it may be broadcast
FILTER_BITS = 1 << 26
#: bits of the filter in one row while it is put together
_BLOCK = 1 << 15


def golomb_encode(values: np.ndarray, shift: int) -> bytes:
    """Golomb-Rice code of the gaps of sorted distinct uint64 values: unary quotient, `shift` low bits."""
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    quotient = (gaps >> np.uint64(shift)).astype(np.int64)
    ends = np.cumsum(quotient + 1)
    unary = np.ones(int(ends[-1]), dtype=np.uint8)
    unary[ends - 1] = 0
    low = (gaps[:, None] >> np.arange(shift, dtype=np.uint64)) & np.uint64(1) if shift else np.zeros((len(gaps), 0))
    return int(ends[-1]).to_bytes(8, "little") + np.packbits(unary).tobytes() + np.packbits(low.astype(np.uint8).ravel()).tobytes()


def golomb_decode(blob: bytes, count: int, shift: int) -> np.ndarray:
    if not count:
        return np.empty(0, dtype=np.uint64)
    n_unary = int.from_bytes(blob[:8], "little")
    split = 8 + (n_unary + 7) // 8
    unary = np.unpackbits(np.frombuffer(blob[8:split], np.uint8), count=n_unary)
    ends = np.flatnonzero(unary == 0)
    quotient = np.diff(ends, prepend=-1) - 1
    low = np.unpackbits(np.frombuffer(blob[split:], np.uint8), count=count * shift).reshape(count, shift).astype(np.uint64)
    gaps = (quotient.astype(np.uint64) << np.uint64(shift)) + (low << np.arange(shift, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def rice_shift(count: int, span: int) -> int:
    """Low bits for `count` values spread over `span`: about log2 of the mean gap, 60 at most."""
    return max(0, min(60, (span // max(count, 1)).bit_length() - 1))


def _normalised(text: bytes | None) -> bytes:
    return (text or b"").lower()  # bytes.lower() changes A-Z only


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for number, batch in enumerate(batches):
        texts = [_normalised(t) for t in batch.column("text").to_pylist()]
        prints = np.array([xxhash.xxh64_intdigest(t) for t in texts], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([(part << 32) | number] * len(texts), pa.int64()),
                batch.column("doc_id"),
                batch.column("row_key"),
                pa.array(prints.view(np.int64)),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            ],
            names=["chunk", "doc_id", "row_key", "fp", "sha"],
        )


def _encode_chunk(owners: int):
    span = (1 << 64) // owners + 1

    def encode(pdf: pd.DataFrame) -> pd.DataFrame:
        prints, counts = np.unique(pdf["fp"].to_numpy().view(np.uint64), return_counts=True)
        out = []
        owner = prints // np.uint64(span)
        for o in np.unique(owner):
            mine = owner == o
            low = prints[mine] - np.uint64(int(o) * span)
            shift = rice_shift(len(low), span)
            out.append((int(o), int(pdf["chunk"].iloc[0]), len(low), shift, golomb_encode(low, shift), np.packbits(counts[mine] > 1).tobytes()))
        return pd.DataFrame(out, columns=["owner", "chunk", "count", "shift", "blob", "own"])

    return encode


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """The owner's merge: a bitmap for each chunk, in the order of its blob."""
    lists = [golomb_decode(b, n, s) for b, n, s in zip(pdf["blob"], pdf["count"], pdf["shift"], strict=True)]
    every, counts = np.unique(np.concatenate(lists), return_counts=True)
    repeated = every[counts > 1]
    out = []
    for chunk, prints, own in zip(pdf["chunk"], lists, pdf["own"], strict=True):
        at = np.minimum(np.searchsorted(repeated, prints), max(len(repeated) - 1, 0))
        hit = repeated[at] == prints if len(repeated) else np.zeros(len(prints), bool)
        hit |= np.unpackbits(np.frombuffer(own, np.uint8), count=len(prints)).astype(bool)
        out.append((chunk, int(pdf["owner"].iloc[0]), len(prints), np.packbits(hit).tobytes()))
    return pd.DataFrame(out, columns=["chunk", "owner", "count", "bitmap"])


def _suspects(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """The sender reads the bitmaps against its own sorted fingerprints."""
    prints = np.unique(rows["fp"].to_numpy().view(np.uint64))
    answers = answers.sort_values("owner")
    bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(answers["bitmap"], answers["count"], strict=True)]
    repeated = prints[np.concatenate(bits).astype(bool)] if bits else prints[:0]
    return pd.DataFrame({"fp": repeated.view(np.int64)})


def _slot(fp: np.ndarray) -> np.ndarray:
    return (fp.view(np.uint64) % np.uint64(FILTER_BITS)).astype(np.int64)


def _blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(_BLOCK, np.uint8)
    bits[_slot(pdf["fp"].to_numpy()) % _BLOCK] = 1
    return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "bits": [np.packbits(bits).tobytes()]})


def _ship(filter_blocks):
    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = filter_blocks.value
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text = _normalised(text)
                fp = xxhash.xxh64_intdigest(text)
                slot = fp % FILTER_BITS
                bits = blocks.get(slot // _BLOCK)
                at = slot % _BLOCK
                if bits and bits[at >> 3] >> (7 - (at & 7)) & 1:
                    out.append((fp - (1 << 64) if fp >> 63 else fp, text, doc_id))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.int64())],
                names=["fp", "bytes", "doc_id"],
            )

    return ship


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, row_key (hash of its raw text), keep_id, group_size, kept, text_sha256.

    The row with the largest doc_id of equal texts stays. Memory is bounded by a
    batch at the sender, by `PER_OWNER` fingerprints at an owner (a fingerprint
    counts once per chunk, so a hot one stays small) and by the filter's size.
    """
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    keyed = read.withColumn("row_key", F.xxhash64("text"))
    sent = stored(keyed.mapInArrow(_fingerprints, "chunk long, doc_id long, row_key long, fp long, sha binary"))
    owners = max(1, -(-sent.count() // PER_OWNER), partitions(spark))

    blobs = sent.select("chunk", "fp").groupBy("chunk").applyInPandas(_encode_chunk(owners), "owner long, chunk long, count int, shift int, blob binary, own binary")
    answers = blobs.groupBy("owner").applyInPandas(_answer, "chunk long, owner long, count int, bitmap binary")
    suspects = sent.select("chunk", "fp").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_suspects, "fp long")
    suspects = stored(suspects.distinct())

    slot = F.pmod("fp", F.lit(FILTER_BITS))  # a power of two: the sign does not matter
    parts = suspects.withColumn("block", F.floor(slot / _BLOCK).cast("long")).groupBy("block").applyInPandas(_blocks, "block long, bits binary")
    filter_blocks = spark.sparkContext.broadcast({r["block"]: bytes(r["bits"]) for r in parts.collect()})  # FILTER_BITS / 8 bytes at most

    equal = read.mapInArrow(_ship(filter_blocks), "fp long, bytes binary, doc_id long")
    equal = equal.groupBy("fp", "bytes").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1")
    equal = equal.select(F.unhex(F.sha2("bytes", 256)).alias("sha"), "keep_id", "group_size")
    joined = hot_join(sent.select("doc_id", "row_key", "sha"), equal, "sha", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        "row_key",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents without the copies that `exact_groups` drops; all columns stay."""
    gone = exact_groups(docs).where("NOT kept").select(F.col("doc_id").alias("gone_id"), F.col("row_key").alias("gone_key"))
    rows = whole_rows(docs, my_id=F.col("doc_id").cast("long"), my_key=F.xxhash64(F.col("text").cast("binary")))
    same = F.col("my_id").eqNullSafe(F.col("gone_id")) & (F.col("my_key") == F.col("gone_key"))
    return columns_of(rows.join(gone, same, "left_anti"), docs.columns)
