"""SimHash near-dedup by Golay-code fuzzy hashing (operator 9).

Fingerprint: 64 bits, a bit is 1 if it is set in over half of the XXH64 hashes
(seed 42) of a text's 4-word shingles (A-Z lower-cased, repeats included). A
text of fewer words has one shingle, all its words; without words the
fingerprint is zero. Fingerprints link at `MAX_BITS` or fewer differing bits.

Search: a fingerprint is cut in three segments, each padded to 23 bits and
decoded by the binary Golay code. The keys of a segment are the codewords within
4 bits of it: 1 or 6. Two segments that differ in 2 bits or fewer share a
codeword, for some word lies within 1 bit of both and its nearest codeword,
within 3, is within 4 of either. Of at most 4 differing bits at least two
segments have 2 or fewer each, so linked fingerprints share a key of some pair
of segments. Buckets up to `BUCKET` fingerprints are compared within; the
members of larger ones, the dense places, link through the exact midpoints: two
fingerprints differ in at most 4 bits exactly if some word lies within 2 bits of
both, so joining every member to the least member at each such word gives the
same components without pairs.

Only distinct fingerprints are searched: copies cost nothing. Null texts are
empty; rows are independent and may repeat; a null doc_id is ignored by the
smallest-id rule. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import columns_of, components, hot_join, partitions, stored, whole_rows

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: fingerprints of one key that are compared with each other; members of larger buckets link through their 2081
#: midpoints, which costs about as much as this many comparisons
BUCKET = 1024
#: first bit and length of the segments
SEGMENTS = ((0, 22), (22, 21), (43, 21))
_GENERATOR = 0xAE3  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def fingerprint(text: bytes | None) -> int:
    words = (text or b"").lower().split()  # both work on ASCII alone
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    starts = [0]
    for w in words:
        starts.append(starts[-1] + len(w) + 1)
    digest = xxhash.xxh64_intdigest
    n = len(words) - SHINGLE + 1
    hashes = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts[:n], starts[SHINGLE:], strict=True)), np.uint64, n)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The word of the bits that are set in over half of the hashes."""
    sums = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        part = hashes[k : k + 4096].view(np.uint8).reshape(-1, 8)
        sums += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * sums > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter((fingerprint(t.as_py()) for t in batch.column("text")), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), pa.array(prints.view(np.int64))], names=["doc_id", "row_key", "fp"])


def _remainders(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit polynomials by the generator: the syndrome, 0 for codewords."""
    left = words.astype(np.int64)
    for bit in range(22, 10, -1):
        left ^= np.where(left >> bit & 1, _GENERATOR << (bit - 11), 0)
    return left


def _coset_patterns() -> np.ndarray:
    """For each syndrome its error patterns of weight 4 or less: 1 or 6 of them, padded with -1."""
    found: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        masks = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for syndrome, mask in zip(_remainders(masks).tolist(), masks.tolist(), strict=True):
            found[syndrome].append(mask)
    table = np.full((2048, 6), -1, np.int64)
    for syndrome, masks in enumerate(found):
        table[syndrome, : len(masks)] = masks
    return table


def segment_keys(prints: np.ndarray, patterns: np.ndarray) -> list[np.ndarray]:
    """Per segment an array (n, 6) of codeword numbers (12 bits), -1 where there are fewer."""
    out = []
    for start, length in SEGMENTS:
        word = (prints >> np.uint64(start) & np.uint64((1 << length) - 1)).astype(np.int64) << (23 - length)
        errors = patterns[_remainders(word)]
        out.append(np.where(errors < 0, -1, (word[:, None] ^ errors) >> 11))
    return out


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    patterns = _coset_patterns()
    for batch in batches:
        prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        parts = segment_keys(prints, patterns)
        for number, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
            a, b = parts[i][:, :, None], parts[j][:, None, :]
            key = np.where((a >= 0) & (b >= 0), number << 24 | a << 12 | b, -1).reshape(len(prints), -1)
            row, at = np.nonzero(key >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(key[row, at]), pa.array(prints[row].view(np.int64))], names=["key", "fp"])


def _near(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a bucket, thinned to one per fingerprint: each to the first of its component."""
    close = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= MAX_BITS
    first = close.argmax(axis=1)
    while True:
        least = np.where(close, first[None, :], len(prints)).min(axis=1)
        if (least == first).all():
            break
        first = least
    member = np.flatnonzero(first != np.arange(len(prints)))
    return member, first[member]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: the links (a, b) of small buckets; members of large ones as (fp, null). Holds one bucket of `BUCKET` at most."""
    held_key, held, large = None, [], False
    for batch in batches:
        out_a: list[np.ndarray] = []
        out_b: list[np.ndarray | None] = []
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if start == end:
                continue
            if keys[start] != held_key:
                _close(held, large, out_a, out_b)
                held_key, held, large = keys[start], [], False
            held.append(prints[start:end])
            if large or sum(map(len, held)) > BUCKET:
                large = True
                _close(held, large, out_a, out_b)
                held = []
        yield _link_batch(out_a, out_b)
    out_a, out_b = [], []
    _close(held, large, out_a, out_b)
    yield _link_batch(out_a, out_b)


def _close(held: list[np.ndarray], large: bool, out_a: list, out_b: list) -> None:
    if not held or (not large and len(held) == 1 and len(held[0]) == 1):
        return
    prints = np.concatenate(held)
    if large:
        out_a.append(prints)
        out_b.append(None)
    else:
        i, j = _near(prints)
        if len(i):
            out_a.append(prints[i])
            out_b.append(prints[j])


def _link_batch(out_a: list, out_b: list) -> pa.RecordBatch:
    a = np.concatenate(out_a) if out_a else np.empty(0, np.uint64)
    b = np.concatenate([np.zeros(len(x), np.uint64) if y is None else y for x, y in zip(out_a, out_b, strict=True)]) if out_a else a
    none = np.concatenate([np.full(len(x), y is None) for x, y in zip(out_a, out_b, strict=True)]) if out_a else np.empty(0, bool)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64), mask=none)], names=["a", "b"])


def _midpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All words within MAX_BITS / 2 bits of each fingerprint."""
    masks = np.array([sum(1 << b for b in bits) for w in range(MAX_BITS // 2 + 1) for bits in combinations(range(64), w)], np.uint64)
    for batch in batches:
        every = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for k in range(0, len(every), 64):
            prints = every[k : k + 64]
            points = (prints[:, None] ^ masks[None, :]).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(points.view(np.int64)), pa.array(np.repeat(prints, len(masks)).view(np.int64))], names=["point", "fp"])


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) over distinct fingerprints (column fp) with the components of all links of `MAX_BITS` or fewer bits."""
    n = partitions(prints.sparkSession)
    keyed = prints.select("fp").mapInArrow(_keys, "key long, fp long")
    found = stored(keyed.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_links, "a long, b long").distinct())
    dense = found.where("b IS NULL").select(F.col("a").alias("fp"))
    points = dense.repartition(n).mapInArrow(_midpoints, "point long, fp long")
    least = points.groupBy("point").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least < most").select("point", "least")
    through = hot_join(points, least, "point").where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    return found.where("b IS NOT NULL").unionByName(through.distinct())


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, row_key (hash of its raw text), fingerprint (16 hex digits), component_id."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    read = read.withColumn("row_key", F.xxhash64("text"))
    rows = stored(read.mapInArrow(_fingerprints, "doc_id long, row_key long, fp long"))
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(prints))
    member = prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    first = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stored(hot_join(member, first, "root").select("fp", "component_id"))
    out = hot_join(rows, named, "fp")
    return out.select("doc_id", "row_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest doc_id; all columns stay."""
    gone = near_groups(docs).where("NOT (doc_id <=> component_id)").select(F.col("doc_id").alias("gone_id"), F.col("row_key").alias("gone_key"))
    rows = whole_rows(docs, my_id=F.col("doc_id").cast("long"), my_key=F.xxhash64(F.col("text").cast("binary")))
    same = F.col("my_id").eqNullSafe(F.col("gone_id")) & (F.col("my_key") == F.col("gone_key"))
    return columns_of(rows.join(gone, same, "left_anti"), docs.columns)
