"""Removal of repeated passages with phrase automata (operator 6).

A window is `WINDOW` consecutive words. A word goes if a window covers it whose
word sequence also starts in a document with a smaller doc_id.

0. Of documents of equal words the first stands for all; every word of the
   others goes, if there are `WINDOW` of them.
1. Every window names an anchor, its 10-word phrase of least hash, so equal
   windows name equal anchors. Anchors are about one phrase in twenty; those
   found under two doc_ids or more are the recurring ones.
2. Documents meet their recurring anchors. A task compiles the phrases of a
   shard of its documents, `SHARD` phrases at most, into an Aho-Corasick
   automaton and streams the documents through it; the windows around every
   occurrence are candidates.
3. Candidate windows are confirmed by their 96-bit hash: the least doc_id of
   each is found by an aggregation, and windows of larger doc_ids are marked.
4. The words under marked windows are cut.

Texts are split at space and U+0009..U+000D. Null texts have no words. A row
with null doc_id is smaller than none and larger than none: it stays whole.
Rows that repeat a doc_id are not smaller than each other. Documents of fewer
than `WINDOW` words stay whole. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import hot_join, stored, whole_rows

WINDOW, PHRASE = 50, 10
#: phrases in one automaton
SHARD = 20_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_2 = np.uint64(0xD6E8FEB86659FD93)
_MEMO = 300_000


class _Hashes(dict):
    """Word hashes of this worker; emptied when it holds `_MEMO` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _rolling(hashes: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash, modulo 2^64, of every run of `length` words."""
    n = len(hashes) - length + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k, power in enumerate(_powers(base, length)):
        out += hashes[k : k + len(out)] * power
    return out


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and hashes of the anchors of all windows of a document."""
    if len(hashes) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    phrases = _mixed(_rolling(hashes, PHRASE, _BASE))
    span = WINDOW - PHRASE + 1
    views = np.lib.stride_tricks.sliding_window_view(phrases, span)
    at = np.unique(np.concatenate([views[k : k + 4096].argmin(axis=1) + np.arange(k, min(k + 4096, len(views))) for k in range(0, len(views), 4096)]))
    return at, phrases[at]


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A narrow row per document: number of words, digest of its words, digest of its text as kept whole, anchors."""
    for batch in batches:
        out = []
        for text in batch.column("text"):
            words = (text.as_py() or b"").split()
            joined = b" ".join(words)
            _, phrases = anchors(_word_hashes(words))
            out.append((len(words), xxhash.xxh3_128_digest(joined), hashlib.sha256(joined.decode("utf-8", "replace").encode()).hexdigest(), np.unique(phrases).view(np.int64)))
        n, digests, whole, phrases = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_key"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(whole, pa.string()), pa.array(phrases, pa.list_(pa.int64()))],
            names=["doc_id", "row_key", "n_words", "words_key", "whole_sha256", "phrases"],
        )


def _occurrences(automaton, words: list[bytes]) -> np.ndarray:
    """Word positions at which a phrase of the automaton starts."""
    text = " " + b" ".join(words).decode("utf-8", "replace") + " "
    ends = [end for end, _ in automaton.iter(text)]
    if not ends:
        return np.empty(0, np.int64)
    stops = np.cumsum([len(w.decode("utf-8", "replace")) + 1 for w in words])
    return np.unique(np.searchsorted(stops, ends) - PHRASE + 1)


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows: doc_id, row_key, text and its recurring phrases; out: the candidate windows."""
    for batch in batches:
        shard: list[tuple] = []
        phrases: set[str] = set()
        for i in range(batch.num_rows):
            words = batch.column("text")[i].as_py().split()
            hashes = _word_hashes(words)
            at, keys = anchors(hashes)
            mine = at[np.isin(keys.view(np.int64), batch.column("phrases")[i].values.to_numpy(zero_copy_only=False))]
            phrases.update(" " + b" ".join(words[p : p + PHRASE]).decode("utf-8", "replace") + " " for p in mine.tolist())
            shard.append((i, words, hashes))
            if len(phrases) >= SHARD:
                yield _candidates(batch, shard, phrases)
                shard, phrases = [], set()
        if shard:
            yield _candidates(batch, shard, phrases)


def _tags(batch: pa.RecordBatch) -> np.ndarray:
    """32 bits of the rows' keys, above the place in the text: tell apart rows that repeat a doc_id."""
    return batch.column("row_key").to_numpy() >> 32 << 32


def _candidates(batch: pa.RecordBatch, shard: list[tuple], phrases: set[str]) -> pa.RecordBatch:
    automaton = ahocorasick.Automaton()
    for phrase in phrases:
        automaton.add_word(phrase, 0)
    if phrases:
        automaton.make_automaton()
    rows, places, keys, checks = [], [], [], []
    for i, words, hashes in shard:
        n = len(words) - WINDOW + 1
        steps = np.zeros(n + 1, np.int64)
        at = _occurrences(automaton, words) if phrases else np.empty(0, np.int64)
        np.add.at(steps, np.clip(at - (WINDOW - PHRASE), 0, n), 1)
        np.add.at(steps, np.clip(at + 1, 0, n), -1)
        start = np.flatnonzero(np.cumsum(steps[:n]) > 0)
        rows.append(np.full(len(start), i))
        places.append(start)
        keys.append(_mixed(_rolling(hashes, WINDOW, _BASE))[start])
        checks.append((_mixed(_rolling(hashes, WINDOW, _BASE_2))[start] >> np.uint64(32)).astype(np.uint32))
    of = pa.array(np.concatenate(rows).astype(np.int64))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(keys).view(np.int64)),
            pa.array(np.concatenate(checks).view(np.int32)),
            batch.column("doc_id").take(of),
            pa.array(_tags(batch)[of.to_numpy()] | np.concatenate(places)),
        ],
        names=["window", "check", "doc_id", "place"],
    )


def keep_words(words: list[bytes], marked: np.ndarray) -> list[bytes]:
    """The words no marked window covers."""
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, marked, 1)
    np.add.at(steps, marked + WINDOW, -1)
    left = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
    return [words[i] for i in left.tolist()]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`places` are the starts of the marked windows of all rows of the doc_id, with their tags."""
    for batch in batches:
        kept, counts = [], []
        for text, tag, places in zip(batch.column("text"), _tags(batch).tolist(), batch.column("places"), strict=True):
            words = (text.as_py() or b"").split()
            places = places.values.to_numpy(zero_copy_only=False)
            left = keep_words(words, places[places >> 32 << 32 == tag] & 0xFFFFFFFF)
            counts.append(len(words) - len(left))
            kept.append(b" ".join(left).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), pa.array(counts, pa.int64()), pa.array(kept, pa.string())], names=["cut_id", "cut_key", "n_cut", "kept"])


def _plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Narrow rows of all documents with `copy` (all words stand in a smaller document), and the cut texts of those with marks."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = rows.withColumn("row_key", F.xxhash64("text"))
    named = stored(rows.mapInArrow(_named, "doc_id long, row_key long, n_words long, words_key binary, whole_sha256 string, phrases array<long>"))
    # the first of documents of equal words stands for all of them: the others go whole
    first = named.groupBy("words_key").agg(F.min("doc_id").alias("first_id"))
    told = hot_join(named, first, "words_key").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)) & (F.col("n_words") >= WINDOW))
    told = stored(told.drop("words_key", "first_id"))

    present = rows.where("doc_id IS NOT NULL")
    anchored = told.where("NOT copy AND doc_id IS NOT NULL").select("doc_id", F.explode("phrases").alias("phrase"))
    recurring = anchored.groupBy("phrase").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("phrase")
    lists = hot_join(anchored, recurring, "phrase").groupBy("doc_id").agg(F.collect_set("phrase").alias("phrases"))
    windows = present.join(lists.hint("merge"), "doc_id").select("doc_id", "row_key", "text", "phrases").mapInArrow(_window_rows, "window long, check int, doc_id long, place long")
    least = windows.groupBy("window", "check").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    least = least.select(F.col("window").alias("least_window"), F.col("check").alias("least_check"), "first")
    # joined on the window alone: a new shuffle of both sides, so a window of very many documents may be split
    later = windows.join(least.hint("merge"), F.col("window") == F.col("least_window")).where("check = least_check AND doc_id > first")
    marks = later.groupBy("doc_id").agg(F.collect_set("place").alias("places"))
    cut = present.join(marks.hint("merge"), "doc_id").select("doc_id", "row_key", "text", "places").mapInArrow(_cut, "cut_id long, cut_key long, n_cut long, kept string")
    return told, cut


def _same_row() -> Column:
    return (F.col("doc_id") == F.col("cut_id")) & (F.col("row_key") == F.col("cut_key"))


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    told, cut = _plan(docs)
    cut = cut.select("cut_id", "cut_key", "n_cut", F.sha2(F.col("kept").cast("binary"), 256).alias("cut_sha256"))
    cut = cut.groupBy("cut_id", "cut_key").agg(F.first("n_cut").alias("n_cut"), F.first("cut_sha256").alias("cut_sha256"))
    out = told.join(cut, _same_row(), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(nothing)).otherwise(F.coalesce("cut_sha256", "whole_sha256")).alias("kept_sha256"),
    )


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The documents with the repeated passages cut from their text, words joined by one space where any was cut; other columns stay."""
    told, cut = _plan(docs)
    changed = cut.groupBy("cut_id", "cut_key").agg(F.first("kept").alias("cut_text"))
    copies = told.where("copy").select(F.col("doc_id").alias("cut_id"), F.col("row_key").alias("cut_key"), F.lit("").alias("cut_text")).distinct()
    changed = copies.unionByName(changed.join(copies.select("cut_id", "cut_key"), ["cut_id", "cut_key"], "left_anti"))
    rows = whole_rows(docs, my_id=F.col("doc_id").cast("long"), my_key=F.xxhash64(F.col("text").cast("binary")))
    joined = rows.join(changed, (F.col("my_id") == F.col("cut_id")) & (F.col("my_key") == F.col("cut_key")), "left")
    text = F.coalesce("cut_text", F.col("row.text").cast("string")).alias("text")
    return joined.select(*[text if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
