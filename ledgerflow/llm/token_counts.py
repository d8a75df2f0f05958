"""Token counts by count-only Viterbi (operator 5).

An Aho-Corasick automaton over the unigram vocabulary enumerates the pieces that
end at each character; dynamic programming carries the best score and the number
of pieces, nothing else. Pieces that end at a character come longest first and
only a larger score replaces the best, which is the tokenizer's rule for ties.
A character without a piece of its own also ends an unknown piece, which counts
as its UTF-8 bytes.

Null and empty texts count 0. Rows are counted one by one and may repeat; a
text's length only matters in proportion. An empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.pieces import MODEL, SPACE, Pieces, load, prepared

#: words and units whose counts a worker remembers before it starts anew
MEMO = 300_000


class Counter:
    def __init__(self, pieces: Pieces):
        self._pieces = pieces
        self._automaton = ahocorasick.Automaton()
        for piece, score in pieces.scores.items():
            self._automaton.add_word(piece, (len(piece), score))
        self._automaton.make_automaton()
        self._unknown = pieces.unknown
        self._units: dict[str, int] = {}
        self._words: dict[str, int] = {}

    def unit(self, text: str) -> int:
        """Pieces of the best split of a unit."""
        best, count = [0.0], [0]
        at = 0

        def alone(end: int) -> None:
            """Ends without a match, and the unknown piece of characters that are no piece."""
            while len(best) <= end:
                n = len(best)
                best.append(best[n - 1] + self._unknown)
                count.append(count[n - 1] + len(text[n - 1].encode("utf-8", "replace")))

        for last, (length, score) in self._automaton.iter(text):
            end = last + 1
            if end != at:
                alone(end - 1)
                at = end
            start = end - length
            total = best[start] + score
            if len(best) == end:
                best.append(total)
                count.append(count[start] + 1)
                if text[end - 1] not in self._pieces.scores:
                    lone = best[end - 1] + self._unknown
                    if lone > total:  # starts last, so equal sums keep the piece
                        best[end], count[end] = lone, count[end - 1] + len(text[end - 1].encode("utf-8", "replace"))
            elif total > best[end]:
                best[end], count[end] = total, count[start] + 1
        alone(len(text))
        return count[-1]

    def _units_of(self, text: str) -> int:
        total = 0
        for unit in self._pieces.units(text):
            n = self._units.get(unit)
            if n is None:
                if len(self._units) >= MEMO:
                    self._units.clear()
                n = self._units[unit] = self.unit(unit)
            total += n
        return total

    def text(self, text: str) -> int:
        if not text:
            return 0
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            return self._units_of(prepared(text))
        total, known = 0, self._words
        for word in text.split(" "):
            n = known.get(word)
            if n is None:
                if len(known) >= MEMO:
                    known.clear()
                n = known[word] = self._units_of(SPACE + word)
            total += n
        return total


_COUNTERS: dict[int, Counter] = {}


def _count(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        key = len(pieces.ids)
        if key not in _COUNTERS or _COUNTERS[key]._pieces.ids != pieces.ids:
            _COUNTERS.clear()
            _COUNTERS[key] = Counter(pieces)
        counter = _COUNTERS[key]
        for batch in batches:
            out = [counter.text(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.int64())], names=["doc_id", "n_tokens"])

    return count


def token_counts(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per document: doc_id, n_tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(_count(shared), "doc_id long, n_tokens long")
