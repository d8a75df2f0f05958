"""The piece table of a tokenizer file, read as a unigram vocabulary.

The model file holds pieces in the order of their merge ranks. As a unigram
vocabulary a piece's score is minus its rank, and an encoding is the split with
the largest sum of scores. Characters without a piece cost the least score minus
10 and are written as their UTF-8 bytes. Among equal sums the earlier start of
the last piece wins, at every position, as in the tokenizer's own search.

Text is prepared as the model asks: a space is put in front and spaces become
U+2581. Texts are cut into units no piece can span: between the spaces, and
inside a word between letters and other characters where the table allows it.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece

SPACE = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_UNKNOWN_PENALTY = 10.0
#: characters of a piece: its length has six bits in the lattice
LONGEST = 63
_LETTER = "[^\\W\\d_²³¹]"
_OTHER = f"(?:[\\W\\d_²³¹](?<!{SPACE}))"


@dataclass(frozen=True)
class Pieces:
    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    names: list[str]
    by_letters: bool

    @property
    def unknown(self) -> float:
        return min(self.scores.values()) - _UNKNOWN_PENALTY

    @property
    def longest(self) -> int:
        return max(map(len, self.scores))

    def units(self, words: str) -> list[str]:
        """Units of prepared text."""
        return (_LETTERS if self.by_letters else _WORDS).findall(words)

    def cut(self, texts: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
        """Units of a column of texts, one after the other, and how many each text has.

        What `units` finds in the prepared texts, with blanks where `spaced` puts U+2581.
        """
        texts = texts.cast(pa.large_string())
        blank, empty = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        full = pc.if_else(pc.equal(pc.binary_length(texts), 0), empty, pc.binary_join_element_wise(blank, texts, empty))
        ends = np.frombuffer(full.buffers()[1], np.int64)[full.offset : full.offset + len(full) + 1]
        data = full.buffers()[2] or pa.py_buffer(b"")
        begins = np.zeros(ends[-1] + 1, bool)
        begins[ends] = True  # of the next text, or of nothing
        _changes(np.frombuffer(data, np.uint8), int(ends[0]), int(ends[-1]), kinds(self.by_letters), begins)
        starts = np.flatnonzero(begins)
        units = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), data)
        return units, np.diff(np.searchsorted(starts, ends))

    @cached_property
    def _normal(self) -> tuple[pa.Array, np.ndarray]:
        return pa.array(list(self.ids), pa.string()), np.fromiter(self.ids.values(), np.int32)

    @cached_property
    def _names(self) -> pa.Array:
        return pa.array(self.names, pa.large_binary())

    def spell_all(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a column of pieces, one after the other, and how many each piece has."""
        known, ids = self._normal
        place = pc.index_in(pieces, value_set=known)
        found = place.is_valid().to_numpy(zero_copy_only=False)
        sizes = pc.binary_length(pieces).to_numpy()
        counts = np.where(found, 1, sizes)
        out = np.empty(counts.sum(), np.int32)
        single = np.repeat(found, counts)
        out[single] = ids[place.drop_null().to_numpy()]
        ends = np.frombuffer(pieces.buffers()[1], np.int32)
        data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        out[~single] = np.array(self.byte_ids, np.int32)[data[np.repeat(~found, sizes)]]
        return out, counts

    def written_all(self, ids: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The bytes that ids stand for, as a column, and their lengths."""
        names = self._names.take(pa.array(ids, pa.int32()))
        return names, pc.binary_length(names).to_numpy()

    def spell(self, piece: str) -> list[int]:
        """Ids of a piece, or the bytes of an unknown character."""
        got = self.ids.get(piece)
        return [got] if got is not None else [self.byte_ids[b] for b in piece.encode("utf-8", "replace")]

    def written(self, ids: Iterable[int]) -> str:
        """The prepared text of token ids."""
        names = self.names
        return b"".join([names[i] for i in ids]).decode("utf-8", "replace")

    def decode(self, ids: Iterable[int]) -> str:
        """The text of token ids; the space put in front is taken off."""
        return self.written(ids).replace(SPACE, " ")[1:]


_CUT_BYTES = 1 << 18  # of a text that is looked at together


@cache
def kinds(by_letters: bool) -> np.ndarray:
    """Kind of every code point: 0 the blank and U+2581, 1 a letter, 2 any other; 2 a letter, too, where units are whole words."""
    every = np.arange(sys.maxunicode + 1, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    out = np.full(len(every), 2, np.uint8)
    if by_letters:
        for run in re.finditer(f"{_LETTER}+", every):
            out[run.start() : run.end()] = 1
    out[[ord(" "), ord(SPACE)]] = 0
    return out


def _changes(data: np.ndarray, at: int, end: int, kind_of: np.ndarray, begins: np.ndarray) -> None:
    """Marks the bytes between `at` and `end` where one unit ends and another begins."""
    before = 0
    while at < end:
        stop = min(at + _CUT_BYTES, end)
        while stop < end and data[stop] & 0xC0 == 0x80:  # inside a character
            stop += 1
        part = data[at:stop]
        kind = kind_of[np.frombuffer(part.tobytes().decode().encode("utf-32-le"), "<u4")]
        earlier = np.concatenate(([before], kind[:-1]))
        changed = (kind != earlier) & (earlier != 0)
        begins[at + np.flatnonzero((part & 0xC0) != 0x80)[changed]] = True
        at, before = stop, kind[-1]


_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# the first branch is the second for the commonest letters, and faster
_LETTERS = re.compile(f"{SPACE}?[A-Za-zÀ-ÖØ-öø-ɏ]++(?!{_LETTER})|{SPACE}*{_LETTER}+|{SPACE}*{_OTHER}+|{SPACE}+")


def load(path: str = MODEL) -> Pieces:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    normal = [i for i in every if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    ids = {model.id_to_piece(i): i for i in normal}
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    value = {i: bytes([b]) for b, i in enumerate(byte_ids)}
    names = [value.get(i, model.id_to_piece(i).encode()) for i in every]
    if any(SPACE in p.lstrip(SPACE) for p in ids):
        raise ValueError("a piece spans words")
    if max(map(len, ids)) > LONGEST:
        raise ValueError(f"a piece of more than {LONGEST} characters")
    kind = re.compile(_LETTER)
    mixed = any(a != SPACE and bool(kind.match(a)) != bool(kind.match(b)) for p in ids for a, b in zip(p, p[1:], strict=False))
    return Pieces(ids, {p: float(-n) for n, p in enumerate(ids)}, byte_ids, names, not mixed)


def spaced(units: pa.Array) -> pa.Array:
    """Units as `Pieces.units` writes them."""
    return pc.replace_substring(units, " ", SPACE)


def prepared(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""
