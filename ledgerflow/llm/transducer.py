"""Minimal acyclic transducers over sorted terms: each maps its terms to their lexicographic ordinals.

Terms are byte strings. An automaton is made from the sorted terms one by one,
equal right parts are shared as soon as they are complete, and every arc tells
how many terms come before those that pass it. The ordinal of a term is the sum
along its path. Arcs are kept as sorted arrays, so many words are looked up at
once, byte by byte.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Sequence

import numpy as np

_BYTE = 8  # bits of a label in an arc's key


class Transducer:
    def __init__(self, keys: np.ndarray, targets: np.ndarray, skips: np.ndarray, final: np.ndarray, root: int, size: int, longest: int):
        self._keys, self._targets, self._skips, self._final = keys, targets, skips, final
        self._root, self.size, self._longest = root, size, longest

    @classmethod
    def build(cls, terms: Iterable[bytes]) -> Transducer:
        """From distinct terms in ascending order."""
        states: dict[tuple, int] = {}
        told: list[tuple[bool, list[tuple[int, int]]]] = []
        below: list[int] = []  # terms from a state on

        def share(final: bool, arcs: list[tuple[int, int]]) -> int:
            """The state with these arcs, made where there is none."""
            known = states.setdefault((final, *arcs), len(told))
            if known == len(told):
                told.append((final, arcs))
                below.append(final + sum(below[target] for _, target in arcs))
            return known

        # open states along the last term: whether it is a term, its complete arcs
        path: list[tuple[list[bool], list[tuple[int, int]]]] = [([False], [])]
        last, size, longest = b"", 0, 0

        def close(down_to: int) -> None:
            while len(path) - 1 > down_to:
                final, arcs = path.pop()
                path[-1][1].append((last[len(path) - 1], share(final[0], arcs)))

        for term in terms:
            if size and term <= last:
                raise ValueError("terms must be distinct and in ascending order")
            common, most = 0, min(len(last), len(term))
            while common < most and last[common] == term[common]:
                common += 1
            close(common)
            path.extend(([False], []) for _ in range(len(term) - common))
            path[-1][0][0] = True
            last, size, longest = term, size + 1, max(longest, len(term))
        close(0)
        root = share(path[0][0][0], path[0][1])

        keys, targets, skips = [], [], []
        for state, (final, arcs) in enumerate(told):
            before = int(final)
            for label, target in arcs:
                keys.append(state << _BYTE | label)
                targets.append(target)
                skips.append(before)
                before += below[target]
        return cls(np.array(keys, np.int64), np.array(targets, np.int32), np.array(skips, np.int64), np.array([f for f, _ in told], bool), root, size, longest)

    @property
    def states(self) -> int:
        return len(self._final)

    def to_bytes(self) -> bytes:
        return pickle.dumps((self._keys, self._targets, self._skips, self._final, self._root, self.size, self._longest), protocol=5)

    @classmethod
    def from_bytes(cls, blob: bytes) -> Transducer:
        return cls(*pickle.loads(blob))

    def ordinals(self, words: Sequence[bytes]) -> np.ndarray:
        """The ordinal of each word, -1 where it is no term."""
        out = np.full(len(words), -1, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        at = np.flatnonzero(lengths <= self._longest)
        if not len(at) or not self.size:
            return out
        data = np.frombuffer(b"".join([words[i] for i in at.tolist()]), np.uint8)
        ends = np.cumsum(lengths[at])
        begins = ends - lengths[at]
        state = np.full(len(at), self._root, np.int64)
        total = np.zeros(len(at), np.int64)
        alive = np.arange(len(at))
        step = 0
        while len(alive):
            over = begins[alive] + step == ends[alive]
            done = alive[over]
            hit = done[self._final[state[done]]]
            out[at[hit]] = total[hit]
            alive = alive[~over]
            if not len(alive) or not len(self._keys):
                break
            key = state[alive] << _BYTE | data[begins[alive] + step]
            arc = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            there = self._keys[arc] == key
            alive, arc = alive[there], arc[there]
            state[alive] = self._targets[arc]
            total[alive] += self._skips[arc]
            step += 1
        return out

    def term(self, ordinal: int) -> bytes:
        """The term of an ordinal."""
        if not 0 <= ordinal < self.size:
            raise IndexError(ordinal)
        out, state = bytearray(), self._root
        while not (self._final[state] and ordinal == 0):
            first, end = np.searchsorted(self._keys, [state << _BYTE, state + 1 << _BYTE])
            arc = first + int(np.searchsorted(self._skips[first:end], ordinal, side="right")) - 1
            out.append(int(self._keys[arc]) & 255)
            ordinal -= int(self._skips[arc])
            state = int(self._targets[arc])
        return bytes(out)
