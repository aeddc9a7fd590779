"""Token ids of whole texts from the ids of their chunks.

Where a tokenizer never joins text across certain places, a text's ids are its
chunks' ids one after another. Chunks repeat far more often than texts, so each
worker encodes a chunk once and remembers it by a hash of its bytes and their
number; numpy puts the texts together.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from innlake.llm.units import BYTE_CODES, U64, mix, prefix_sums, ragged, span_hash

#: Chunks that a worker remembers; the ones of the current batch always stay.
REMEMBERED = 1_000_000
#: Chunks given to the tokenizer at once, which bounds the objects it makes.
_AT_ONCE = 4096
_LED = U64(0x5851F42D4C957F2D)


def by_lists(encode: Callable[[list[str]], list[list[int]]]) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """From lists of ids to (all ids, number of each)."""
    def run(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = encode(chunks)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((x for ids in found for x in ids), np.int64, int(sizes.sum())), sizes
    return run


class ChunkCodes:
    """encode gets chunks as str and returns all their ids and the number of each."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], dtype: type,
                 remembered: int = REMEMBERED):
        self._encode, self._dtype, self._limit = encode, dtype, remembered
        self._forget()

    def _forget(self) -> None:
        self._slots: dict[int, int] = {}
        self._ids = np.zeros(1 << 16, self._dtype)
        self._starts = np.zeros(1 << 16, np.int64)

    def _learn(self, names: list[int], chunks: list[str]) -> None:
        for first in range(0, len(chunks), _AT_ONCE):
            flat, sizes = self._encode(chunks[first: first + _AT_ONCE])
            base = len(self._slots)
            self._slots.update(zip(names[first: first + _AT_ONCE], range(base, base + len(sizes))))
            at = int(self._starts[base])
            while len(self._ids) < at + len(flat):
                self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
            while len(self._starts) < base + len(sizes) + 1:
                self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
            self._ids[at: at + len(flat)] = flat
            self._starts[base + 1: base + len(sizes) + 1] = at + np.cumsum(sizes)

    def _slots_of(self, names: list[int], chunk: Callable[[int], str]) -> np.ndarray:
        """Places of distinct chunks; chunk(i) is the text of the i-th name."""
        get = self._slots.get
        slots = np.fromiter((get(n, -1) for n in names), np.int64, len(names))
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            if self._slots and len(self._slots) + len(missing) > self._limit:
                self._forget()
                missing = np.arange(len(names))
            base = len(self._slots)
            self._learn([names[i] for i in missing], [chunk(i) for i in missing.tolist()])
            slots[missing] = base + np.arange(len(missing))
        return slots

    def encode(self, data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray,
               lead: str = "") -> tuple[np.ndarray, np.ndarray]:
        """(ids, id offsets of the texts). cuts: True for the bytes that begin a chunk; texts begin one anyway.

        lead goes before the first chunk of every text that isn't empty.
        """
        if not len(data):
            return np.zeros(0, self._dtype), np.zeros(len(offsets), np.int64)
        first = offsets[:-1][np.diff(offsets) > 0]
        cuts = cuts.copy()
        cuts[first] = True
        begin = np.flatnonzero(cuts)
        end = np.append(begin[1:], len(data))
        names = mix(span_hash(prefix_sums(BYTE_CODES[data]), begin, end) ^ (end - begin).astype(U64))
        if lead:
            heads = np.searchsorted(begin, first)
            names[heads] = mix(names[heads] ^ _LED)
        coded = pa.array(names.view(np.int64)).dictionary_encode()
        which = coded.indices.to_numpy()
        distinct = coded.dictionary.to_pylist()
        sample = np.zeros(len(distinct), np.int64)
        sample[which] = np.arange(len(which))
        led = np.zeros(len(begin), bool)
        if lead:
            led[heads] = True
        raw = data.tobytes()

        def chunk(i: int) -> str:
            at = sample[i]
            text = raw[begin[at]: end[at]].decode()
            return lead + text if led[at] else text

        codes = self._slots_of(distinct, chunk)[which]
        starts = self._starts[codes]
        sizes = self._starts[codes + 1] - starts
        ids = self._ids[ragged(starts, sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, ends[np.searchsorted(begin, offsets)]


def gap_starts(gaps: np.ndarray) -> np.ndarray:
    """Cuts where a gap follows other text: a chunk takes the gap before it along."""
    cuts = gaps.copy()
    cuts[1:] &= ~gaps[:-1]
    return cuts
