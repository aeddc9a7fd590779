"""Bytes and words of whole Arrow columns as numpy arrays, and their hashes.

Everything here works on a flat byte buffer with document offsets, so the cost
per byte is that of a few numpy passes; no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
#: Bytes handled at once; whole documents, so a longer document makes a longer chunk.
CHUNK_BYTES = 1 << 20

_powers = np.ones(1, U64)
_inverses = np.ones(1, U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
#: The same with A-Z read as a-z.
LOWER_CODES = BYTE_CODES.copy()
LOWER_CODES[65:91] = BYTE_CODES[97:123]
#: True for the bytes 0x20 and 0x09 to 0x0D, which separate words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        _powers = np.concatenate([np.ones(1, U64), np.multiply.accumulate(np.full(size - 1, _BASE, U64))])
        _inverses = np.concatenate([np.ones(1, U64), np.multiply.accumulate(np.full(size - 1, _INVERSE, U64))])
    return _powers[:n], _inverses[:n]


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Sums from which span_hash reads the hash of any span of the codes."""
    out = np.zeros(len(codes) + 1, U64)
    np.cumsum(codes * _power_tables(len(codes))[0], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent 64-bit hashes of the spans [start, end)."""
    return mix((sums[ends] - sums[starts]) * _power_tables(len(sums))[1][starts])


def gram_hash(sums: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all spans of k codes."""
    n = len(sums) - k
    return mix((sums[k:] - sums[:n]) * _power_tables(len(sums))[1][:n])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary column without nulls; offsets start at 0."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(values, np.uint8)[offsets[0]: offsets[-1]] if values else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, bytes, offsets) of runs of whole documents of about the given size."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        yield first, data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, word offsets of the documents)."""
    if len(data) == 0:
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    solid = ~SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(data)]
    begins[edges] = solid[edges]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:]
    before = edges[edges > 0] - 1
    stops[before] = solid[before]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    hashes = span_hash(prefix_sums(codes[data]), starts, ends)
    return hashes, np.searchsorted(starts, offsets)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of all ranges, one after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
