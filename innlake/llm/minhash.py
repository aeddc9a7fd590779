"""Shingle sets and MinHash signatures of whole Arrow columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from innlake.llm import units

U64 = np.uint64
#: Minima of a signature, kept as 32 bits each, and minima in a band.
MINIMA = 128
BAND = 4
BANDS = MINIMA // BAND
#: Documents hashed together; their number has to fit the bits that a shingle's hash leaves.
_DOC_BITS = 12

_SEED = np.arange(1, 2 * MINIMA + 1, dtype=U64)
_FACTORS = units.mix(_SEED[:MINIMA] * U64(0x9E3779B97F4A7C15)) | U64(1)
_SHIFTS = units.mix(_SEED[MINIMA:] * U64(0xD1B54A32D192ED03))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct 52-bit shingle hashes, offsets) of at most 4096 documents."""
    words, places = units.words(data, offsets, units.LOWER_CODES)
    counts = np.diff(places)
    sums = units.prefix_sums(words)
    full = np.maximum(0, counts - size + 1)
    short = np.flatnonzero((counts > 0) & (counts < size))
    at = units.ragged(places[:-1], full)
    grams = units.span_hash(sums, at, at + size)
    rest = units.span_hash(sums, places[:-1][short], places[1:][short])
    doc = np.concatenate([np.repeat(np.arange(len(full)), full), short]).astype(U64)
    keys = np.sort((doc << U64(64 - _DOC_BITS)) | (np.concatenate([grams, rest]) >> U64(_DOC_BITS)))
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    owner = (keys >> U64(64 - _DOC_BITS)).astype(np.int64)
    return keys & U64((1 << (64 - _DOC_BITS)) - 1), np.searchsorted(owner, np.arange(len(offsets)))


def each_set(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, hashes, offsets) of groups of documents."""
    for first, part, own in units.chunks(data, offsets):
        for at in range(0, len(own) - 1, 1 << _DOC_BITS):
            some = own[at: at + (1 << _DOC_BITS) + 1]
            yield first + at, *shingle_sets(part[some[0]: some[-1]], some - some[0], size)


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MINIMA numbers for each set: least values of as many universal hash functions; empty sets have zeros."""
    out = np.zeros((len(offsets) - 1, MINIMA), np.uint32)
    filled = np.flatnonzero(np.diff(offsets))
    if len(filled):
        heads = offsets[filled]
        for i in range(MINIMA):
            out[filled, i] = np.minimum.reduceat(hashes * _FACTORS[i] + _SHIFTS[i], heads) >> U64(32)
    return out


def set_keys(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set; equal sets have equal names."""
    view = memoryview(hashes.tobytes())
    return np.array([xxhash.xxh3_64_intdigest(view[8 * a: 8 * z]) for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist())],
                    np.uint64).view(np.int64)
