"""Repeats inside a collection of texts, read from a run-length compressed index.

The texts are joined by a byte that UTF-8 never uses, suffix-sorted, and their
Burrows-Wheeler transform is cut into runs. For the suffix at a run's head the
length of the match with its predecessor is sampled, at a run's end that with
its successor, and at the start of each text both. Between two samples, in text order, that length falls by one a
byte: inside a run, stepping one byte back in the text extends both neighbours
by the same byte. So the samples, of which there are as many as runs, give the
matching statistics of every position in one stream over the text. Repetitive
texts have few runs.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = 0xFF
_SWAP = np.dtype(">u8")


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as numbers that sort like them."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    views = [padded[i: i + (len(padded) - i) // 8 * 8].view(_SWAP) for i in range(8)]
    out = np.zeros(len(text), np.uint64)
    for i, view in enumerate(views):
        part = out[i::8]
        part[:] = view[: len(part)]
    return out


def _order(keys: np.ndarray, bits: int) -> np.ndarray:
    """Positions in the order of keys of so many bits; one sort of packed numbers where they fit."""
    width = max(1, (len(keys) - 1).bit_length())
    if bits + width > 64:
        return np.argsort(keys)
    shift = np.uint64(width)
    packed = np.sort((keys.astype(np.uint64) << shift) | np.arange(len(keys), dtype=np.uint64))
    return (packed & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)


def suffix_array(text: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the compared length for those still tied."""
    n = len(text)
    step = 5
    first = words >> np.uint64(8 * (8 - step))
    order = _order(first, 8 * step)
    first = first[order]
    head = np.concatenate([[True], first[1:] != first[:-1]])
    rank = np.zeros(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    width = n.bit_length()
    tied = np.flatnonzero(~(head & np.append(head[1:], True)))
    while len(tied):
        suffix = order[tied]
        far = suffix + step
        key = (rank[suffix] << width) | np.where(far < n, rank[np.minimum(far, n - 1)] + 1, 0)
        by_key = _order(key, 2 * width)
        key = key[by_key]
        order[tied] = suffix = suffix[by_key]
        new_head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[suffix] = np.maximum.accumulate(np.where(new_head, tied, 0))
        tied = tied[~(new_head & np.append(new_head[1:], True))]
        step *= 2
    return order


def _common(words: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray, least: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, cut at limit; 0 if shorter than least."""
    n = len(words)
    out = np.zeros(len(a), np.int64)
    live = np.flatnonzero((limit >= least) & (np.maximum(a, b) + least <= n))
    if least >= 8:  # most short matches differ in the last bytes already
        tail = least - 8
        live = live[words[a[live] + tail] == words[b[live] + tail]]
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        inside = (np.maximum(x, y) < n) & (out[live] < limit[live])
        live, x, y = live[inside], x[inside], y[inside]
        differ = words[x] ^ words[y]
        rest = differ != 0
        # Whole equal bytes before the first one that differs.
        for byte in range(7):
            out[live[rest]] += (differ[rest] >> np.uint64(56 - 8 * byte) == 0)
        live = live[~rest]
        out[live] += 8
    out = np.minimum(out, limit)
    out[out < least] = 0
    return out


class RunIndex:
    """Runs of the transform and the matches sampled at their two ends."""

    def __init__(self, texts: list[bytes], least: int = 1):
        """Matches shorter than `least` count as none."""
        self.sizes = np.array([len(t) for t in texts], np.int64)
        joined = bytes([SEPARATOR]).join(texts) + bytes([SEPARATOR])
        text = np.frombuffer(joined, np.uint8)
        words = _words(text)
        order = suffix_array(text, words)
        before = text[order - 1]  # the transform; position 0 takes the closing separator
        change = before[1:] != before[:-1]
        heads = np.concatenate([[0], np.flatnonzero(change) + 1])
        ends = np.append(heads[1:], len(text)) - 1
        self.starts = np.concatenate([[0], np.cumsum(self.sizes + 1)[:-1]])
        self.n = len(text)
        self.runs = len(heads)
        stop = np.repeat(self.starts + self.sizes, self.sizes + 1)
        self._stop = stop
        # Matches end with their text, so each text's first byte is sampled as well.
        place = np.empty(self.n, np.int64)
        place[order] = np.arange(self.n)
        firsts = place[self.starts]
        self.head_at, self.head_match = self._sampled(words, order, np.union1d(heads, firsts), -1, least)
        self.end_at, self.end_match = self._sampled(words, order, np.union1d(ends, firsts), 1, least)

    def _sampled(self, words, order, at, side, least):
        near = at + side
        inside = (near >= 0) & (near < self.n)
        suffix = order[at]
        limit = np.where(inside, np.maximum(0, self._stop[suffix] - suffix), 0)
        match = _common(words, suffix, order[np.clip(near, 0, self.n - 1)], limit, least)
        by_place = _order(suffix, self.n.bit_length())
        return suffix[by_place], match[by_place]

    def matching_statistics(self) -> np.ndarray:
        """For each position the longest match with a suffix that starts elsewhere, inside its text."""
        out = np.zeros(self.n, np.int64)
        place = np.arange(self.n)
        for at, match in ((self.head_at, self.head_match), (self.end_at, self.end_match)):
            sample = np.zeros(self.n, np.int64)
            sample[at] = np.arange(len(at))
            sample = np.maximum.accumulate(sample)
            out = np.maximum(out, (match + at)[sample] - place)
        return np.minimum(out, np.maximum(0, self._stop - place))

    def repeats(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, end) of the runs of starts whose `length` bytes occur elsewhere; end is of the bytes."""
        long = self.matching_statistics() >= length
        edges = np.diff(np.concatenate([[0], long.astype(np.int8), [0]]))
        begin, stop = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        which = np.searchsorted(self.starts, begin, side="right") - 1
        return which, begin - self.starts[which], stop - 1 + length - self.starts[which]
