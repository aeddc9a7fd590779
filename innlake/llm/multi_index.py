"""Inverted multi-index: vectors in cells, pairs of codes of their two halves.

Each half has a codebook; a vector's codes are the nearest centres, and a code's
radius is the largest distance of its vectors from the centre. So for a query q
the half scores of a code's vectors lie within |q half| * radius of that with the
centre, and the sum over both halves bounds the scores in a cell. Sorted by
bound, the two codebooks are two sequences; a heap visits their pairs, the cells, by
falling sum.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_ROUNDS = 8


def centres(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k centres, or one for each different row if there are fewer."""
    rows = rows.astype(np.float64)
    different = np.unique(rows, axis=0)
    if len(different) <= k:
        return different
    found = different[np.random.default_rng(seed).choice(len(different), k, replace=False)]
    for _ in range(_ROUNDS):
        code, _ = nearest(rows, found)
        size = np.bincount(code, minlength=k)
        total = np.zeros_like(found)
        np.add.at(total, code, rows)
        found = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], found)
    return found


def nearest(rows: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the nearest centre, distance from it)."""
    code = np.empty(len(rows), np.int64)
    far = np.empty(len(rows))
    norm = (found * found).sum(axis=1) / 2
    for at in range(0, len(rows), 4096):
        part = rows[at: at + 4096]
        code[at: at + 4096] = own = (part @ found.T - norm).argmax(axis=1)
        far[at: at + 4096] = np.sqrt(((part - found[own]) ** 2).sum(axis=1))
    return code, far


@dataclass
class MultiIndex:
    """Codebooks of both halves; radii by code and vectors by cell are known once all vectors are placed."""

    left: np.ndarray
    right: np.ndarray
    left_radius: np.ndarray
    right_radius: np.ndarray
    counts: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, k: int, seed: int = 1) -> MultiIndex:
        half = sample.shape[1] // 2
        left, right = centres(sample[:, :half], k, seed), centres(sample[:, half:], k, seed + 1)
        return cls(left, right, np.zeros(len(left)), np.zeros(len(right)), np.zeros((len(left), len(right)), np.int64))

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, distance of the left half, of the right half)."""
        half = self.left.shape[1]
        (i, far_i), (j, far_j) = nearest(rows[:, :half], self.left), nearest(rows[:, half:], self.right)
        return i * len(self.right) + j, far_i, far_j

    def filled(self, cells: list[tuple[int, int, float, float]]) -> MultiIndex:
        """With (cell, vectors, largest distances) of all cells that hold vectors."""
        out = MultiIndex(self.left, self.right, np.full(len(self.left), -1.0), np.full(len(self.right), -1.0),
                         np.zeros_like(self.counts))
        for cell, n, far_i, far_j in cells:
            i, j = divmod(cell, len(self.right))
            out.counts[i, j] = n
            out.left_radius[i] = max(out.left_radius[i], far_i)
            out.right_radius[j] = max(out.right_radius[j], far_j)
        return out

    def walk(self, query: np.ndarray) -> Iterator[tuple[float, float, int, int]]:
        """(upper bound, lower bound, cell, vectors) of the cells that hold vectors, by falling upper bound."""
        half = self.left.shape[1]
        sides = []
        for q, book, radius in ((query[:half], self.left, self.left_radius), (query[half:], self.right, self.right_radius)):
            used = np.flatnonzero(radius >= 0)
            size = np.sqrt(q @ q)
            score, reach = book[used] @ q, size * radius[used]
            reach = reach + 0.5 + 1e-9 * (np.abs(score) + reach)  # above rounding
            order = np.argsort(-(score + reach), kind="stable")
            sides.append((used[order].tolist(), (score + reach)[order].tolist(), (score - reach)[order].tolist()))
        (i_codes, i_upper, i_lower), (j_codes, j_upper, j_lower) = sides
        if not i_codes:
            return
        heap, width = [(-(i_upper[0] + j_upper[0]), 0, 0)], len(self.right)
        while heap:
            bound, i, j = heapq.heappop(heap)
            n = int(self.counts[i_codes[i], j_codes[j]])
            if n:
                yield -bound, i_lower[i] + j_lower[j], i_codes[i] * width + j_codes[j], n
            # A pair follows the one before it in the second sequence, at the start of that, in the first.
            if j + 1 < len(j_codes):
                heapq.heappush(heap, (-(i_upper[i] + j_upper[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(i_codes):
                heapq.heappush(heap, (-(i_upper[i + 1] + j_upper[0]), i + 1, 0))

    def cells(self, query: np.ndarray, windows: list[tuple[int, int]], room: float = float("inf"),
              known: frozenset[int] = frozenset()) -> list[int]:
        """Cells that may hold scores in a window, by falling bound, until they hold `room` vectors or all windows are behind.

        Cells already known are left out.
        """
        out, held = [], 0
        least = min((low for low, _ in windows), default=None)
        if least is None:
            return out
        for upper, lower, cell, n in self.walk(query):
            if upper < least or held >= room:
                break
            if cell not in known and any(lower <= high and upper >= low for low, high in windows):
                out.append(cell)
                held += n
        return out


def bundles(counts: dict[int, int], size: int) -> dict[int, tuple[int, int]]:
    """cell -> (first bundle, bundles): small cells side by side share a bundle of at most `size`, large ones have several."""
    out, bundle, room = {}, -1, 0
    for cell in sorted(counts):
        n = counts[cell]
        if n > size:
            parts = -(-n // size)
            out[cell] = (bundle + 1, parts)
            bundle, room = bundle + parts, 0
        else:
            if n > room:
                bundle, room = bundle + 1, size
            out[cell] = (bundle, 1)
            room -= n
    return out
