"""Term vectors of documents as a trie, and its best documents for an item.

Terms are numbered by falling document frequency, so that documents' sorted terms
share long heads: a node is a term after the terms above it, and knows the largest
tf of its term among the documents below. Sorted by their paths, the documents
below a node stand side by side. Two cuts through the trie, subtrees (and
sibling subtrees side by side) of at most BRANCH and of at most TWIG documents, know
for each term the largest tf and the least m below; as a score grows with tf and
falls with m, these bound the score of every document below.

An item goes down depth-first, into the branches, their twigs and those twigs'
documents by falling bound, and stops where a bound is below its k-th best score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from innlake.llm import units

BRANCH = 1024
TWIG = 64


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's share of a score, before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


@dataclass
class Level:
    """Units side by side (branches, twigs or documents): largest tf by (term, unit), least m by unit."""

    keys: np.ndarray  # term * units + unit, ascending
    tf: np.ndarray
    m: np.ndarray
    begin: np.ndarray  # first unit of the next level below each unit, and the end

    def bounds(self, terms: np.ndarray, weights: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Bounds of the scores in the units lo to hi."""
        n = len(self.m)
        first = np.searchsorted(self.keys, terms * n + lo)
        sizes = np.searchsorted(self.keys, terms * n + hi) - first
        at = units.ragged(first, sizes)
        unit = self.keys[at] % n
        out = np.zeros(hi - lo, np.int64)
        np.add.at(out, unit - lo, np.repeat(weights, sizes) * part(self.tf[at], self.m[unit]))
        return out


def _grouped(keys: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the largest tf of each."""
    order = np.argsort(keys, kind="stable")
    keys, tf = keys[order], tf[order]
    heads = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[heads], np.maximum.reduceat(tf, heads) if len(heads) else tf


def subtrees(shared: np.ndarray, lo: int, hi: int, size: int) -> list[int]:
    """Where subtrees of at most `size` documents begin; small siblings side by side are taken together.

    shared[i] is the number of terms that document i has in common with the one before it.
    """
    begins, todo = [], [(lo, hi)]
    while todo:
        a, b = todo.pop()
        if b - a <= size:
            begins.append(a)
            continue
        inner = shared[a + 1: b]
        cuts = [a, *(a + 1 + np.flatnonzero(inner == inner.min())).tolist(), b]
        start, runs = a, []
        for before, at in zip(cuts, cuts[1:]):  # children of the subtree's top
            if at - start > size and before > start:
                runs.append((start, before))
                start = before
        runs.append((start, b))
        todo += reversed(runs)
    return begins


class DocTree:
    """Trie of documents with sorted terms; ids, m by document, terms and tf by entry, offsets of the documents."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, offsets: np.ndarray, terms: np.ndarray, tf: np.ndarray):
        raw = terms.astype(">u4").tobytes()
        paths = [raw[4 * a: 4 * b] for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
        order = np.array(sorted(range(len(ids)), key=paths.__getitem__), np.int64)
        sizes = np.diff(offsets)[order]
        at = units.ragged(offsets[order], sizes)
        terms, tf = terms[at].astype(np.int64), tf[at].astype(np.int64)
        self.ids, m = ids[order], m[order]
        n, offsets = len(ids), np.concatenate([[0], np.cumsum(sizes)])
        shared = self._shared(terms, offsets)
        node_term, node_tf, first, last = self._nodes(terms, tf, offsets, shared)
        self.nodes, self.entries = len(node_term), len(terms)

        branch = np.array(subtrees(shared, 0, n, BRANCH), np.int64)
        twig = np.array([t for a, b in zip(branch, np.append(branch[1:], n)) for t in subtrees(shared, a, b, TWIG)], np.int64)
        twig_of = np.searchsorted(twig, np.arange(n), side="right") - 1
        # A node above several twigs stands for its term in each of them.
        covered = twig_of[last - 1] - twig_of[first] + 1
        keys = np.repeat(node_term * len(twig), covered) + units.ragged(twig_of[first], covered)
        twig_keys, twig_tf = _grouped(keys, np.repeat(node_tf, covered))
        branch_of = np.searchsorted(branch, twig, side="right") - 1
        branch_keys, branch_tf = _grouped(
            twig_keys // len(twig) * len(branch) + branch_of[twig_keys % len(twig)], twig_tf)
        doc_keys = terms * n + np.repeat(np.arange(n), sizes)
        by_term = np.argsort(doc_keys)
        self.levels = [
            Level(branch_keys, branch_tf, np.minimum.reduceat(m, branch), np.append(np.searchsorted(twig, branch), len(twig))),
            Level(twig_keys, twig_tf, np.minimum.reduceat(m, twig), np.append(twig, n)),
            Level(doc_keys[by_term], tf[by_term], m, np.zeros(0, np.int64))]
        self.scored = 0

    @staticmethod
    def _shared(terms: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Leading terms that each document has in common with the one before; 0 for the first."""
        sizes = np.diff(offsets)
        least = np.minimum(sizes[1:], sizes[:-1])
        out = np.zeros(len(sizes), np.int64)
        if len(least):
            place = units.ragged(np.zeros(len(least), np.int64), least)
            unlike = terms[place + np.repeat(offsets[:-2], least)] != terms[place + np.repeat(offsets[1:-1], least)]
            begin = np.concatenate([[0], np.cumsum(least)[:-1]])
            out[1:] = np.minimum.reduceat(np.where(unlike, place, np.repeat(least, least)), begin)
        return out

    @staticmethod
    def _nodes(terms: np.ndarray, tf: np.ndarray, offsets: np.ndarray, shared: np.ndarray) -> tuple:
        """(term, largest tf, first document, last document + 1) of every node."""
        n = len(shared)
        sizes = np.diff(offsets)
        fresh = sizes - shared
        number = np.concatenate([[0], np.cumsum(fresh)])  # a document's new nodes are numbered in a row
        last = np.full(number[-1], n, np.int64)
        path = np.zeros(int(sizes.max(initial=0)), np.int64)
        node = np.zeros(len(terms), np.int64)
        deep = 0
        for i, (common, size, begin, own) in enumerate(zip(shared.tolist(), sizes.tolist(), offsets.tolist(), number.tolist())):
            last[path[common:deep]] = i
            path[common:size] = np.arange(own, own + size - common)
            node[begin: begin + size] = path[:size]
            deep = size
        node_tf = np.zeros(number[-1], np.int64)
        np.maximum.at(node_tf, node, tf)
        heads = units.ragged(offsets[:-1] + shared, fresh)
        return terms[heads], node_tf, np.repeat(np.arange(n), fresh), last

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray]) -> tuple:
        """(ids, scores) of the k best of `best` and of these documents; equal scores go by id."""
        def down(depth: int, lo: int, hi: int) -> None:
            nonlocal best
            level = self.levels[depth]
            bounds = level.bounds(terms, weights, lo, hi)
            if depth == len(self.levels) - 1:
                self.scored += hi - lo
                good = np.flatnonzero(bounds >= least())
                ids, scores = np.append(best[0], self.ids[lo + good]), np.append(best[1], bounds[good])
                keep = np.lexsort((ids, -scores))[:k]
                best = ids[keep], scores[keep]
                return
            for unit in np.argsort(-bounds, kind="stable"):
                if bounds[unit] < least():
                    break
                down(depth + 1, int(level.begin[lo + unit]), int(level.begin[lo + unit + 1]))

        def least() -> int:
            return max(1, int(best[1][-1])) if len(best[1]) == k else 1

        down(0, 0, len(self.levels[0].m))
        return best
