"""Features that share a code.

The codes of several features are one joint code where few combinations occur, as with
the indicators of one category. A row is then added to a node's sums once for each bundle, not
for each feature, and what a bundle's joint codes add up to gives the sums of its features' codes.

Bundles are found by merging two at a time, by the combinations of all rows, so the
joint codes name every row's codes exactly; features with too many combinations stay alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from innlake.learners import bins

#: Joint codes of a bundle of several features.
JOINT_CODES = 256
#: Passes over the rows that look for bundles.
PASSES = 8
#: Codes of a category that a set holds: a tree's cuts are 32-bit integers when it is stored.
MOST_LEVELS = 31
_PAIRS = 1 << 16  # combinations that two bundles may have at most to be looked at


@dataclass
class Bundle:
    """Some features, and their codes by joint code; table turns two parts' codes into the joint one (None: one feature)."""

    features: list[int]
    codes: np.ndarray  # (features, joint codes)
    parts: tuple[Bundle, Bundle] | None = None
    table: np.ndarray | None = None

    @property
    def size(self) -> int:
        return self.codes.shape[1]

    @classmethod
    def merged(cls, one: Bundle, two: Bundle, pairs: np.ndarray) -> Bundle:
        """pairs: the combinations that occur, ascending."""
        table = np.zeros(one.size * two.size, bins.code_type([pairs]))
        table[pairs] = np.arange(len(pairs))
        codes = np.concatenate([one.codes[:, pairs // two.size], two.codes[:, pairs % two.size]])
        return cls(one.features + two.features, codes, (one, two), table)

    def of(self, codes: np.ndarray) -> np.ndarray:
        """Joint codes of (features, rows) codes."""
        if self.parts is None:
            return codes[self.features[0]]
        return self.table[_paired(*self.parts, codes)]


def _paired(one: Bundle, two: Bundle, codes: np.ndarray) -> np.ndarray:
    return one.of(codes).astype(np.int32) * two.size + two.of(codes)


def _key(one: Bundle, two: Bundle) -> frozenset[int]:
    """Bundles only grow, and with them the combinations: what failed once fails for good."""
    return frozenset((one.features[0], two.features[0]))


def _candidates(bundles: list[Bundle], hopeless: set[frozenset[int]]) -> list[tuple[int, int]]:
    """Places of bundles to try together: neighbours in order of size, each bundle once."""
    left, out = sorted(range(len(bundles)), key=lambda i: bundles[i].size), []
    while left:
        i = left.pop(0)
        for j in left:
            if bundles[i].size * bundles[j].size <= _PAIRS and _key(bundles[i], bundles[j]) not in hopeless:
                out.append((i, j))
                left.remove(j)
                break
    return out


def find(blocks: DataFrame, edges: list[np.ndarray]) -> list[Bundle]:
    """Bundles of all features, by the rows of the blocks (see bins.py)."""
    kind, n = bins.code_type(edges), len(edges)
    bundles = [Bundle([f], np.arange(len(e) + 1)[None, :]) for f, e in enumerate(edges)]
    hopeless: set[frozenset[int]] = set()
    for _ in range(PASSES):
        tried = _candidates(bundles, hopeless)
        if not tried:
            break
        pairs = [(bundles[i], bundles[j]) for i, j in tried]

        def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            marks = [np.zeros(one.size * two.size, bool) for one, two in pairs]
            for batch in batches:
                for row in batch.to_pylist():
                    codes, _ = bins.opened(row, n, kind)
                    for own, (one, two) in zip(marks, pairs):
                        own[_paired(one, two, codes)] = True
            for p, own in enumerate(marks):
                found = np.flatnonzero(own)
                if len(found) > JOINT_CODES:
                    found = np.array([-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), p, np.int32)), pa.array(found.astype(np.int32))], names=["pair", "seen"])

        found: list[list[int]] = [[] for _ in pairs]
        for r in blocks.mapInArrow(seen, "pair int, seen int").distinct().collect():  # bounded by JOINT_CODES a pair and task
            found[r["pair"]].append(r["seen"])
        gone: set[int] = set()
        for (i, j), (one, two), own in zip(tried, pairs, found):
            if -1 in own or len(own) > JOINT_CODES:
                hopeless.add(_key(one, two))
            else:
                gone |= {i, j}
                bundles.append(Bundle.merged(one, two, np.sort(np.array(own, np.int64))))
        bundles = [b for i, b in enumerate(bundles) if i not in gone]
    return bundles


def joint(blocks: DataFrame, edges: list[np.ndarray], bundles: list[Bundle]) -> DataFrame:
    """The blocks with joint codes, bundle by bundle, in place of the features' codes."""
    kind, n = bins.code_type(edges), len(edges)
    wide = code_type(bundles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, _ = bins.opened(row, n, kind)
                new = np.stack([b.of(codes).astype(wide) for b in bundles]) if bundles else codes
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]]), pa.array([row["n"]], pa.int32()), pa.array([new.tobytes()], pa.binary()),
                     pa.array([row["label"]], pa.binary())], names=["block", "n", "codes", "label"])

    return blocks.mapInArrow(run, bins.BLOCK_SCHEMA)


def code_type(bundles: list[Bundle]) -> type:
    return np.uint8 if max((b.size for b in bundles), default=0) <= 256 else np.uint16


def code_set(codes: list[int]) -> int:
    """A set of a category's codes, from 1 to MOST_LEVELS, as the bits of a number."""
    return sum(1 << (c - 1) for c in codes)


def _in_set(codes: np.ndarray, found: int) -> np.ndarray:
    return (found >> np.maximum(codes.astype(np.int64) - 1, 0)) & 1 == 1


class Joint:
    """Where bundles' codes stand in sums by joint code, and how these become sums by (feature, code)."""

    def __init__(self, bundles: list[Bundle], begin: np.ndarray, categories: frozenset[int] = frozenset()):
        """begin: the place of each feature's first code, and the end. categories: features cut by sets of codes."""
        self.categories = categories
        self.sizes = [b.size for b in bundles]
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)]).astype(int).tolist()
        self.features = [b.features for b in bundles]
        self.codes = [b.codes.astype(np.uint16) for b in bundles]
        self.places = [int(x) for x in begin]
        self.kind = code_type(bundles)
        self.home = {f: (b, i) for b, own in enumerate(self.features) for i, f in enumerate(own)}

    @classmethod
    def alone(cls, begin: np.ndarray, categories: frozenset[int] = frozenset()) -> Joint:
        """Each feature by itself."""
        return cls([Bundle([f], np.arange(n)[None, :]) for f, n in enumerate(np.diff(begin).tolist())], begin, categories)

    def side(self, feature: int, cut: int, missing_left: bool) -> tuple[int, np.ndarray]:
        """The bundle that tells a split's sides, and whether each of its joint codes goes left."""
        b, i = self.home[feature]
        code = self.codes[b][i]
        goes_left = _in_set(code, cut) if feature in self.categories else code <= cut
        return b, np.where(code == 0, missing_left, goes_left)

    @cached_property
    def _spread(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each bundle the places of its features' codes, and a 1 for each joint code and place."""
        out = []
        for features, codes in zip(self.features, self.codes):
            sizes = [self.places[f + 1] - self.places[f] for f in features]
            at = np.concatenate([np.arange(self.places[f], self.places[f + 1]) for f in features])
            ones = np.zeros((codes.shape[1], len(at)))
            for first, own in zip(np.cumsum([0, *sizes]), codes):
                ones[np.arange(codes.shape[1]), first + own] = 1
            out.append((at, ones))
        return out

    def by_feature(self, sums: np.ndarray) -> np.ndarray:
        """(..., places) of (..., joint places) sums."""
        out = np.zeros((*sums.shape[:-1], self.places[-1]))
        for b, (at, ones) in enumerate(self._spread):
            own = sums[..., self.begin[b]: self.begin[b + 1]]
            out[..., at] = own if len(self.features[b]) == 1 else own @ ones
        return out
