"""Forests of trees without a bound on depth, and extra trees.

Nodes with many rows are split by passes over blocks of coded rows (see bins.py):
a tree and node's sums are merged in Spark, where its best split is also chosen, so
what comes to the driver is one row a node. Once a node has at most TASK_ROWS rows,
they go to one task, which grows the rest of the tree level by level in numpy.
Such nodes of all trees are finished side by side.

A forest cuts at the best place among a feature's codes. Extra trees draw one
threshold for each feature and node, evenly between its least and largest value there:
that takes two aggregates a level, one for the ends and one for the two sides.

The finished subtrees are a table, each of them one packed value: readers hold many rows at a time, and lists of nodes
would take several times the room. Scoring sends them to all workers if they are
small enough, else blocks of rows meet their subtrees by (tree, node).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.learners import bins
from innlake.learners.trees import LEAF, TREE_FIELDS, Tree
from innlake.session import scratch_path

TASK_ROWS = 131_072
#: Codes of features that are added up at once, and rows from which on that is tried.
PACK_CODES, PACK_ROWS = 64, 4096
#: Subtrees that are read at once, about.
GROUP_BYTES = 16 << 20
#: Nodes of a forest that every worker may hold.
SHARED_NODES = 5_000_000


@dataclass(frozen=True)
class ForestSpec:
    """classes: number of classes, 0 for regression. features: how many are drawn for a node, 0 for all."""

    classes: int = 0
    trees: int = 100
    features: int = 0
    bootstrap: bool = True
    random_cuts: bool = False
    max_depth: int = 1 << 30
    seed: int = 42
    bins: int = bins.BINS

    @property
    def outputs(self) -> int:
        return max(1, self.classes)


def weights(spec: ForestSpec, tree: int, row: dict) -> np.ndarray:
    """Weights of a block's rows in a tree: how often it draws them, times their own if the block has such."""
    own = np.frombuffer(row["weight"]) if row.get("weight") is not None else np.ones(row["n"])
    return own * np.random.default_rng([spec.seed, tree, row["block"]]).poisson(1.0, row["n"]) if spec.bootstrap else own


def _sums(spec: ForestSpec, key: np.ndarray, n: int, labels: np.ndarray, w: np.ndarray) -> np.ndarray:
    """(n, outputs) sums by key: weights by class, or of weighted labels. One pass however many classes there are."""
    if spec.classes:
        return np.bincount(key * spec.classes + labels, w, n * spec.classes).reshape(n, spec.classes)
    return np.bincount(key, w * labels, n)[:, None]


def _coded(spec: ForestSpec, labels: np.ndarray) -> np.ndarray:
    """Labels as they are summed: classes are whole numbers."""
    return labels.astype(np.int64) if spec.classes else labels


def _quality(sums: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Summed squares of (n, outputs) over weight: what a split raises as it lowers impurity or variance."""
    return np.where(w > 0, np.einsum("ij,ij->i", sums, sums) / np.where(w > 0, w, 1), 0)


def _first_best(gain: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owners, place of each one's first largest gain); owners ascend."""
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    most = np.maximum.reduceat(gain, heads)
    at = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(heads, len(owner)))))
    found, first = np.unique(owner[at], return_index=True)
    return found, at[first]


@dataclass
class _Pack:
    """Features of which a row has at most one that isn't at its commonest code, and so one code for all of them.

    sides: (codes, cuts), 1 where a code goes left at a cut. feature, cut: of each cut, ascending.
    """

    sides: np.ndarray
    feature: np.ndarray
    cut: np.ndarray


def _packs(codes: np.ndarray, n_features: int) -> tuple[list[_Pack], list[np.ndarray]]:
    """(packs of the features that vary, each one's codes of the rows); features of more than PACK_CODES codes are left out."""
    features, common, found = [], {}, {}
    for f in range(n_features):
        n = np.bincount(codes[:, f])
        found[f] = np.flatnonzero(n)
        if 1 < len(found[f]) <= PACK_CODES:
            features.append(f)
            common[f] = int(n.argmax())

    def dealt(some: np.ndarray) -> list[list[int]]:
        odd = np.stack([some[:, f] != common[f] for f in features], axis=1).astype(np.float32)
        meet = odd.T @ odd > 0
        out: list[list[int]] = []
        for i, f in enumerate(features):
            for own in out:
                if not meet[i, own].any() and sum(len(found[features[j]]) - 1 for j in own) + len(found[f]) <= PACK_CODES:
                    own.append(i)
                    break
            else:
                out.append([i])
        return [[features[i] for i in own] for own in out]

    def coded(own: list[int]) -> np.ndarray | None:
        """Codes of a pack; None if two features of a row aren't at their commonest."""
        out, top = np.zeros(len(codes), np.int64), 0
        odd = np.zeros(len(codes), np.uint8)
        for f in own:
            others = found[f][found[f] != common[f]]
            table = np.zeros(found[f][-1] + 1, np.int64)
            table[others] = top + 1 + np.arange(len(others))
            top += len(others)
            at = table[codes[:, f]]
            odd += at > 0
            out += at
        return out if odd.max() < 2 else None

    if not features:
        return [], []
    groups = dealt(codes[:4096])
    held = [coded(own) for own in groups]
    if any(own is None for own in held):
        groups = dealt(codes)
        held = [coded(own) for own in groups]
    packs = []
    for own in groups:
        each = {f: [common[f]] for f in own}  # each feature's code by the pack's
        for f in own:
            others = found[f][found[f] != common[f]]
            for g in own:
                each[g] += others.tolist() if g == f else [common[g]] * len(others)
        cuts = [(f, int(c)) for f in own for c in found[f][:-1]]
        sides = np.stack([np.array(each[f]) <= c for f, c in cuts], axis=1).astype(np.float64)
        packs.append(_Pack(sides, *(np.array(x) for x in zip(*cuts))))
    return packs, held


class _Level:
    """Rows of the nodes of one level, sorted by node, and the best splits found for them.

    A feature is looked at only in nodes where it has two codes: deep ones have few such. A turn takes one
    feature of each node, so there are as many turns as the node with most such features has. Where nodes have many rows and all
    features are asked, packs of features are added up at once (see _Pack).
    """

    def __init__(self, spec: ForestSpec, sizes: np.ndarray, codes: np.ndarray, labels: np.ndarray, w: np.ndarray, counts: np.ndarray):
        """codes: (rows, features), made up to whole words of 64 bits. counts: rows of each node."""
        self.spec, self.sizes, self.codes, self.labels, self.w, self.counts = spec, sizes, codes, labels, w, counts
        self.n_nodes, self.heads = len(counts), np.cumsum(counts) - counts
        self.node = np.repeat(np.arange(self.n_nodes), counts)
        self.total_w = np.add.reduceat(w, self.heads)
        self.total = _sums(spec, self.node, self.n_nodes, labels, w)
        self.gain = np.full(self.n_nodes, -np.inf)
        self.feature, self.cut = np.full(self.n_nodes, LEAF), np.zeros(self.n_nodes, np.int64)

    def look(self, mixed: np.ndarray, wanted: int, values: list[np.ndarray], rng: np.random.Generator,
             packs: list[_Pack], packed: list[np.ndarray]) -> bool:
        """Finds splits of the mixed nodes by the features drawn, and by the others only where these have no cut.

        Whether the packs were of use.
        """
        drawn = rng.random((self.n_nodes, len(self.sizes)))
        first = np.ones(drawn.shape, bool)
        if wanted < len(self.sizes):
            first = drawn <= np.partition(drawn, wanted - 1, axis=1)[:, wanted - 1:wanted]
        varies = self.varies() & mixed[:, None]
        again = mixed & ~(first & varies).any(axis=1)
        asked = np.where(again[:, None], ~first, first) & varies
        if not self.spec.random_cuts:
            cells, n_cells = self._cells(mixed) if packs else (None, 0)
            use = bool(packs) and self._cheaper(packs, n_cells, asked)
            if use:
                for pack, codes in zip(packs, packed):
                    self.packed_cuts(pack, codes, mixed, cells, n_cells)
                    asked[:, pack.feature] = False
            self.best_cuts(asked)
            return use
        share = np.zeros((len(self.sizes), self.n_nodes))
        for those in (mixed[:, None] & first, again[:, None] & ~first):
            for f in np.flatnonzero(those.any(axis=0)).tolist():
                drawn_here = rng.random(self.n_nodes)
                share[f] = np.where(those[:, f], drawn_here, share[f])
        self.random_cuts(asked, values, share)
        return False

    def _cells(self, mixed: np.ndarray) -> tuple[np.ndarray, int]:
        """Of each row, the place of its node, or of its node and class, among those that occur; and how many these are."""
        if not self.spec.classes:
            return self.node, self.n_nodes
        key = self.node * self.spec.classes + self.labels
        there = np.zeros(self.n_nodes * self.spec.classes, bool)
        there[key] = True
        return (np.cumsum(there) - 1)[key], int(there.sum())

    def _cheaper(self, packs: list[_Pack], n_cells: int, asked: np.ndarray) -> bool:
        """Whether adding up packs costs less than turns: rough costs of a row's code, and of a cut in a cell."""
        cuts = sum(len(p.cut) for p in packs)
        return len(packs) * 12 * len(self.w) + 14 * cuts * n_cells < 24 * int((asked.sum(axis=1) * self.counts).sum())

    def packed_cuts(self, pack: _Pack, codes: np.ndarray, mixed: np.ndarray, cells: np.ndarray, n_cells: int) -> None:
        """Offers the mixed nodes the best cuts of a pack. A side's weight is a sum of weights above 0, so it's 0 if no row goes there."""
        size = len(pack.sides)
        key = codes * n_cells + cells
        held = np.bincount(key, self.w, size * n_cells).reshape(size, n_cells)
        sides = pack.sides.T, 1 - pack.sides.T
        if self.spec.classes:
            heads = np.flatnonzero(np.diff(self._cell_nodes(cells, n_cells), prepend=-1))
            parts = [side @ held for side in sides]
            weights = [np.add.reduceat(x, heads, axis=1) for x in parts]
            squares = [np.add.reduceat(x * x, heads, axis=1) for x in parts]
        else:
            sums = np.bincount(key, self.w * self.labels, size * n_cells).reshape(size, n_cells)
            left = sides[0] @ sums
            weights = [side @ held for side in sides]
            squares = [left * left, (self.total[:, 0] - left) ** 2]
        good = (weights[0] > 0) & (weights[1] > 0) & mixed
        gain = sum(x / np.where(good, n, 1) for x, n in zip(squares, weights))
        gain[~good] = -np.inf
        at = gain.argmax(axis=0)
        self._offer(np.arange(self.n_nodes), pack.feature[at], gain[at, np.arange(self.n_nodes)], pack.cut[at])

    def _cell_nodes(self, cells: np.ndarray, n_cells: int) -> np.ndarray:
        out = np.empty(n_cells, np.int64)
        out[cells] = self.node
        return out

    def varies(self) -> np.ndarray:
        """(nodes, features): whether a node's rows have two codes of a feature."""
        words = self.codes.view(np.uint64)
        unlike = np.stack([np.bitwise_or.reduceat(own ^ np.repeat(own[self.heads], self.counts), self.heads) for own in words.T], axis=1)
        return np.ascontiguousarray(unlike).view(self.codes.dtype)[:, :len(self.sizes)] != 0

    def turns(self, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(nodes, the feature of each, their rows, each row's place among the nodes, its code), features of a node ascending."""
        n = asked.sum(axis=1)
        features, first = np.nonzero(asked)[1], np.cumsum(n) - n
        flat, width = self.codes.ravel(), self.codes.shape[1]
        for turn in range(n.max(initial=0)):
            open_ = n > turn
            nodes = np.flatnonzero(open_)
            own, counts = features[first[nodes] + turn], self.counts[nodes]
            rows = np.flatnonzero(np.repeat(open_, self.counts))
            place = np.repeat(np.arange(len(nodes)), counts)
            yield nodes, own, rows, place, flat.take(rows * width + np.repeat(own, counts))

    def _offer(self, nodes: np.ndarray, feature: np.ndarray, gain: np.ndarray, cut: np.ndarray) -> None:
        better = (gain > self.gain[nodes]) | (gain == self.gain[nodes]) & (gain > -np.inf) & (feature < self.feature[nodes])
        nodes = nodes[better]
        self.gain[nodes], self.feature[nodes], self.cut[nodes] = gain[better], feature[better], cut[better]

    def best_cuts(self, asked: np.ndarray) -> None:
        """Offers nodes the best cuts of the asked (nodes, features), which vary there."""
        for nodes, feature, rows, place, code in self.turns(asked):
            size, w = self.sizes[feature], self.w[rows]
            begin = np.cumsum(size) - size
            key = begin[place] + code
            if begin[-1] + size[-1] <= 16 * len(rows) + 4096:
                there = np.zeros(begin[-1] + size[-1], bool)
                there[key] = True
                cells, key = np.flatnonzero(there), (np.cumsum(there) - 1)[key]
                owner = np.repeat(np.arange(len(nodes)), size)[cells]
            else:
                cells, key = np.unique(key, return_inverse=True)
                owner = np.searchsorted(begin, cells, side="right") - 1
            n = len(cells)
            cell_w, sums = np.bincount(key, w, n), _sums(self.spec, key, n, self.labels[rows], w)
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            before_w, before = np.cumsum(cell_w), np.cumsum(sums, axis=0)
            inner = np.flatnonzero(owner[:-1] == owner[1:])  # after a node's last cell nothing would go right
            own = owner[inner]
            first = heads[own]
            left_w = before_w[inner] - (before_w - cell_w)[first]
            left = before[inner] - (before[heads] - sums[heads])[own]
            whole = nodes[own]
            gain = _quality(left, left_w) + _quality(self.total[whole] - left, self.total_w[whole] - left_w)
            found, at = _first_best(gain, own)
            self._offer(nodes[found], feature[found], gain[at], cells[inner[at]] - begin[found])

    def random_cuts(self, asked: np.ndarray, values: list[np.ndarray], share: np.ndarray) -> None:
        """Offers nodes a cut of each asked feature, drawn between its ends in the node; values by code."""
        for nodes, feature, rows, place, code in self.turns(asked):
            counts = self.counts[nodes]
            heads = np.cumsum(counts) - counts
            low, high = (f.reduceat(code, heads).astype(np.int64) for f in (np.minimum, np.maximum))
            cut = low.copy()
            for f in np.unique(feature[high > low + 1]).tolist():
                own = np.flatnonzero(feature == f)
                cut[own] = drawn_cut(values[f], low[own], high[own], share[f, nodes[own]])
            goes = (code <= cut[place]) * self.w[rows]
            left_w, left = np.bincount(place, goes, len(nodes)), _sums(self.spec, place, len(nodes), self.labels[rows], goes)
            gain = _quality(left, left_w) + _quality(self.total[nodes] - left, self.total_w[nodes] - left_w)
            self._offer(nodes, feature, gain, cut)


def drawn_cut(values: np.ndarray, low: np.ndarray, high: np.ndarray, share: np.ndarray) -> np.ndarray:
    """The last code whose value is at most the threshold that stands at the given share between two codes' values."""
    threshold = values[low] + share * (values[high] - values[low])
    return np.clip(np.searchsorted(values, threshold, side="right") - 1, low, np.maximum(low, high - 1))


def _by_row(codes: np.ndarray) -> np.ndarray:
    """(rows, features) of (features, rows) codes, made up to whole words of 64 bits."""
    rows = np.zeros((codes.shape[1], -(-max(1, len(codes)) // (8 // codes.itemsize)) * (8 // codes.itemsize)), codes.dtype)
    rows[:, :len(codes)] = codes.T
    return rows


def grow(codes: np.ndarray, labels: np.ndarray, w: np.ndarray, spec: ForestSpec, sizes: list[int],
         values: list[np.ndarray], rng: np.random.Generator, depth: int = 0) -> Tree:
    """A tree over rows (features, rows), level by level, until its leaves are pure or their rows alike."""
    keep = np.flatnonzero(w > 0)
    codes, labels, w = _by_row(codes[:, keep]), _coded(spec, labels[keep]), w[keep]
    if not len(labels):
        return Tree()
    counts, wanted = np.array([len(labels)]), spec.features or len(sizes)
    levels: list[tuple[np.ndarray, ...]] = []  # a level's nodes are numbered one after the other, sisters side by side
    total = 1
    packs, packed = _packs(codes, len(sizes)) if wanted >= len(sizes) and not spec.random_cuts and len(w) >= PACK_ROWS else ([], [])
    while True:
        level = _Level(spec, np.array(sizes), codes, labels, w, counts)
        value = level.total.argmax(axis=1) if spec.classes else level.total[:, 0] / level.total_w
        mixed = np.minimum.reduceat(labels, level.heads) < np.maximum.reduceat(labels, level.heads)
        if depth < spec.max_depth and mixed.any():
            if not level.look(mixed, wanted, values, rng, packs, packed):
                packs, packed = [], []  # nor will they be in the smaller nodes below
        split = np.flatnonzero(level.feature != LEAF)
        left = np.full(len(counts), LEAF)
        left[split] = total + 2 * np.arange(len(split))
        levels.append((level.feature, level.cut, left, value))
        if not len(split):
            feature, cut, left, value = (np.concatenate(x) for x in zip(*levels))
            return Tree(feature.tolist(), cut.tolist(), [True] * len(feature), left.tolist(), np.where(left == LEAF, LEAF, left + 1).tolist(),
                        value.astype(float).tolist())
        total, depth = total + 2 * len(split), depth + 1
        goes_on = np.flatnonzero((level.feature != LEAF)[level.node])
        node = level.node[goes_on]
        right = codes.ravel().take(goes_on * codes.shape[1] + level.feature[node]) > level.cut[node]
        child = 2 * (np.cumsum(level.feature != LEAF) - 1)[node] + right
        whole = level.counts[split]
        counts = np.repeat(whole, 2)
        counts[::2] = np.add.reduceat(~right, np.cumsum(whole) - whole, dtype=np.int64)
        counts[1::2] -= counts[::2]
        # In the order of the children, rows of each as they were: places of lefts and rights are counted up side by side.
        begin, lefts = np.cumsum(counts) - counts, np.cumsum(~right)
        before = np.repeat(np.append(0, np.cumsum(counts[::2]))[:-1], whole)  # lefts in nodes before
        rank = np.where(right, np.arange(len(node)) - begin[child & ~1] - (lefts - before), lefts - 1 - before)
        order = np.empty_like(goes_on)
        order[begin[child] + rank] = goes_on
        codes, labels, w, packed = codes[order], labels[order], w[order], [own[order] for own in packed]


#: feature is LEAF where a node has no split, AGAIN if the features drawn have none; value is the node's own.
_SPLITS = "tree int, node int, feature int, cut int, left_rows long, right_rows long, value double"
AGAIN = -2
SUBTREES = "tree int, node int, nodes binary"
#: Also, with neither nodes nor a subtree of their own, the rows of a block at the node that the subtree misses, a bit for each.
_FINISHED = f"{SUBTREES}, block long, missed binary"
#: Bytes of a packed node.
_NODE_BYTES = 16


def pack_tree(tree: Tree) -> bytes:
    """Sisters stand side by side, and missing values go left."""
    kinds = ((tree.feature, np.int16), (tree.cut, np.uint16), (tree.left, np.int32), (tree.value, np.float64))
    return b"".join(np.array(x).astype(kind).tobytes() for x, kind in reversed(kinds))


def unpack_tree(raw: bytes) -> Tree:
    n = len(raw) // _NODE_BYTES
    value, left, cut, feature = (np.frombuffer(raw, kind, n, at * n) for kind, at in
                                 ((np.float64, 0), (np.int32, 8), (np.uint16, 12), (np.int16, 14)))
    return Tree(feature, cut, np.ones(n, bool), left, np.where(left == LEAF, LEAF, left + 1).astype(np.int32), value)


def _drawn(spec: ForestSpec, n_features: int, k: int, node: int) -> tuple[np.ndarray, np.random.Generator]:
    """Features of a node, those drawn first."""
    rng = np.random.default_rng([spec.seed, k, node, 1])
    return rng.permutation(n_features), rng


class _Wide:
    """Passes over the blocks for nodes with more rows than a task takes."""

    def __init__(self, blocks: DataFrame, spec: ForestSpec, edges: list[np.ndarray], values: list[np.ndarray]):
        self.blocks, self.spec, self.values = blocks, spec, values
        self.sizes = [len(e) + 1 for e in edges]
        self.kind = bins.code_type(edges)

    def _nodes(self, trees: list[Tree], open_: list[tuple[int, int]]):
        """Function from a block's row to (tree, node, codes, places, labels, weights) of the open nodes with rows in it.

        Codes are the whole block's.
        """
        spec, kind, features = self.spec, self.kind, len(self.sizes)
        by_tree: dict[int, list[int]] = {}
        for k, node in open_:
            by_tree.setdefault(k, []).append(node)

        def read(row: dict) -> Iterator[tuple]:
            codes, labels = bins.opened(row, features, kind)
            for k, nodes in by_tree.items():
                w, leaf = weights(spec, k, row), trees[k].leaves(codes)
                for node in nodes:
                    at = np.flatnonzero((leaf == node) & (w > 0))
                    if len(at):
                        yield k, node, codes, at, labels[at], w[at]
        return read

    def sizes_of(self, trees: list[Tree], open_: list[tuple[int, int]]) -> dict[tuple[int, int], int]:
        read = self._nodes(trees, open_)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(k, node, len(labels)) for row in batch.to_pylist() for k, node, _, _, labels, _ in read(row)]
                yield _batch(found, ("tree", "node", "n"), (pa.int32(), pa.int32(), pa.int64()))

        rows = self.blocks.mapInArrow(run, "tree int, node int, n long").groupBy("tree", "node").agg(F.sum("n").alias("n")).collect()
        return {(r["tree"], r["node"]): r["n"] for r in rows}

    def ends(self, trees: list[Tree], open_: list[tuple[int, int]], asked: dict[tuple[int, int], np.ndarray]) -> dict[tuple[int, int], tuple]:
        """(least code, largest code) of the asked features, and (least, largest) label, by open node."""
        read = self._nodes(trees, open_)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for row in batch.to_pylist():
                    for k, node, codes, at, labels, _ in read(row):
                        some = [codes[f][at] for f in asked[k, node]]
                        found.append((k, node, *([*(float(end(c)) for c in some), float(end(labels))] for end in (np.min, np.max))))
                kinds = (pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()))
                yield _batch(found, ("tree", "node", "low", "high"), kinds)

        def merge(table: pa.Table) -> pa.Table:
            low, high = (np.array(table.column(c).to_pylist()) for c in ("low", "high"))
            return table.slice(0, 1).select(["tree", "node"]).append_column(
                "low", pa.array([low.min(axis=0)], pa.list_(pa.float64()))).append_column(
                "high", pa.array([high.max(axis=0)], pa.list_(pa.float64())))

        schema = "tree int, node int, low array<double>, high array<double>"
        rows = self.blocks.mapInArrow(run, schema).groupBy("tree", "node").applyInArrow(merge, schema).collect()
        return {(r["tree"], r["node"]): (np.array(r["low"]), np.array(r["high"])) for r in rows}

    def splits(self, trees: list[Tree], open_: list[tuple[int, int]], every: bool = False) -> list:
        """_SPLITS rows of the open nodes, by the features drawn for each; every: by all features."""
        spec, sizes, read = self.spec, self.sizes, self._nodes(trees, open_)
        wanted = spec.features or len(sizes)
        drawn = {name: _drawn(spec, len(sizes), *name)[0] for name in open_}
        asked = {name: own if every else own[:wanted] for name, own in drawn.items()}
        cuts: dict[tuple[int, int], dict[int, int]] = {}
        if spec.random_cuts:
            for name, (low, high) in self.ends(trees, open_, asked).items():
                share = _drawn(spec, len(sizes), *name)[1].random(len(sizes))
                cuts[name] = {}
                for f, least, most in zip(asked[name].tolist(), low[:-1].astype(int), high[:-1].astype(int)):
                    if low[-1] < high[-1] and least < most:
                        cuts[name][f] = int(drawn_cut(self.values[f], *(np.array([x]) for x in (least, most, share[f])))[0])

        def places(name: tuple[int, int]) -> tuple[list[int], np.ndarray]:
            """Features to add up, and where the codes of each begin; what all rows add up to stands at the end."""
            own = [f for f in asked[name].tolist() if not spec.random_cuts or f in cuts.get(name, {})]
            return own, np.cumsum([0, *(2 if spec.random_cuts else sizes[f] for f in own)])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    for k, node, codes, at, labels, w in read(row):
                        labels, (own, begin) = _coded(spec, labels), places((k, node))
                        if (k, node) not in total:
                            total[k, node] = np.zeros((spec.outputs + 2, begin[-1] + 1))
                        sums = total[k, node]
                        sums[:-2, -1] += _sums(spec, np.zeros(len(at), np.int64), 1, labels, w)[0]
                        sums[-2:, -1] += w.sum(), len(at)
                        for f, first, last in zip(own, begin, begin[1:]):
                            # Of a drawn cut only the two sides are added up.
                            code = (codes[f][at] > cuts[k, node][f] if spec.random_cuts else codes[f][at]).astype(np.int64)
                            part, size = sums[:, first:last], last - first
                            of_code = _sums(spec, code, size, labels, w).T
                            part[:-2] += of_code
                            part[-2] += of_code.sum(axis=0) if spec.classes else np.bincount(code, w, size)
                            part[-1] += np.bincount(code, minlength=size)
            yield _batch([(k, node, x.tobytes()) for (k, node), x in total.items()], ("tree", "node", "sums"),
                         (pa.int32(), pa.int32(), pa.binary()))

        def choose(table: pa.Table) -> pa.Table:
            k, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
            own, begin = places((k, node))
            sums = sum(np.frombuffer(x.as_py()) for x in table.column("sums")).reshape(-1, begin[-1] + 1)
            first = sums[:, -1]
            value = float(first[:-2].argmax()) if spec.classes else float(first[0] / first[-2])
            pure = spec.classes and first[:-2].max() >= first[-2] - 1e-9
            best = -np.inf, (k, node, LEAF, 0, 0, 0, value)
            at_ = {f: i for i, f in enumerate(own)}
            for turn, f in enumerate([] if pure else asked[k, node].tolist()):
                if turn >= wanted and best[1][2] != LEAF:
                    break
                if f not in at_:
                    continue
                part = sums[:, begin[at_[f]]: begin[at_[f] + 1]]
                left = np.cumsum(part, axis=1)
                rest = left[:, -1:] - left
                gain = _quality(left[:-2].T, left[-2]) + _quality(rest[:-2].T, rest[-2])
                gain = np.where((left[-1] > 0) & (rest[-1] > 0), gain, -np.inf)
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    cut = cuts[k, node][f] if spec.random_cuts else at
                    best = gain[at], (k, node, f, cut, int(left[-1, at]), int(rest[-1, at]), value)
            found = best[1]
            if found[2] == LEAF and not pure and len(asked[k, node]) < len(sizes):
                found = (k, node, AGAIN, *found[3:])
            kinds = (*[pa.int32()] * 4, pa.int64(), pa.int64(), pa.float64())
            return pa.Table.from_batches([_batch([found], [f.split()[0] for f in _SPLITS.split(", ")], kinds)])

        rows = self.blocks.mapInArrow(add, "tree int, node int, sums binary").groupBy("tree", "node") \
            .applyInArrow(choose, _SPLITS).collect()
        again = [(r["tree"], r["node"]) for r in rows if r["feature"] == AGAIN]
        return [r for r in rows if r["feature"] != AGAIN] + (self.splits(trees, again, True) if again else [])

    def finished(self, trees: list[Tree], open_: list[tuple[int, int, int]], tell: bool = False) -> DataFrame:
        """_FINISHED of the nodes (tree, node, depth), each grown in one task; tell: with the rows missed."""
        spec, sizes, values, kind = self.spec, self.sizes, self.values, self.kind
        read = self._nodes(trees, [(k, node) for k, node, _ in open_])
        depth = {(k, node): d for k, node, d in open_}

        def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    for k, node, codes, at, labels, w in read(row):
                        yield _batch([(k, node, row["block"], codes.take(at, axis=1).tobytes(), labels.tobytes(), w.tobytes())],
                                     ("tree", "node", "block", "codes", "label", "w"),
                                     (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))

        def finish(table: pa.Table) -> pa.Table:
            k, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
            parts = sorted(table.to_pylist(), key=lambda r: r["block"])  # the same tree on every run
            labels = np.concatenate([np.frombuffer(r["label"]) for r in parts])
            w = np.concatenate([np.frombuffer(r["w"]) for r in parts])
            codes = np.concatenate([np.frombuffer(r["codes"], kind).reshape(len(sizes), -1) for r in parts], axis=1)
            tree = grow(codes, labels, w, spec, sizes, values, np.random.default_rng([spec.seed, k, node, 2]), depth[k, node])
            found = [(k, node, pack_tree(tree), None, None)]
            if tell:
                missed = np.split(tree.predict(codes) != labels, np.cumsum([len(r["label"]) // 8 for r in parts])[:-1])
                found += [(k, node, None, r["block"], np.packbits(own).tobytes()) for r, own in zip(parts, missed)]
            return pa.Table.from_batches([_batch(found, [f.split()[0] for f in _FINISHED.split(", ")], _KINDS)])

        return self.blocks.mapInArrow(ship, "tree int, node int, block long, codes binary, label binary, w binary") \
            .groupBy("tree", "node").applyInArrow(finish, _FINISHED)


_KINDS = (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary())


def _batch(rows: list[tuple], names, kinds) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))


def joined(tops: list[Tree], rows: list) -> list[Tree]:
    """Whole trees from their tops and the subtrees below, in arrays; rows by (tree, node)."""
    parts = [[t.packed()] for t in tops]
    for r in rows:
        parts[r["tree"]].append((r["node"], unpack_tree(r["nodes"])))
    out = []
    for top, *below in parts:
        fields = [np.array(x) for x in (top.feature, top.cut, top.missing_left, top.left, top.right, top.value)]
        added, base = [[x] for x in fields], len(fields[0]) - 1
        for root, own in below:
            for i, x in enumerate((own.feature, own.cut, own.missing_left, own.left, own.right, own.value)):
                moved = np.where(x == LEAF, LEAF, x + base) if i in (3, 4) else x
                fields[i][root] = moved[0]
                added[i].append(moved[1:])
            base += len(own.feature) - 1
        feature, cut, missing_left, left, right, value = (np.concatenate(x) for x in added)
        out.append(Tree(feature.astype(np.int32), cut.astype(np.int32), missing_left, left.astype(np.int32), right.astype(np.int32), value))
    return out


def write_subtrees(subtrees: DataFrame, path: str) -> None:
    """In small row groups, as a reader holds a group's rows at once."""
    subtrees.write.mode("overwrite").option("parquet.block.size", GROUP_BYTES).option("parquet.block.size.row.check.min", 1) \
        .option("parquet.block.size.row.check.max", 10).parquet(path)


def stored(subtrees: DataFrame) -> DataFrame:
    """SUBTREES of a stored table, which may have lists of nodes as models were stored before."""
    if "nodes" in subtrees.columns:
        return subtrees.filter("nodes is not null").select("tree", "node", "nodes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["tree"], r["node"], pack_tree(Tree(r["feature"], r["cut"], [], r["left"], [], r["value"]))) for r in batch.to_pylist()]
            yield _batch(rows, ("tree", "node", "nodes"), _KINDS[:3])

    return subtrees.mapInArrow(run, SUBTREES)


def code_values(rows: DataFrame, columns: list[str], edges: list[np.ndarray]) -> list[np.ndarray]:
    """A value for each code: its edge, the largest value for the last; a missing value stands one below the least."""
    tops = rows.agg(*[F.max(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    out = []
    for edge, top in zip(edges, tops):
        finite = np.append(edge[:-1], 0.0 if top is None or not math.isfinite(top) else top)
        out.append(np.append(finite[0] - 1, finite))
    return out


def grown(blocks: DataFrame, spec: ForestSpec, edges: list[np.ndarray], values: list[np.ndarray],
          task_rows: int | None = None, rows: int | None = None, tell: bool = False) -> tuple[list[Tree] | None, DataFrame]:
    """(tops, _FINISHED below them) of all trees over the blocks; no tops if there are no rows.

    rows: how many a tree has, if that is known. tell: also the rows that subtrees miss.
    """
    spark, task_rows = blocks.sparkSession, TASK_ROWS if task_rows is None else task_rows
    wide = _Wide(blocks, spec, edges, values)
    trees = [Tree() for _ in range(spec.trees)]
    open_ = [(k, 0, 0) for k in range(spec.trees)]
    sizes = wide.sizes_of(trees, [n[:2] for n in open_]) if rows is None else {n[:2]: rows for n in open_}
    if not sizes:
        return None, spark.createDataFrame([], _FINISHED)
    ready, large = ([n for n in open_ if (sizes.get(n[:2], 0) > task_rows) == big] for big in (False, True))
    while large:
        following = []
        for r in wide.splits(trees, [n[:2] for n in large]):
            k, node, depth = r["tree"], r["node"], large[0][2]
            trees[k].value[node] = r["value"]
            if r["feature"] == LEAF or depth >= spec.max_depth:
                continue
            children = trees[k].split(node, r["feature"], r["cut"], True)
            for child, n in zip(children, (r["left_rows"], r["right_rows"])):
                (ready if n <= task_rows else following).append((k, child, depth + 1))
        large = following
    if not ready:
        return trees, spark.createDataFrame([], _FINISHED)
    path = scratch_path(spark, "forest")
    write_subtrees(wide.finished(trees, ready, tell), path)
    return trees, spark.read.schema(_FINISHED).parquet(path)


def _settled(classes: int, says: list[float]):
    """Function from a number of rows and (tree, rows, values) of all trees to the rows' means, or the classes with
    most votes (the least of equals), a tree's counting what it says."""
    def run(n: int, ballots: Iterable[tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
        votes = np.zeros((max(1, classes), n))
        for k, rows, values in ballots:
            if classes:
                votes[values.astype(int), rows] += says[k]
            else:
                votes[0, rows] += values
        return votes.argmax(axis=0).astype(float) if classes else votes[0] / len(says)
    return run


@dataclass
class ForestModel:
    """Tops of the trees and a table of the subtrees below them."""

    columns: list[str]
    edges: list[np.ndarray]
    classes: int
    tops: list[Tree]
    subtrees: DataFrame
    says: list[float] | None = None  # what a tree's vote counts, 1 by default

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        nodes = (self.subtrees.agg(F.sum(F.length("nodes"))).first()[0] or 0) // _NODE_BYTES
        return self._by_broadcast(df, output) if nodes <= SHARED_NODES else self._by_join(df, output)

    def _by_broadcast(self, df: DataFrame, output: str) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(joined(self.tops, self.subtrees.collect()))
        edges, settled = self.edges, _settled(self.classes, self.says or [1.0] * len(self.tops))

        def run(*columns: pd.Series) -> pd.Series:
            codes = bins.codes_of(np.stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns], axis=1), edges)
            rows = np.arange(codes.shape[1])
            return pd.Series(settled(len(rows), ((k, rows, t.predict(codes)) for k, t in enumerate(shared.value))))

        return df.withColumn(output, F.pandas_udf(run, "double")(*[F.col(f"`{c}`").cast("double") for c in self.columns]))

    def _by_join(self, df: DataFrame, output: str) -> DataFrame:
        """Blocks of rows meet their subtrees in groups of (tree, node), cut so that none has too many rows; then the trees'
        values of a block's rows are brought together."""
        spark, edges, tops, kind = df.sparkSession, self.edges, self.tops, bins.code_type(self.edges)
        settled = _settled(self.classes, self.says or [1.0] * len(tops))
        path = scratch_path(spark, "forest-rows")
        names = [f"x{i}" for i in range(len(self.columns))]
        df.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
        rows = spark.read.parquet(path)

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                codes, ids = bins.codes_of(bins.matrix(batch, names), edges), batch.column("_row").to_numpy()
                block, found = int(ids.min()), []
                for k, top in enumerate(tops):
                    leaf = top.leaves(codes)
                    order = np.argsort(leaf, kind="stable")
                    heads = np.flatnonzero(np.diff(leaf[order], prepend=-1))
                    found += [(k, int(leaf[at[0]]), block, len(at), ids[at].tobytes(), codes.take(at, axis=1).tobytes())
                              for at in np.split(order, heads[1:])]
                yield _batch(found, ("tree", "node", "block", "n", "ids", "codes"),
                             (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes, found = bins.codes_of(bins.matrix(batch, names), edges), []
                for k, top in enumerate(tops):
                    found += [(k, int(node), int(n)) for node, n in zip(*np.unique(top.leaves(codes), return_counts=True))]
                yield _batch(found, ("tree", "node", "n"), (pa.int32(), pa.int32(), pa.int64()))

        coded = rows.select("_row", *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(self.columns, names)])
        counts = F.broadcast(coded.mapInArrow(counted, "tree int, node int, n long").groupBy("tree", "node").agg(
            F.ceil(F.sum("n") / TASK_ROWS).cast("int").alias("parts")))
        asked = coded.mapInArrow(spread, "tree int, node int, block long, n long, ids binary, codes binary")
        dealt = asked.join(counts, ["tree", "node"]).withColumn("part", F.pmod(F.xxhash64("block"), "parts").cast("int")).drop("parts")
        below = self.subtrees.join(counts, ["tree", "node"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

        def vote(blocks: pa.Table, tree: pa.Table) -> pa.Table:
            parts = blocks.to_pylist()
            own = unpack_tree(tree.column("nodes")[0].as_py()) if len(tree) else None
            found = []
            for r in parts:
                value = np.full(r["n"], float(tops[r["tree"]].value[r["node"]])) if own is None else \
                    own.predict(np.frombuffer(r["codes"], kind).reshape(-1, r["n"]))
                found.append((r["block"], r["tree"], r["ids"], value.tobytes()))
            return pa.Table.from_batches([_batch(found, ("block", "tree", "ids", "value"), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))])

        def settle(votes: pa.Table) -> pa.Table:
            parts = sorted(votes.to_pylist(), key=lambda r: r["tree"])  # sums in the order of the trees
            ids, places = np.unique(np.concatenate([np.frombuffer(r["ids"], np.int64) for r in parts]), return_inverse=True)
            ends = np.cumsum([len(r["ids"]) // 8 for r in parts])[:-1]
            found = settled(len(ids), ((r["tree"], at, np.frombuffer(r["value"])) for r, at in zip(parts, np.split(places, ends))))
            return pa.table({"_row": ids, output: found})

        votes = dealt.groupBy("tree", "node", "part").cogroup(below.groupBy("tree", "node", "part")).applyInArrow(
            vote, "block long, tree int, ids binary, value binary")
        best = votes.groupBy("block").applyInArrow(settle, f"_row long, `{output}` double")
        return rows.join(best, "_row").drop("_row")

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        write_subtrees(self.subtrees, f"{path}/subtrees")
        spark.createDataFrame([(k, *t.row()) for k, t in enumerate(self.tops)], f"tree int, {TREE_FIELDS}") \
            .write.mode("overwrite").parquet(f"{path}/tops")
        facts = [(self.columns, [e.tolist() for e in self.edges], self.classes)]
        spark.createDataFrame(facts, _FACTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        facts = spark.read.schema(_FACTS).parquet(f"{path}/facts").first()
        tops = [Tree(*(list(r[c]) for c in ("feature", "cut", "missing_left", "left", "right", "value")))
                for r in spark.read.parquet(f"{path}/tops").orderBy("tree").collect()]
        return cls(facts["columns"], [np.array(e) for e in facts["edges"]], facts["classes"], tops, stored(spark.read.parquet(f"{path}/subtrees")))


_FACTS = "columns array<string>, edges array<array<double>>, classes int"


@dataclass(frozen=True)
class Forest:
    """An estimator: fit(df) gives a ForestModel that adds `prediction`. Rows without a label are left out."""

    columns: list[str]
    label: str
    spec: ForestSpec

    def fit(self, df: DataFrame) -> ForestModel:
        spec = self.spec
        rows = df.filter(F.col(f"`{self.label}`").isNotNull()).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*self.columns, self.label])])
        edges = bins.find_edges(rows, self.columns, spec.bins)
        held = bins.blocks(rows, self.columns, edges, self.label).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            trees, subtrees = grown(held, spec, edges, code_values(rows, self.columns, edges))
            if trees is None:
                raise ValueError(f"no labels in {self.label}")
        finally:
            held.unpersist()
        return ForestModel(self.columns, edges, spec.classes, trees, stored(subtrees))
