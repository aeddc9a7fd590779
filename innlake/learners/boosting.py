"""Gradient-boosted trees from histograms that Spark adds up.

Rows are coded once and held in blocks with their scores (see bins.py), features of few
combinations under one joint code (see bundles.py). A pass over the blocks follows the
rows to the wanted nodes of the round's trees, adds up gradients,
hessians and rows by (tree, node, joint code), turns these into sums by (feature, code) and merges them
by (tree, node), in
Spark if those of all tasks are more than the driver should take; what comes to the driver
are the sums of a round's open nodes, whose size depends on bins and leaves, not on rows. Of two sisters only the one with fewer
rows is added up; the other is their mother's sums less hers. A leaf that can't be split again
needs no sums: its weight follows from its mother's split.

All classes share a pass: a round grows one tree for each class from the same
softmax. Two ways to grow:

* by level, to max_depth;
* best first, to max_leaves: the leaf with the largest gain is split next. A pass
  opens all leaves that may be next, and as many splits are made from it as are certain, so a
  tree takes a pass for each few levels, not one for each split.

Nodes of at most TASK_ROWS rows need no passes: once no other nodes are open, and these have
SHIP_ROWS rows in all at most, the rows of each go to one task, which grows what
hangs below by the same rules. Best first, only whole trees go to tasks: below each of several nodes
a task would grow as many leaves as may hang there, most of them for nothing.

A split's gain and a leaf's weight follow from sums of gradients G and hessians H:
weight = -T(G) / (H + l2), gain = (T(G_left)^2 / (H_left + l2) + ... - T(G)^2 / (H + l2)) / 2,
where T moves G by l1 towards 0. Missing values go to the side with the larger gain.
A category's codes are put in the order of their -G / H in the node, and a cut follows any of them; codes
without rows come last.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from innlake.learners import bins, bundles
from innlake.learners.bundles import Joint
from innlake.learners.trees import LEAF, TREE_FIELDS, Tree
from innlake.session import ensure_checkpoint_dir

CHECKPOINT_EVERY = 10
#: Sums of all tasks of a pass that the driver merges itself; Spark merges larger ones first.
DRIVER_BYTES = 16 << 20
#: Rows of a node that one task takes.
TASK_ROWS = 1 << 20
#: Rows that all nodes given to tasks have together; more of them take less time in passes than on their way.
SHIP_ROWS = 1 << 20
#: DEVIANCE is LOGISTIC in steps along the gradient: a leaf's weight is its mean.
SQUARED, LOGISTIC, SOFTMAX, DEVIANCE = "squared", "logistic", "softmax", "deviance"
#: Partitions that a task of a pass takes at most. Passes are short and each task costs some time of its own, so a pass has
#: a task for each core, and more only if these would take too many rows.
TASK_PARTITIONS = 32
#: Leaves that rows are told apart by at once: the bits of a word.
MARKS = 64


@dataclass(frozen=True)
class Growth:
    """How a boosted model is grown; the loss tells what labels are: numbers, 0 and 1, or 0 to n_classes - 1."""

    loss: str = SQUARED
    n_classes: int = 1
    rounds: int = 100
    rate: float = 0.1
    first_rate: float | None = None  # of the first round; rate by default
    max_depth: int = 3
    max_leaves: int = 0  # above 0: best first
    l1: float = 0.0
    l2: float = 0.0
    min_gain: float = 0.0
    min_row_gain: float = 0.0  # gain for each row of the node
    first_row_gain: float | None = None  # of the first round; min_row_gain by default
    min_hessian: float = 0.0
    min_rows: int = 1
    subsample: float = 1.0
    bins: int = bins.BINS
    seed: int = 42

    @property
    def plain(self) -> bool:
        """Whether each row's hessian is 1."""
        return self.loss in (SQUARED, DEVIANCE)

    @property
    def outputs(self) -> int:
        return self.n_classes if self.loss == SOFTMAX else 1

    @property
    def leaf_scale(self) -> float:
        """Of softmax weights: one class's score is determined by the others'."""
        return (self.n_classes - 1) / self.n_classes if self.loss == SOFTMAX else 1.0


def gradients(loss: str, scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss, (outputs, rows)."""
    if loss == SQUARED:
        return scores - labels, np.ones_like(scores)
    if loss == DEVIANCE:
        signs = 2 * labels - 1
        with np.errstate(over="ignore"):  # an infinite power's slope is 0
            return -4 * signs / (1 + np.exp(2 * signs * scores)), np.ones_like(scores)
    if loss == LOGISTIC:
        p = 1 / (1 + np.exp(-scores))
        return p - labels, p * (1 - p)
    p = np.exp(scores - scores.max(axis=0))
    p /= p.sum(axis=0)
    return p - (np.arange(len(scores))[:, None] == labels), p * (1 - p)


def _start(df: DataFrame, label: str, growth: Growth) -> np.ndarray:
    """Scores before the first round: the mean, log-odds, or logarithms of the classes' shares."""
    y = F.col(f"`{label}`").cast("double")
    if growth.loss == SOFTMAX:
        counts = df.groupBy(y.alias("y")).count().collect()  # one row a class
        if not counts:
            raise ValueError(f"no labels in {label}")
        n = sum(r["count"] for r in counts)
        shares = np.full(growth.n_classes, 1e-12)
        for r in counts:
            shares[int(r["y"])] = r["count"] / n
        return np.log(shares)
    mean = df.agg(F.avg(y)).first()[0]
    if mean is None:
        raise ValueError(f"no labels in {label}")
    if growth.loss == DEVIANCE:
        return np.zeros(1)
    if growth.loss == LOGISTIC:
        p = min(max(mean, 1e-12), 1 - 1e-12)
        return np.array([math.log(p / (1 - p))])
    return np.array([mean])


@dataclass
class Layout:
    """Where each feature's codes stand in a node's sums."""

    sizes: np.ndarray  # codes of each feature, the missing one included
    begin: np.ndarray
    owner: np.ndarray  # feature of each place
    inner: np.ndarray  # places that a cut may follow: neither missing nor a feature's last
    categories: frozenset[int] = frozenset()  # features whose codes have no order

    @classmethod
    def of(cls, edges: list[np.ndarray], categories: frozenset[int] = frozenset()) -> Layout:
        sizes = np.array([len(e) + 1 for e in edges])
        begin = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        code = np.arange(begin[-1]) - begin[owner]
        return cls(sizes, begin, owner, (code > 0) & (code < sizes[owner] - 1), categories)


@dataclass
class Split:
    gain: float
    feature: int
    cut: int
    missing_left: bool
    left: tuple[float, float, float]  # gradient, hessian, rows
    right: tuple[float, float, float]


def _toward_zero(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0) if l1 else g


def _quality(g: np.ndarray, h: np.ndarray, growth: Growth) -> np.ndarray:
    bottom = h + growth.l2
    return np.where(bottom > 0, _toward_zero(g, growth.l1) ** 2 / np.where(bottom > 0, bottom, 1), 0)


def best_splits(sums: np.ndarray, layout: Layout, growth: Growth) -> list[Split | None]:
    """The best cut of each node with sums (node, gradient hessian rows, place); the first of equals.

    A cut of a category is the set of codes that go left, see bundles.py.
    """
    first = layout.begin[:-1]
    ranks: dict[int, np.ndarray] = {}
    if layout.categories:
        sums = sums.copy()
    for f in layout.categories:
        part = sums[:, :, layout.begin[f] + 1: layout.begin[f + 1]]
        g, h, n = part[:, 0], part[:, 1], np.rint(part[:, 2])
        mean = np.where(n > 0, -g / np.where(h > 0, h, 1), np.inf)
        ranks[f] = np.argsort(mean, axis=1, kind="stable")
        part[:] = np.take_along_axis(part, ranks[f][:, None, :], axis=2)
    running = np.cumsum(sums, axis=2)
    before = np.concatenate([np.zeros((len(sums), 3, 1)), running], axis=2)[:, :, first][:, :, layout.owner]
    with_missing = running - before
    total = sums[:, :, layout.begin[0]: layout.begin[1]].sum(axis=2)[:, :, None]
    sides = np.stack([with_missing, with_missing - sums[:, :, first][:, :, layout.owner]], axis=3)  # missing left, right
    rest = total[:, :, :, None] - sides
    gain = (_quality(sides[:, 0], sides[:, 1], growth) + _quality(rest[:, 0], rest[:, 1], growth)
            - _quality(total[:, 0], total[:, 1], growth)[:, :, None]) / 2
    good = layout.inner[:, None] & (np.minimum(sides[:, 1], rest[:, 1]) >= growth.min_hessian) \
        & (np.minimum(sides[:, 2], rest[:, 2]) >= max(1, growth.min_rows) - 0.5)
    gain = np.where(good, gain, -np.inf).reshape(len(sums), -1)
    out: list[Split | None] = []
    for i, best in enumerate(gain.argmax(axis=1).tolist()):
        at, way = divmod(best, 2)
        if not gain[i, best] > growth.min_gain + 1e-12 or gain[i, best] < growth.min_row_gain * float(total[i, 2, 0]):
            out.append(None)
            continue
        feature = int(layout.owner[at])
        cut = int(at - layout.begin[feature])
        if feature in ranks:
            cut = bundles.code_set((ranks[feature][i, :cut] + 1).tolist())
        out.append(Split(float(gain[i, best]), feature, cut, way == 0,
                         tuple(sides[i, :, at, way].tolist()), tuple(rest[i, :, at, way].tolist())))
    return out


def weight(g: float, h: float, growth: Growth) -> float:
    """The value of a leaf with such sums, with the learning rate in it."""
    bottom = h + growth.l2
    return float(-growth.rate * growth.leaf_scale * _toward_zero(g, growth.l1) / bottom) if bottom > 1e-150 else 0.0


class _Walk:
    """The ways of rows to some leaves of a tree."""

    def __init__(self, tree: Tree, joint: Joint, wanted: list[int] | None = None):
        """wanted: leaves (all by default)."""
        self.tree = tree
        self.ends = set(range(len(tree.feature)) if wanted is None else wanted)
        self.sides = {}
        for node in reversed(range(len(tree.feature))):  # children come after their mother
            if tree.feature[node] != LEAF and (wanted is None or tree.left[node] in self.ends or tree.right[node] in self.ends):
                self.ends.add(node)
                self.sides[node] = joint.side(tree.feature[node], tree.cut[node], tree.missing_left[node])

    def members(self, codes: np.ndarray, rows: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray | None]]:
        """The wanted leaves, and places of their rows in (bundles, rows) codes; None: all."""
        todo = [(0, rows)] if 0 in self.ends else []
        while todo:
            node, at = todo.pop()
            if node not in self.sides:
                yield node, at
                continue
            b, left = self.sides[node]
            goes = left[codes[b] if at is None else codes[b][at]]
            for child, some in ((self.tree.left[node], goes), (self.tree.right[node], None)):
                if child in self.ends:
                    some = ~goes if some is None else some
                    todo.append((child, np.flatnonzero(some) if at is None else at[some]))


class _Marks:
    """Tells rows at some leaves of a tree apart, all at once.

    Each leaf is a bit. A joint code leaves those leaves possible whose ways' splits by its bundle
    it agrees with; the one that all bundles' codes leave possible is the row's.
    """

    def __init__(self, tree: Tree, joint: Joint, ends: list[int]):
        """ends: at most MARKS leaves."""
        self.ends = ends
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if len(ends) <= 8 * np.dtype(k).itemsize)
        below = [0] * len(tree.feature)  # bits of the leaves below a node
        for i, node in enumerate(ends):
            below[node] = 1 << i
        self.tables: dict[int, np.ndarray] = {}
        every = (1 << len(ends)) - 1
        for node in reversed(range(len(tree.feature))):  # children come after their mother
            if tree.feature[node] == LEAF:
                continue
            left, right = below[tree.left[node]], below[tree.right[node]]
            below[node] = left | right
            if below[node]:
                b, goes = joint.side(tree.feature[node], tree.cut[node], tree.missing_left[node])
                table = self.tables.setdefault(b, np.full(len(goes), every, kind))
                table &= np.where(goes, kind(every & ~right), kind(every & ~left))
        self.places = None
        if len(ends) <= 16:
            self.places = np.zeros(1 << len(ends), np.intp)
            self.places[1 << np.arange(len(ends))] = np.arange(len(ends))

    def find(self, codes: np.ndarray, rows: np.ndarray | None = None) -> tuple[np.ndarray | None, np.ndarray | None]:
        """Which of the rows (None: all) of (bundles, rows) codes are at an end, and the end's place; None: all, the first."""
        if not self.tables:
            return rows, None
        bits = None
        for b, table in self.tables.items():
            own = table.take(codes[b] if rows is None else codes[b][rows])
            bits = own if bits is None else np.bitwise_and(bits, own, out=bits)
        at = np.flatnonzero(bits != 0)
        bits = bits[at]
        places = self.places.take(bits) if self.places is not None else np.frexp(bits.astype(np.float64))[1].astype(np.intp) - 1
        return at if rows is None else rows[at], places


def _marks(tree: Tree, joint: Joint, ends: list[int]) -> list[_Marks]:
    return [_Marks(tree, joint, ends[i: i + MARKS]) for i in range(0, len(ends), MARKS)]


class _Values:
    """The values of rows by a tree."""

    def __init__(self, tree: Tree, joint: Joint):
        leaves = [n for n, feature in enumerate(tree.feature) if feature == LEAF]
        self.marks = [(m, np.array([tree.value[n] for n in m.ends])) for m in _marks(tree, joint, leaves)]

    def predict(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(codes.shape[1])
        for marks, values in self.marks:
            at, places = marks.find(codes)
            out[slice(None) if at is None else at] = values[0] if places is None else values.take(places)
        return out


def _add(out: np.ndarray, codes: np.ndarray, g: np.ndarray, h: np.ndarray | None, at: np.ndarray | None, joint: Joint,
         places: np.ndarray | None = None) -> None:
    """Adds rows (None: all) to a node's (3, joint places) sums; h of None: each row's hessian is 1.

    places: to (nodes, 3, joint places) sums, and the place of each row's node.
    """
    out = out.reshape(-1, *out.shape[-2:])
    if at is not None:
        g, h = g[at], None if h is None else h[at]
    for b, size in enumerate(joint.sizes):
        code, part = codes[b] if at is None else codes[b][at], slice(joint.begin[b], joint.begin[b + 1])
        if places is not None:
            code = places * size + code
        shape = (len(out), size)
        rows = np.bincount(code, minlength=len(out) * size).reshape(shape)
        out[:, 0, part] += np.bincount(code, g, len(out) * size).reshape(shape)
        out[:, 1, part] += rows if h is None else np.bincount(code, h, len(out) * size).reshape(shape)
        out[:, 2, part] += rows


#: A block's number, rows, joint codes, labels and scores.
_State = tuple[int, int, bytes, bytes, bytes]


def _coded(row: _State, joint: Joint) -> tuple[np.ndarray, np.ndarray]:
    """(joint codes, labels) of a block."""
    return np.frombuffer(row[2], joint.kind).reshape(len(joint.sizes), row[1]), np.frombuffer(row[3])


def _opened(row: _State, growth: Growth, joint: Joint, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray | None]:
    """(codes, gradients, hessians, rows drawn) of a block in a round; None: hessians are 1, all rows are drawn."""
    codes, labels = _coded(row, joint)
    g, h = gradients(growth.loss, np.frombuffer(row[4]).reshape(growth.outputs, -1), labels)
    drawn = None if growth.subsample >= 1 else np.flatnonzero(
        np.random.default_rng([growth.seed, turn, row[0]]).random(len(labels)) < growth.subsample)
    return codes, g, None if growth.plain else h, drawn


class _Rounds:
    """Blocks with scores, and passes over them."""

    def __init__(self, blocks: DataFrame, start: np.ndarray, edges: list[np.ndarray], growth: Growth,
                 categories: frozenset[int] = frozenset()):
        self.growth, self.layout = growth, Layout.of(edges, categories)
        self.done = 0
        plain = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        found = bundles.find(plain, edges)
        self.joint = Joint(found, self.layout.begin, categories)

        def scored(r: Row) -> _State:
            return r["block"], r["n"], bytes(r["codes"]), bytes(r["label"]), np.repeat(start[:, None], r["n"], axis=1).tobytes()

        state = bundles.joint(plain, edges, found).rdd.map(scored)
        tasks = max(state.context.defaultParallelism, -(-state.getNumPartitions() // TASK_PARTITIONS))
        self.state: RDD = state.coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
        self.before: RDD | None = None
        self.tasks = self.state.getNumPartitions()
        self.rows = self.state.map(lambda r: r[1]).sum()
        plain.unpersist()

    @property
    def turn(self) -> Growth:
        """How the trees of this round are grown."""
        first = {"rate": self.growth.first_rate, "min_row_gain": self.growth.first_row_gain}
        return self.growth if self.done else replace(self.growth, **{k: x for k, x in first.items() if x is not None})

    def sums(self, trees: list[Tree], wanted: list[list[int]]) -> dict[tuple[int, int], np.ndarray]:
        """Sums of the wanted nodes by (tree, node)."""
        growth, joint, turn = self.growth, self.joint, self.done
        names = [(k, node) for k, nodes in enumerate(wanted) for node in nodes]
        shape = (3, int(self.layout.begin[-1]))

        def add(rows: Iterator[_State]) -> Iterator[tuple[int, np.ndarray]]:
            total = np.zeros((len(names), 3, joint.begin[-1]))
            ways = [(k, m) for k, (tree, nodes) in enumerate(zip(trees, wanted)) for m in _marks(tree, joint, nodes)]
            ends = np.cumsum([len(m.ends) for _, m in ways])
            for row in rows:
                codes, g, h, drawn = _opened(row, growth, joint, turn)
                for (k, marks), end in zip(ways, ends):
                    at, places = marks.find(codes, drawn)
                    _add(total[end - len(marks.ends): end], codes, g[k], None if h is None else h[k], at, joint, places)
            yield from enumerate(joint.by_feature(total))

        parts = self.state.mapPartitions(add)
        if self.tasks * len(names) * 8 * shape[0] * shape[1] > DRIVER_BYTES:
            parts = parts.reduceByKey(np.add, min(self.tasks, len(names)))
        found = parts.collect()
        self._forget()
        total: dict[tuple[int, int], np.ndarray] = {}
        for slot, own in found:
            name = names[slot]
            total[name] = total[name] + own if name in total else own
        return total

    def finish(self, trees: list[Tree], nodes: list[tuple[int, int, int]]) -> dict[tuple[int, int], tuple[Tree, list[float]]]:
        """What grows below the nodes (tree, node, depth), each in one task: (tree, gains) by (tree, node)."""
        growth, layout, joint, turn = self.turn, self.layout, self.joint, self.done
        by_tree: dict[int, list[int]] = {}
        for k, node, _ in nodes:
            by_tree.setdefault(k, []).append(node)
        places = {(k, node): i for i, (k, node, _) in enumerate(nodes)}

        def ship(rows: Iterator[_State]) -> Iterator[tuple[int, tuple[int, bytes, bytes]]]:
            walks = [(k, _Walk(trees[k], joint, own)) for k, own in by_tree.items()]
            for row in rows:
                codes, g, h, drawn = _opened(row, growth, joint, turn)
                for k, walk in walks:
                    for node, at in walk.members(codes, drawn):
                        some = slice(None) if at is None else at
                        slopes = g[k, some] if h is None else np.stack([g[k, some], h[k, some]])
                        yield places[k, node], (row[0], codes[:, some].tobytes(), slopes.tobytes())

        def grow(group: tuple[int, Iterable[tuple[int, bytes, bytes]]]) -> tuple[tuple[int, int], tuple[Tree, list[float]]]:
            k, node, depth = nodes[group[0]]
            parts = sorted(group[1], key=lambda r: r[0])  # the same sums on every run
            codes = np.concatenate([np.frombuffer(c, joint.kind).reshape(len(joint.sizes), -1) for _, c, _ in parts], axis=1)
            plain = growth.plain
            slopes = np.concatenate([np.frombuffer(x).reshape(1 if plain else 2, -1) for _, _, x in parts], axis=1)
            below = growth if growth.max_leaves else replace(growth, max_depth=growth.max_depth - depth)
            return (k, node), grow_here(codes, slopes[0], None if plain else slopes[1], layout, joint, below)

        found = self.state.mapPartitions(ship).groupByKey(len(nodes), lambda place: place).map(grow).collect()
        self._forget()
        return dict(found)

    def _forget(self) -> None:
        if self.before is not None:
            self.before.unpersist()
            self.before = None

    def take(self, trees: list[Tree]) -> None:
        """Adds the trees of a finished round to the scores."""
        joint, outputs = self.joint, self.growth.outputs

        def update(rows: Iterator[_State]) -> Iterator[_State]:
            values = [_Values(t, joint) for t in trees]
            for row in rows:
                codes, _ = _coded(row, joint)
                scores = np.frombuffer(row[4]).reshape(outputs, -1)
                yield *row[:4], (scores + np.stack([v.predict(codes) for v in values])).tobytes()

        self.done += 1
        after = self.state.mapPartitions(update).persist(StorageLevel.MEMORY_AND_DISK)
        if self.done % CHECKPOINT_EVERY == 0:
            after.checkpoint()
        self.before, self.state = self.state, after

    def close(self) -> None:
        for df in (self.before, self.state):
            if df is not None:
                df.unpersist()


class _Grower:
    """One tree in growth: sums and best splits of its nodes."""

    def __init__(self, layout: Layout, growth: Growth, rows: int, alone: bool = False):
        """alone: sums are at hand, so only the next leaf is opened, not all that may be."""
        self.tree, self.layout, self.growth, self.alone = Tree(), layout, growth, alone
        self.rows = {0: rows}
        self.gains: dict[int, float] = {}
        self.sums: dict[int, np.ndarray] = {}
        self.splits: dict[int, Split | None] = {}
        self.depth = {0: 0}
        self.inner: set[int] = set()  # nodes that are split for good
        self.ends: set[int] = {0}  # nodes whose sums aren't divided yet
        self.pairs: list[tuple[int, int, int]] = []  # (mother, child to add up, its sister)
        self.done: set[int] = set()  # nodes below which all is known

    def know(self, found: dict[int, np.ndarray]) -> None:
        """Takes the sums of nodes."""
        if not found:
            return
        self.sums |= found
        for node, split in zip(found, best_splits(np.stack(list(found.values())), self.layout, self.growth)):
            self.splits[node] = split
        if 0 in found:
            g, h, _ = found[0][:, self.layout.begin[0]: self.layout.begin[1]].sum(axis=1)
            self.tree.value[0] = weight(g, h, self.growth)

    def divide(self, node: int) -> None:
        """Splits a node whose sums are known, and notes which child to add up if one of them may be split again."""
        s = self.splits[node]
        children = self.tree.split(node, s.feature, s.cut, s.missing_left)
        again = False
        for child, (g, h, n) in zip(children, (s.left, s.right)):
            self.depth[child], self.rows[child] = self.depth[node] + 1, round(n)
            self.tree.value[child] = weight(g, h, self.growth)
            again |= (self.growth.max_leaves > 0 or self.depth[child] < self.growth.max_depth) \
                and round(n) >= 2 * max(1, self.growth.min_rows) and h >= 2 * self.growth.min_hessian * (1 - 1e-6)
        self.gains[node] = s.gain
        self.ends.discard(node)
        if again:
            self.pairs.append((node, *(children if s.left[2] <= s.right[2] else children[::-1])))
        else:
            self.ends |= set(children)
            self.splits |= dict.fromkeys(children)
            del self.sums[node]

    def open(self) -> list[int]:
        """Divides ends, and names the children whose sums are wanted."""
        able = self.waiting()
        if self.growth.max_leaves:
            room = 1 if self.alone else self.growth.max_leaves - 1 - len(self.inner)
            able = sorted(able, key=lambda n: (-self.splits[n].gain, n))[:max(0, room)]
        else:
            self.inner |= set(able)
        self.pairs = []
        for node in able:
            self.divide(node)
        return [small for _, small, _ in self.pairs]

    def learn(self, found: dict[int, np.ndarray]) -> None:
        both: dict[int, np.ndarray] = {}
        for mother, small, large in self.pairs:
            both |= {small: found[small], large: self.sums.pop(mother) - found[small]}
        self.ends |= set(both)
        self.know(both)

    def waiting(self) -> list[int]:
        """Ends that may be split."""
        return [n for n in self.ends if n not in self.done and (n not in self.splits or self.splits[n] is not None)
                and (self.growth.max_leaves or self.depth[n] < self.growth.max_depth)]

    def small(self) -> list[int]:
        """Ends that may be split, if one task takes the rows of each; else none."""
        ends = self.waiting()
        fit = all(self.rows[n] <= TASK_ROWS for n in ends) and not (self.growth.max_leaves and self.inner | set(self.sums))
        return ends if fit else []

    def graft(self, root: int, found: Tree, gains: list[float]) -> None:
        """What a task has grown below a node."""
        self.done.add(root)
        todo = [(0, root)]
        while todo:
            own, node = todo.pop()
            self.tree.value[node] = found.value[own]
            self.splits[node] = None
            if found.feature[own] == LEAF:
                self.done.add(node)
                self.ends.add(node)
                continue
            children = self.tree.split(node, found.feature[own], found.cut[own], found.missing_left[own])
            self.splits[node] = Split(gains[own], found.feature[own], found.cut[own], found.missing_left[own], (0, 0, 0), (0, 0, 0))
            self.ends.discard(node)
            for below, child in zip((found.left[own], found.right[own]), children):
                self.depth[child], self.rows[child] = self.depth[node] + 1, 0
                todo.append((below, child))
            if not self.growth.max_leaves:
                self.inner.add(node)

    def settle(self) -> bool:
        """Makes the splits that are certain; whether more sums are needed."""
        if not self.growth.max_leaves:
            return bool(self.waiting())
        while len(self.inner) < self.growth.max_leaves - 1:
            leaves = [c for n in self.inner for c in (self.tree.left[n], self.tree.right[n]) if c not in self.inner] or [0]
            leaves = [n for n in leaves if n not in self.inner and self.splits[n] is not None]
            if not leaves:
                return False
            best = min(leaves, key=lambda n: (-self.splits[n].gain, n))
            if best in self.ends:
                if len(self.inner) < self.growth.max_leaves - 2:
                    return True
                self.divide(best)  # the last split: its children's sums aren't needed
            self.inner.add(best)
        return False


def grow_here(codes: np.ndarray, g: np.ndarray, h: np.ndarray | None, layout: Layout, joint: Joint, growth: Growth) -> tuple[Tree, list[float]]:
    """(tree, gain of each node's split) over the rows at hand, of joint codes; h of None: hessians are 1."""
    grower = _Grower(layout, growth, codes.shape[1], alone=True)
    members = {0: np.arange(codes.shape[1])}

    def sums(node: int) -> np.ndarray:
        out = np.zeros((3, joint.begin[-1]))
        _add(out, codes, g, h, members[node] if node else None, joint)
        return joint.by_feature(out)

    grower.know({0: sums(0)})
    tree = grower.tree
    while grower.settle():
        wanted = grower.open()
        for mother, _, _ in grower.pairs:
            at = members.pop(mother)
            b, left = joint.side(tree.feature[mother], tree.cut[mother], tree.missing_left[mother])
            goes_left = left[codes[b][at]]
            members[tree.left[mother]], members[tree.right[mother]] = at[goes_left], at[~goes_left]
        grower.learn({node: sums(node) for node in wanted})
    gains = [grower.gains.get(n, 0.0) if n in grower.inner else 0.0 for n in range(len(tree.feature))]
    kept = tree.kept(grower.inner)
    todo = {0: 0}
    order = [0.0] * len(kept.feature)
    while todo:
        new, old = todo.popitem()
        order[new] = gains[old]
        if kept.feature[new] != LEAF:
            todo[kept.left[new]], todo[kept.right[new]] = tree.left[old], tree.right[old]
    return kept, order


def _grow(rounds: _Rounds) -> list[Tree]:
    """The trees of one round, one for each output."""
    growers = [_Grower(rounds.layout, rounds.turn, rounds.rows) for _ in range(rounds.growth.outputs)]
    if rounds.rows > TASK_ROWS or rounds.rows * len(growers) > SHIP_ROWS:
        found = rounds.sums([g.tree for g in growers], [[0]] * len(growers))
        for k, grower in enumerate(growers):
            grower.know({0: found[k, 0]})
    live = [True] * len(growers)
    while True:
        waiting = [g.waiting() if on else [] for g, on in zip(growers, live)]
        small = [(k, n, g.depth[n]) for k, g in enumerate(growers) if live[k] for n in g.small()]
        if len(small) == sum(map(len, waiting)) and 0 < sum(growers[k].rows[n] for k, n, _ in small) <= SHIP_ROWS:
            for (k, node), grown in rounds.finish([g.tree for g in growers], small).items():
                growers[k].graft(node, *grown)
        live = [on and g.settle() for on, g in zip(live, growers)]
        if not any(live):
            return [g.tree.kept(g.inner) for g in growers]
        wanted = [g.open() if on else [] for g, on in zip(growers, live)]
        if any(wanted):
            found = rounds.sums([g.tree for g in growers], wanted)
        for k, grower in enumerate(growers):
            if live[k]:
                grower.learn({node: found[k, node] for node in wanted[k]})


@dataclass
class BoostedModel:
    """Trees of all rounds, the first round's first; `edges` turn values into codes."""

    columns: list[str]
    edges: list[np.ndarray]
    start: np.ndarray
    loss: str
    trees: list[list[Tree]] = field(default_factory=list)
    categories: frozenset[int] = frozenset()

    def scores(self, values: np.ndarray) -> np.ndarray:
        """(outputs, rows) scores of (rows, features) values."""
        codes = bins.codes_of(values, self.edges)
        out = np.repeat(self.start[:, None], len(values), axis=1)
        joint = Joint.alone(Layout.of(self.edges).begin, self.categories)
        for grown in self.trees:
            for k, tree in enumerate(grown):
                out[k] += _Values(tree, joint).predict(codes)
        return out

    def predicted(self, values: np.ndarray) -> np.ndarray:
        """Numbers, or the class with the largest score (the least of equals)."""
        scores = self.scores(values)
        if self.loss == SQUARED:
            return scores[0]
        return (scores[0] > 0).astype(float) if self.loss in (LOGISTIC, DEVIANCE) else scores.argmax(axis=0).astype(float)

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self)  # its size depends on rounds, leaves and bins only

        def run(*columns: pd.Series) -> pd.Series:
            return pd.Series(shared.value.predicted(np.stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns], axis=1)))

        score = F.pandas_udf(run, "double")
        return df.withColumn(output, score(*[F.col(f"`{c}`").cast("double") for c in self.columns]))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        rows = [(i, k, *t.row()) for i, grown in enumerate(self.trees) for k, t in enumerate(grown)]
        spark.createDataFrame(rows, f"round int, output int, {TREE_FIELDS}").write.mode("overwrite").parquet(f"{path}/trees")
        facts = [(self.columns, [e.tolist() for e in self.edges], self.start.tolist(), self.loss, sorted(self.categories))]
        spark.createDataFrame(facts, _FACTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        facts = spark.read.schema(_FACTS).parquet(f"{path}/facts").first()
        model = cls(facts["columns"], [np.array(e) for e in facts["edges"]], np.array(facts["start"]), facts["loss"],
                    categories=frozenset(facts["categories"] or ()))
        for r in spark.read.parquet(f"{path}/trees").orderBy("round", "output").collect():
            if r["output"] == 0:
                model.trees.append([])
            model.trees[-1].append(Tree(*(list(r[c]) for c in ("feature", "cut", "missing_left", "left", "right", "value"))))
        return model


_FACTS = "columns array<string>, edges array<array<double>>, start array<double>, loss string, categories array<int>"


@dataclass(frozen=True)
class BoostedTrees:
    """An estimator: fit(df) gives a BoostedModel that adds `prediction`. Rows without a label are left out.

    levels: columns that hold categories, as numbers from 0, and how many there are.
    """

    columns: list[str]
    label: str
    growth: Growth
    levels: dict[str, int] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> BoostedModel:
        growth = self.growth
        ensure_checkpoint_dir(df.sparkSession)
        rows = df.filter(F.col(f"`{self.label}`").isNotNull()).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*self.columns, self.label])])
        if max(self.levels.values(), default=0) > bundles.MOST_LEVELS:
            raise ValueError(f"a category may have {bundles.MOST_LEVELS} levels")
        ordered = [c for c in self.columns if c not in self.levels]
        found = dict(zip(ordered, bins.find_edges(rows, ordered, growth.bins)))
        edges = [found[c] if c in found else bins.level_edges(self.levels[c]) for c in self.columns]
        categories = frozenset(i for i, c in enumerate(self.columns) if c in self.levels)
        start = _start(rows, self.label, growth)
        model = BoostedModel(self.columns, edges, start, growth.loss, categories=categories)
        rounds = _Rounds(bins.blocks(rows, self.columns, edges, self.label), start, edges, growth, categories)
        try:
            for _ in range(growth.rounds):
                model.trees.append(_grow(rounds))
                rounds.take(model.trees[-1])
        finally:
            rounds.close()
        return model
