"""Binary trees over coded features, as arrays."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LEAF = -1


@dataclass
class Tree:
    """Nodes in lists; node 0 is the root. A row goes left if its code is at most `cut`, or missing and missing_left."""

    feature: list[int] = field(default_factory=lambda: [LEAF])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [LEAF])
    right: list[int] = field(default_factory=lambda: [LEAF])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool) -> tuple[int, int]:
        """Numbers of the node's new children."""
        self.feature[node], self.cut[node], self.missing_left[node] = feature, cut, missing_left
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for _ in range(2):
            self.feature.append(LEAF)
            self.cut.append(0)
            self.missing_left.append(True)
            self.left.append(LEAF)
            self.right.append(LEAF)
            self.value.append(0.0)
        return self.left[node], self.right[node]

    def kept(self, inner: set[int]) -> Tree:
        """The tree in which only the named nodes are split, with nodes numbered anew."""
        out = Tree()
        todo = [(0, 0)]
        while todo:
            old, new = todo.pop()
            out.value[new] = self.value[old]
            if old in inner:
                children = out.split(new, self.feature[old], self.cut[old], self.missing_left[old])
                todo += zip((self.left[old], self.right[old]), children)
        return out

    def packed(self) -> Tree:
        """The tree with arrays in place of lists: sent as bytes, and not turned into arrays for every batch of rows."""
        return Tree(*map(np.array, (self.feature, self.cut, self.missing_left, self.left, self.right, self.value)))

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of each row of (features, rows) codes."""
        feature, cut, left, right = (np.asarray(x) for x in (self.feature, self.cut, self.left, self.right))
        missing_left = np.asarray(self.missing_left)
        node = np.zeros(codes.shape[1], np.int64)
        live = np.arange(codes.shape[1]) if self.feature[0] != LEAF else np.zeros(0, np.int64)
        while len(live):
            own = node[live]
            code = codes[feature[own], live]
            goes_left = np.where(code == 0, missing_left[own], code <= cut[own])
            own = np.where(goes_left, left[own], right[own])
            node[live] = own
            live = live[feature[own] != LEAF]
        return node

    def predict(self, codes: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.leaves(codes)]

    def row(self) -> tuple:
        """Lists for a table."""
        return (*(np.asarray(x).tolist() for x in (self.feature, self.cut, self.missing_left, self.left, self.right)),
                [float(v) for v in self.value])


TREE_FIELDS = ("feature array<int>, cut array<int>, missing_left array<boolean>, left array<int>, right array<int>, "
               "value array<double>")
