"""Boosted trees against a plain single-process booster and closed forms."""

import numpy as np
import pytest

from innlake.learners import bins, boosting, bundles
from innlake.learners.boosting import LOGISTIC, SOFTMAX, SQUARED, BoostedModel, BoostedTrees, Growth, gradients
from innlake.session import scratch_path

NAMES = ["a", "b", "c", "d"]


def data(n=2000, seed=1, classes=0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 40, n), np.round(rng.normal(size=n), 1), rng.integers(0, 2, n), rng.integers(0, 5, n)]).astype(float)
    x[rng.random(n) < 0.1, 1] = np.nan
    y = np.where(np.isnan(x[:, 1]), 3.0, x[:, 1]) * 2 + (x[:, 0] > 17) * x[:, 3] + rng.normal(size=n) * 0.3
    if classes:
        y = np.clip(np.digitize(y, np.quantile(y, np.arange(1, classes) / classes)), 0, classes - 1).astype(float)
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(*[None if np.isnan(v) else float(v) for v in r], float(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double").repartition(parts)


def plain_tree(x, g, h, growth):
    """Recursion over rows and all cuts between different values; (rows, value) of each leaf."""
    def quality(rows):
        t = np.sign(g[rows].sum()) * max(abs(g[rows].sum()) - growth.l1, 0)
        return t * t / (h[rows].sum() + growth.l2) if h[rows].sum() + growth.l2 > 0 else 0.0

    def best(rows):
        found = (growth.min_gain + 1e-12, None)
        for f in range(x.shape[1]):
            v = x[rows, f]
            for cut in np.unique(v[~np.isnan(v)])[:None]:
                for missing_left in (True, False):
                    left = np.where(np.isnan(v), missing_left, v <= cut)
                    a, b = rows[left], rows[~left]
                    if min(len(a), len(b)) < growth.min_rows or not (~np.isnan(v) & ~left).any() and not missing_left:
                        continue
                    if not len(a) or not len(b) or min(h[a].sum(), h[b].sum()) < growth.min_hessian:
                        continue
                    gain = (quality(a) + quality(b) - quality(rows)) / 2
                    if gain > found[0] + 1e-9:
                        found = (gain, (a, b))
        return found

    everything = np.arange(len(x))
    leaves = [(best(everything), everything, 0)]
    done = []
    while leaves:
        if growth.max_leaves:
            leaves.sort(key=lambda n: -n[0][0] if n[0][1] is not None else np.inf)
            if len(leaves) + len(done) >= growth.max_leaves:
                done += leaves
                break
        (_, parts), rows, depth = leaves.pop(0)
        if parts is None or not growth.max_leaves and depth == growth.max_depth:
            done.append((None, rows, depth))
            continue
        leaves += [(best(p), p, depth + 1) for p in parts]
    out = np.zeros(len(x))
    for _, rows, _ in done:
        t = np.sign(g[rows].sum()) * max(abs(g[rows].sum()) - growth.l1, 0)
        out[rows] = -growth.rate * growth.leaf_scale * t / (h[rows].sum() + growth.l2)
    return out


def plain_scores(x, y, growth):
    if growth.loss == SOFTMAX:
        start = np.log(np.bincount(y.astype(int)) / len(y))
    else:
        m = y.mean()
        start = np.array([m if growth.loss == SQUARED else np.log(m / (1 - m))])
    scores = np.repeat(start[:, None], len(x), axis=1)
    for _ in range(growth.rounds):
        g, h = gradients(growth.loss, scores, y)
        scores = scores + np.stack([plain_tree(x, g[k], h[k], growth) for k in range(len(scores))])
    return scores


@pytest.mark.parametrize("growth", [
    Growth(rounds=3, max_leaves=9, min_rows=20, min_hessian=1e-3),
    Growth(rounds=2, max_depth=3, l2=1.0, l1=2.0, min_hessian=5.0, rate=0.3),
    Growth(loss=LOGISTIC, rounds=2, max_leaves=6, l2=0.5, min_rows=5),
    Growth(loss=SOFTMAX, n_classes=3, rounds=2, max_depth=2, min_hessian=1e-3),
    Growth(loss=SOFTMAX, n_classes=3, rounds=1, max_leaves=5, min_rows=20),
], ids=["leafwise", "second-order", "logistic", "softmax", "leafwise-classes"])
@pytest.mark.parametrize("task_rows", [1 << 20, 120, 0])
def test_equals_a_plain_booster(spark, monkeypatch, growth, task_rows):
    """Grown in a task, by passes down to small nodes, or by passes alone."""
    monkeypatch.setattr(boosting, "TASK_ROWS", task_rows)
    classes = {SQUARED: 0, LOGISTIC: 2, SOFTMAX: 3}[growth.loss]
    x, y = data(2000 if growth.loss == SQUARED else 600, classes=classes)
    model = BoostedTrees(NAMES, "y", growth).fit(frame(spark, x, y))
    assert model.scores(x) == pytest.approx(plain_scores(x, y, growth), abs=1e-6)


def test_sums_are_merged_by_spark_beyond_a_size(spark, monkeypatch):
    x, y = data(600, classes=3)
    growth = Growth(loss=SOFTMAX, n_classes=3, rounds=2, max_leaves=5)
    models = []
    monkeypatch.setattr(boosting, "TASK_ROWS", 0)
    for limit in (boosting.DRIVER_BYTES, 0):
        monkeypatch.setattr(boosting, "DRIVER_BYTES", limit)
        monkeypatch.setattr(bins, "BLOCK_ROWS", 150)
        models.append(BoostedTrees(NAMES, "y", growth).fit(frame(spark, x, y, 4)))
    assert models[0].scores(x) == pytest.approx(models[1].scores(x), abs=1e-9)


def test_best_first_makes_the_largest_gains(spark):
    x, y = data()
    by_leaf = BoostedTrees(NAMES, "y", Growth(rounds=1, rate=1.0, max_leaves=12)).fit(frame(spark, x, y))
    tree = by_leaf.trees[0][0]
    assert tree.feature.count(-1) == 12
    by_level = BoostedTrees(NAMES, "y", Growth(rounds=1, rate=1.0, max_depth=3)).fit(frame(spark, x, y))
    error = [np.mean((m.predicted(x) - y) ** 2) for m in (by_leaf, by_level)]
    assert error[0] < error[1]


def test_missing_values_learn_their_side(spark):
    x = np.column_stack([np.where(np.arange(100) % 4 == 0, np.nan, np.arange(100) % 3)] + [np.zeros(100)] * 3)
    y = np.where(np.isnan(x[:, 0]), 10.0, np.where(x[:, 0] == 2, 10.0, 0.0))
    model = BoostedTrees(NAMES, "y", Growth(rounds=1, rate=1.0, max_depth=1)).fit(frame(spark, x, y))
    assert model.predicted(x) == pytest.approx(y)


def test_transform_save_and_load(spark):
    x, y = data(300, classes=3)
    df = frame(spark, x, y)
    model = BoostedTrees(NAMES, "y", Growth(loss=SOFTMAX, n_classes=3, rounds=12, subsample=0.8, max_leaves=4)).fit(df)
    path = scratch_path(spark, "boosted")
    model.save(path)
    again = BoostedModel.load(spark, path)
    found = again.transform(df).collect()
    rows = np.array([[np.nan if r[c] is None else r[c] for c in NAMES] for r in found])
    assert [r["prediction"] for r in found] == model.predicted(rows).tolist()
    assert np.mean([r["prediction"] == r["y"] for r in found]) > 0.8


def test_sums_need_a_fixed_number_of_passes(spark, monkeypatch):
    passes = []
    monkeypatch.setattr(boosting, "TASK_ROWS", 0)
    own = boosting._Rounds.sums
    monkeypatch.setattr(boosting._Rounds, "sums", lambda self, *a: passes.append(1) or own(self, *a))
    x, y = data(500, classes=3)
    BoostedTrees(NAMES, "y", Growth(loss=SOFTMAX, n_classes=3, rounds=2, max_depth=3)).fit(frame(spark, x, y))
    assert len(passes) <= 2 * (3 + 1)  # all classes share them
    passes.clear()
    BoostedTrees(NAMES, "y", Growth(rounds=1, max_leaves=31)).fit(frame(spark, *data(500)))
    assert len(passes) < 15


def test_edges(spark):
    df = spark.createDataFrame([(float(i % 7), float(i), None, float("nan")) for i in range(3000)],
                               "a double, b double, c double, d double")
    edges = bins.find_edges(df, NAMES, 50)
    assert edges[0].tolist() == [0, 1, 2, 3, 4, 5, np.inf]
    assert 45 <= len(edges[1]) <= 50 and edges[1][-1] == np.inf and np.all(np.diff(edges[1][:-1]) > 0)
    codes = bins.codes_of(np.array([[0.0, 1e9, np.nan, 1.0], [6.0, -5.0, 2.0, np.nan], [9.0, 0.0, 0.0, 0.0]]), edges)
    assert codes[0].tolist() == [1, 7, 7] and codes[1].tolist() == [len(edges[1]), 1, 1] and codes[2, 0] == 0


def test_no_rows(spark):
    with pytest.raises(ValueError, match="no labels"):
        BoostedTrees(NAMES, "y", Growth()).fit(frame(spark, *data(0)))


def test_a_tree_takes_a_pass_for_each_level_that_may_be_split(spark, monkeypatch):
    """The last level's leaves have no pass of their own: their weights follow from the splits."""
    passes = []
    monkeypatch.setattr(boosting, "TASK_ROWS", 0)
    own = boosting._Rounds.sums
    monkeypatch.setattr(boosting._Rounds, "sums", lambda self, *a: passes.append(1) or own(self, *a))
    x, y = data(500, classes=3)
    BoostedTrees(NAMES, "y", Growth(loss=SOFTMAX, n_classes=3, rounds=2, max_depth=3)).fit(frame(spark, x, y))
    assert len(passes) == 2 * 3


def test_bundles_name_every_rows_codes(spark):
    rng = np.random.default_rng(5)
    level = rng.integers(0, 9, 3000)
    x = np.column_stack([*(level == i for i in range(9)), rng.integers(0, 200, 3000), rng.integers(0, 200, 3000)]).astype(float)
    x[rng.random(3000) < 0.05, 3] = np.nan
    names = [f"f{i}" for i in range(11)]
    df = spark.createDataFrame([(*[None if np.isnan(v) else float(v) for v in r], 1.0) for r in x],
                               ", ".join(f"{n} double" for n in [*names, "y"])).repartition(3)
    edges = bins.find_edges(df, names)
    plain = bins.blocks(df, names, edges, "y").persist()
    found = bundles.find(plain, edges)
    assert sorted(f for b in found for f in b.features) == list(range(11))
    assert len(found) == 3 and max(b.size for b in found) <= bundles.JOINT_CODES
    together = {r["block"]: r for r in bundles.joint(plain, edges, found).collect()}
    layout = boosting.Layout.of(edges)
    joint = bundles.Joint(found, layout.begin)
    for r in plain.collect():
        codes, _ = bins.opened(r, 11, bins.code_type(edges))
        new = np.frombuffer(together[r["block"]]["codes"], joint.kind).reshape(len(found), -1)
        for b, own in zip(found, new):
            for f, of_joint in zip(b.features, b.codes):
                assert (of_joint[own] == codes[f]).all()
        out = np.zeros((3, joint.begin[-1]))
        g = rng.normal(size=r["n"])
        boosting._add(out, new, g, None, None, joint)
        sums = joint.by_feature(out)
        for f, size in enumerate(layout.sizes):
            part = slice(layout.begin[f], layout.begin[f + 1])
            assert sums[0, part] == pytest.approx(np.bincount(codes[f], g, size)) and (sums[2, part] == np.bincount(codes[f], minlength=size)).all()
    plain.unpersist()


def test_a_column_of_as_many_values_as_bins_has_an_edge_for_each(spark):
    df = spark.range(0, 4000, 1, 4).selectExpr("cast(id % 255 as double) a", "cast(id % 256 as double) b", "cast(id div 1000 as double) c")
    edges = bins.find_edges(df, ["a", "b", "c"])
    assert edges[0].tolist() == [*range(254), np.inf] and len(edges[1]) <= 255 and edges[2].tolist() == [0, 1, 2, np.inf]


def test_passes_have_a_task_for_each_core(spark, monkeypatch):
    monkeypatch.setattr(bins, "BLOCK_ROWS", 20)
    x, y = data(400)
    df = frame(spark, x, y, parts=16)
    edges = bins.find_edges(df, NAMES)
    blocks = bins.blocks(df, NAMES, edges, "y")
    assert blocks.rdd.getNumPartitions() == 16
    cores = spark.sparkContext.defaultParallelism
    for most in (32, 1):
        monkeypatch.setattr(boosting, "TASK_PARTITIONS", most)
        rounds = boosting._Rounds(blocks, np.zeros(1), edges, Growth())
        assert rounds.tasks == min(16, max(cores, 16 // most)) and rounds.rows == 400
        rounds.close()


@pytest.mark.parametrize("depth,wanted", [(0, 1), (3, 1), (4, 2), (5, 1), (6, 1), (8, 1), (8, 3)])
def test_rows_are_told_apart_by_bits(depth, wanted):
    """Trees of up to 256 leaves, some features cut by sets of codes: against each row's own way."""
    rng = np.random.default_rng(depth)
    edges = [bins.level_edges(n) for n in (7, 12, 31, 4)]
    joint = bundles.Joint.alone(boosting.Layout.of(edges).begin, frozenset((0, 2)))
    codes = np.stack([rng.integers(0, len(e) + 1, 3000) for e in edges]).astype(np.uint8)
    tree, ends = boosting.Tree(), [0]
    for _ in range(depth):
        below = []
        for node in ends:
            f = int(rng.integers(4))
            size = len(edges[f])
            cut = bundles.code_set((np.flatnonzero(rng.random(size) < 0.5) + 1).tolist()) if f in (0, 2) else int(rng.integers(1, size))
            below += tree.split(node, f, cut, bool(rng.integers(2)))
        ends = below
    tree.value = rng.normal(size=len(tree.feature)).tolist()

    def end(row):
        node = 0
        while tree.feature[node] >= 0:
            f, code, cut = tree.feature[node], int(row[tree.feature[node]]), tree.cut[node]
            left = tree.missing_left[node] if not code else bool(cut >> (code - 1) & 1) if f in (0, 2) else code <= cut
            node = tree.left[node] if left else tree.right[node]
        return node

    own = np.array([end(row) for row in codes.T])
    assert np.array_equal(boosting._Values(tree, joint).predict(codes), np.array(tree.value)[own])
    some = ends[::wanted]
    rows = np.sort(rng.permutation(3000)[:2000])
    for drawn in (None, rows):
        found = {}
        for marks in boosting._marks(tree, joint, some):
            at, places = marks.find(codes, drawn)
            at = np.arange(3000) if at is None else at
            for node, row in zip(np.array(marks.ends)[np.zeros(len(at), int) if places is None else places], at):
                assert found.setdefault(int(row), int(node)) == node
        assert found == {r: int(own[r]) for r in (range(3000) if drawn is None else rows.tolist()) if own[r] in set(some)}


def test_categories_are_cut_by_the_best_set():
    rng = np.random.default_rng(3)
    edges = [bins.level_edges(6), bins.level_edges(3)]
    layout = boosting.Layout.of(edges, frozenset((0,)))
    code, other = rng.integers(1, 6, 500), rng.integers(1, 4, 500)  # the last level of the first has no rows
    g = rng.normal(size=6)[code - 1] + rng.normal(size=500) * 0.1
    sums = np.zeros((1, 3, layout.begin[-1]))
    boosting._add(sums, np.stack([code, other]), g, None, None, bundles.Joint.alone(layout.begin))
    split, = boosting.best_splits(sums.copy(), layout, Growth())
    def gain(left):
        return (g[left].sum() ** 2 / left.sum() + g[~left].sum() ** 2 / (~left).sum() - g.sum() ** 2 / 500) / 2
    best = max(gain(np.isin(code, [c + 1 for c in range(5) if s >> c & 1])) for s in range(1, 31))
    _, goes = bundles.Joint.alone(layout.begin, layout.categories).side(split.feature, split.cut, split.missing_left)
    assert split.feature == 0 and split.gain == pytest.approx(best) and gain(goes[code]) == pytest.approx(best)
    assert not goes[6] and split.left[2] == goes[code].sum()
