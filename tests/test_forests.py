"""Forests without a depth bound, extra trees and ordered target means."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from innlake.learners import bins, forests
from innlake.learners.forests import Forest, ForestModel, ForestSpec, drawn_cut, grow
from innlake.operators.target_stats import TargetMeans, order_hash, ordered_means
from innlake.session import scratch_path

NAMES = ["a", "b", "c", "d"]


def data(n=1200, classes=0, seed=2):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 60, n), np.round(rng.normal(size=n), 2), rng.integers(0, 2, n), rng.integers(0, 9, n)]).astype(float)
    x[rng.random(n) < 0.05, 3] = np.nan
    y = x[:, 0] % 7 + 3 * (x[:, 1] > 0) * x[:, 2] + rng.normal(size=n) * 0.1
    if classes:
        y = np.digitize(y, np.quantile(y, np.arange(1, classes) / classes)).astype(float)
    return x, y


def frame(spark, x, y):
    rows = [(*[None if np.isnan(v) else float(v) for v in r], float(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double").repartition(3)


def values(model, df):
    return [(r["prediction"], r["y"]) for r in model.transform(df).collect()]


def distinct(x, y):
    _, first = np.unique(np.nan_to_num(x, nan=-1), axis=0, return_index=True)
    return x[first], y[first]


@pytest.mark.parametrize("task_rows", [100_000, 150])
@pytest.mark.parametrize("spec", [
    ForestSpec(trees=1, bootstrap=False), ForestSpec(classes=5, trees=1, features=2, bootstrap=False),
    ForestSpec(trees=1, bootstrap=False, random_cuts=True), ForestSpec(classes=5, trees=2, features=2, bootstrap=False, random_cuts=True),
], ids=["tree", "classes", "extra", "extra-classes"])
def test_no_training_error_on_different_rows(spark, monkeypatch, spec, task_rows):
    """Whether nodes are split by passes first or the whole tree is one task's."""
    monkeypatch.setattr(forests, "TASK_ROWS", task_rows)
    x, y = distinct(*data(classes=spec.classes))
    df = frame(spark, x, y)
    found = values(Forest(NAMES, "y", ForestSpec(**{**vars(spec), "bins": 4000})).fit(df), df)
    assert all(p == pytest.approx(t, abs=1e-9) for p, t in found)


def plain_best(x, y, w, classes):
    """(gain, feature, cut value) of the best of all cuts, by recounting rows; missing values go left."""
    def quality(at):
        t = np.stack([(y == c) * 1.0 for c in range(classes)]) if classes else y[None, :]
        return ((t[:, at] * w[at]).sum(axis=1) ** 2).sum() / w[at].sum()
    best = (-np.inf, None, None)
    for f in range(x.shape[1]):
        v = np.nan_to_num(x[:, f], nan=-1e9)
        for cut in np.unique(v)[:-1]:
            gain = quality(v <= cut) + quality(v > cut)
            if gain > best[0] + 1e-9:
                best = (gain, f, cut)
    return best


@pytest.mark.parametrize("classes", [0, 4])
def test_first_cut_equals_brute_force(spark, monkeypatch, classes):
    x, y = data(300, classes)
    w = np.random.default_rng(1).poisson(1.0, 300).astype(float)
    use = w > 0
    _, feature, cut = plain_best(x[use], y[use], w[use], classes)
    edges = [np.append(np.unique(c[~np.isnan(c)])[:-1], np.inf) for c in x.T]
    sizes = [len(e) + 1 for e in edges]
    spec = ForestSpec(classes=classes, max_depth=1)
    tree = grow(bins.codes_of(x, edges), y, w, spec, sizes, [], np.random.default_rng(0))
    assert tree.feature[0] == feature and (edges[feature][tree.cut[0] - 1] if tree.cut[0] else -1e9) == cut
    monkeypatch.setattr(forests, "TASK_ROWS", 10)
    top = Forest(NAMES, "y", ForestSpec(classes=classes, trees=1, bootstrap=False, max_depth=1, bins=4000)).fit(frame(spark, x, y)).tops[0]
    _, feature, cut = plain_best(x, y, np.ones(300), classes)
    assert top.feature[0] == feature and (edges[feature][top.cut[0] - 1] if top.cut[0] else -1e9) == cut


def test_random_cuts_stand_between_the_ends_and_differ():
    value = np.array([-1.0, 0.0, 1.0, 10.0, 11.0])
    ends = np.full(2000, 1), np.full(2000, 4)
    cut = drawn_cut(value, *ends, np.random.default_rng(0).random(2000))
    assert set(cut) == {1, 2, 3}
    assert np.mean(cut == 2) == pytest.approx(9 / 11, abs=0.03)  # by value, not by code
    x, y = data(400)
    edges = [np.append(np.unique(c[~np.isnan(c)])[:-1], np.inf) for c in x.T]
    values_ = [np.concatenate([[e[0] - 1], e[:-1], [np.nanmax(c)]]) for e, c in zip(edges, x.T)]
    spec = ForestSpec(random_cuts=True, bootstrap=False, max_depth=1, features=1)
    cuts = {(t.feature[0], t.cut[0]) for i in range(30) for t in [
        grow(bins.codes_of(x, edges), y, np.ones(400), spec, [len(e) + 1 for e in edges], values_, np.random.default_rng(i))]}
    assert len(cuts) > 10


@pytest.mark.parametrize("classes", [0, 3])
@pytest.mark.parametrize("task_rows", [100_000, 200])
def test_forest_by_broadcast_and_by_join(spark, monkeypatch, classes, task_rows):
    monkeypatch.setattr(forests, "TASK_ROWS", task_rows)
    x, y = data(900, classes)
    df = frame(spark, x, y)
    model = Forest(NAMES, "y", ForestSpec(classes=classes, trees=7, features=2)).fit(df)
    whole = sorted(values(model, df))
    error = np.mean([p != t if classes else (p - t) ** 2 for p, t in whole])
    assert error < (0.2 if classes else 1.0)
    path = scratch_path(spark, "forest")
    model.save(path)
    monkeypatch.setattr(forests, "SHARED_NODES", 1)
    joined = sorted(values(ForestModel.load(spark, path), df))
    assert np.allclose(joined, whole)


def test_constant_labels_and_no_rows(spark):
    x, _ = data(50)
    df = frame(spark, x, np.full(50, 2.0))
    assert set(values(Forest(NAMES, "y", ForestSpec(trees=2)).fit(df), df)) == {(2.0, 2.0)}
    with pytest.raises(ValueError, match="no labels"):
        Forest(NAMES, "y", ForestSpec(trees=2)).fit(df.limit(0))


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_ordered_means_see_earlier_rows_only(spark, block_rows):
    rows = [(i, [None, "x", "y", "z"][i % 4 if i % 3 else 1], f"l{i % 50}", None if i % 13 == 0 else i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a string, b string, y int")
    found = {r["id"]: r for r in ordered_means(df, "id", ["a", "b"], "y", 2.0, block_rows).collect()}
    order = {r["id"]: r["h"] for r in df.select("id", order_hash(F.col("id")).alias("h")).collect()}
    overall = np.mean([r[3] for r in rows if r[3] is not None])
    assert len(found) == 300
    for i, a, b, _ in rows:
        for name, at, level in (("a_target", 1, a), ("b_target", 2, b)):
            before = [r[3] for r in rows if r[at] == level and r[3] is not None and (order[r[0]], r[0]) < (order[i], i)]
            assert found[i][name] == pytest.approx((sum(before) + 2.0 * overall) / (len(before) + 2.0))


def test_target_means_score_new_rows(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (2, "x", 0.0), (3, None, 5.0)], "id int, a string, y double")
    means = TargetMeans.fit(df, ["a"], "y")
    path = scratch_path(spark, "means")
    means.save(path)
    new = spark.createDataFrame([("x",), (None,), ("new",)], "a string")
    found = {r["a"]: r["a_target"] for r in TargetMeans.load(spark, path).transform(new).collect()}
    assert found == {"x": (1 + 2) / 3, None: (5 + 2) / 2, "new": 2.0}
    empty = df.filter("id > 5")
    assert ordered_means(empty, "id", ["a"], "y").collect() == []


@pytest.mark.parametrize("random_cuts", [False, True])
def test_work_of_a_node_does_not_grow_with_classes(monkeypatch, random_cuts):
    rng = np.random.default_rng(3)
    codes = np.stack([rng.permutation(200), np.full(200, 7), rng.integers(1, 3, 200)]).astype(np.uint8)
    labels, added = rng.integers(0, 40, 200).astype(float), []
    plain = np.bincount

    def counted(key, *args, **kwargs):
        added.append(len(key))
        return plain(key, *args, **kwargs)

    monkeypatch.setattr(np, "bincount", counted)
    spec = forests.ForestSpec(classes=40, trees=1, bootstrap=False, random_cuts=random_cuts, max_depth=1)
    values = [np.arange(256.0)] * 3
    tree = forests.grow(codes, labels, np.ones(200), spec, [256] * 3, values, np.random.default_rng(1))
    # Two levels' totals, and at most twice two varying features of the root; the constant one isn't added up.
    assert sum(added) <= (2 + 2 * 2) * 200
    whole = forests.grow(codes, labels, np.ones(200), replace(spec, max_depth=99), [256] * 3, values, np.random.default_rng(1))
    assert len(tree.feature) == 3 and np.array_equal(whole.predict(codes), labels)
    assert np.array_equal(whole.packed().predict(codes), labels)


@pytest.mark.parametrize("classes", [0, 5])
def test_packs_find_the_same_trees(monkeypatch, classes):
    """Exclusive indicators are added up as one code; of weights that are whole numbers the sums are the same."""
    rng = np.random.default_rng(6)
    level, other = rng.integers(0, 9, 6000), rng.integers(0, 4, 6000)
    codes = np.stack([*(1 + (level == i) for i in range(8)), *(1 + (other == i) for i in range(3)), rng.integers(1, 7, 6000),
                      rng.integers(1, 200, 6000), np.full(6000, 3)]).astype(np.uint8)
    labels = (level * 3 + codes[11] + rng.integers(0, 3, 6000)) % (classes or 50) * 1.0
    w, added = 1.0 + rng.poisson(1.0, 6000), []
    spec, sizes = ForestSpec(classes=classes), [3] * 11 + [7, 200, 4]
    packed = forests._Level.packed_cuts
    monkeypatch.setattr(forests._Level, "packed_cuts", lambda self, pack, *rest: added.append(len(pack.sides)) or packed(self, pack, *rest))
    whole = grow(codes, labels, w, spec, sizes, [], np.random.default_rng(0))
    assert set(added) == {9, 4, 6}
    monkeypatch.setattr(forests, "PACK_ROWS", 1 << 30)
    added.clear()
    assert whole == grow(codes, labels, w, spec, sizes, [], np.random.default_rng(0)) and not added
    monkeypatch.setattr(forests, "PACK_ROWS", 0)  # rows beyond the first ones, where two indicators meet
    codes[0, 5000:] = codes[1, 5000:] = 2
    at = forests._by_row(codes)
    packs, found = forests._packs(at, len(codes))
    for pack, own in zip(packs, found):
        assert all(np.array_equal(side[own], codes[f] <= c) for f, c, side in zip(pack.feature, pack.cut, pack.sides.T))
    assert sorted({f for p in packs for f in p.feature.tolist()}) == list(range(12))


def test_subtrees_are_packed_and_lists_still_load(spark, monkeypatch):
    monkeypatch.setattr(forests, "TASK_ROWS", 200)
    x, y = data(900, 3)
    df = frame(spark, x, y)
    model = Forest(NAMES, "y", ForestSpec(classes=3, trees=4, features=2)).fit(df)
    rows = model.subtrees.collect()
    assert model.subtrees.columns == ["tree", "node", "nodes"] and len(rows) > 4
    trees = {(r["tree"], r["node"]): forests.unpack_tree(r["nodes"]) for r in rows}
    assert all(forests.pack_tree(t) == bytes(r["nodes"]) and len(r["nodes"]) == 16 * len(t.feature) for r, t in zip(rows, trees.values()))
    path = scratch_path(spark, "lists")
    model.save(path)
    lists = spark.createDataFrame([(*name, *t.row()) for name, t in trees.items()], f"tree int, node int, {forests.TREE_FIELDS}")
    lists.write.mode("overwrite").parquet(f"{path}/subtrees")
    assert sorted(values(ForestModel.load(spark, path), df)) == sorted(values(model, df))


@pytest.mark.parametrize("random_cuts", [False, True])
def test_wide_nodes_of_one_class_and_of_constant_features(spark, monkeypatch, random_cuts):
    monkeypatch.setattr(forests, "TASK_ROWS", 20)
    spec = ForestSpec(classes=4, trees=6, features=1, bootstrap=False, random_cuts=random_cuts)
    x, _ = data(120)
    x[:, :3] = 1.0  # most features drawn have no cut
    x[:, 3] = np.arange(120) // 30
    found = values(Forest(NAMES, "y", spec).fit(frame(spark, x, np.full(120, 2.0))), frame(spark, x, np.full(120, 2.0)))
    assert set(found) == {(2.0, 2.0)}
    found = values(Forest(NAMES, "y", spec).fit(frame(spark, x, x[:, 3])), frame(spark, x, x[:, 3]))
    assert all(p == t for p, t in found)


def test_turns_take_only_features_that_vary():
    rng = np.random.default_rng(2)
    codes = np.ones((40, 600), np.uint8)
    codes[7], codes[21, 300:], codes[30, :300] = rng.integers(0, 9, 600), rng.integers(2, 4, 300), rng.integers(5, 7, 300)
    level = forests._Level(ForestSpec(classes=2), np.full(40, 10), forests._by_row(codes), rng.integers(0, 2, 600), np.ones(600),
                           np.array([300, 300]))
    assert [np.flatnonzero(own).tolist() for own in level.varies()] == [[7, 30], [7, 21]]
    turns = [(nodes.tolist(), own.tolist()) for nodes, own, *_ in level.turns(level.varies())]
    assert turns == [([0, 1], [7, 7]), ([0, 1], [30, 21])]
    for _, own, rows, place, code in level.turns(level.varies()):
        assert np.array_equal(code, codes[own[place], rows])
