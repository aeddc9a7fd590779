from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from innlake.functions.scalars import rate_category
from innlake.learners import adaboost, bayesian_ridge, bins, boosting, forests, indexed, knn, presets, stepped
from innlake.learners.boosting import BoostedModel
from innlake.learners.scoring import predictions
from innlake.learners.store import ModelStore, NoChampionError
from innlake.operators.conform import historical_cancel, historical_price
from innlake.operators.evaluation import classification_facts, regression_facts
from innlake.schemas import CANCEL_PREDICTORS, PRICE_PREDICTORS, VOCABULARY, indicator
from innlake.session import ensure_checkpoint_dir, scratch_path
from innlake.sources.booking_views import bookings

SF = "/root/testdata/sf0.001"


def brute_force(train, queries, k):
    out = {}
    for qid, q in queries:
        order = sorted((sum((a - b) ** 2 for a, b in zip(q, t)), tid, label) for tid, t, label in train)[:k]
        votes = {}
        for _, _, label in order:
            votes[label] = votes.get(label, 0) + 1
        out[qid] = min(votes, key=lambda c: (-votes[c], c))
    return out


@pytest.mark.parametrize("shape", ["clusters", "duplicates", "tiny"])
def test_knn_equals_brute_force(spark, shape):
    rng = np.random.default_rng(7)
    if shape == "clusters":
        points = rng.normal(size=(400, 3)) + rng.integers(0, 5, size=(400, 1)) * 8
    elif shape == "duplicates":
        # Half of all rows are the same point, the rest sits on a coarse grid.
        points = rng.integers(0, 3, size=(400, 3)).astype(float)
        points[::2] = 1.0
    else:
        points = rng.normal(size=(23, 2))
    labels = rng.integers(0, 4, size=len(points)).tolist()
    rows = [(i, p.tolist(), int(c)) for i, (p, c) in enumerate(zip(points, labels))]
    train, queries = rows[20:], [(i, p) for i, p, _ in rows[:20]]
    df = spark.createDataFrame(train, "id bigint, v array<double>, y int").repartition(5)
    model = knn.fit_knn(df, "id", "v", "y", k=5, n_pivots=6, block_rows=16)
    q = spark.createDataFrame(queries, "qid bigint, v array<double>").repartition(3)
    found = {r.qid: r.prediction for r in model.classify(q, "qid", "v").collect()}
    assert found == brute_force(train, queries, 5)
    path = scratch_path(spark, "knn")
    model.save(path)
    again = knn.KnnModel.load(spark, path).classify(q, "qid", "v")
    assert {r.qid: r.prediction for r in again.collect()} == found


def test_knn_skips_far_cells(spark, monkeypatch):
    rows = [(i, [float(i % 2) * 1000 + i / 100, 0.0], i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, y int")
    model = knn.fit_knn(df, "id", "v", "y", n_pivots=8)
    q = spark.createDataFrame([(1, [0.5, 0.0])], "qid bigint, v array<double>")
    visited = []
    compared = knn.KnnModel._compared
    monkeypatch.setattr(knn.KnnModel, "_compared", lambda self, v: visited.append(v.count()) or compared(self, v))
    assert model.neighbours(q, "qid", "v").count() == 5
    # The query's own cell first, then few others.
    assert visited[0] == 1 and sum(visited) < len(model.cells) / 2


def test_stored_models_of_every_kind(spark):
    store = ModelStore(spark, scratch_path(spark, "kinds"))
    df = spark.createDataFrame([(float(i), float(i % 7), float(i % 7 > 3)) for i in range(60)], "i double, a double, y double")
    boosted = adaboost.AdaBoost(["a"], "y", 2, rounds=3).fit(df)
    formula = bayesian_ridge.LinearFormula(["a"], [2.0], -1.0)
    for candidate, model, data in (("boosted", boosted, df), ("formula", formula, df)):
        store.promote("m", candidate, model, 0.5)
        again = store.load("m").transform(data).select("prediction").collect()
        assert again == model.transform(data).select("prediction").collect()
    with pytest.raises(ValueError, match="no metric"):
        store.promote("m", "nan", formula, float("nan"))


def test_bayesian_ridge_recovers_a_line(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 3)) + [2000, 0, 5]
    y = x @ [2.0, -1.0, 0.0] + 7 + rng.normal(scale=0.1, size=500)
    df = spark.createDataFrame(np.column_stack([x, y]).tolist(), "a double, b double, c double, y double")
    n, means, gram = bayesian_ridge.centred_gram(df.repartition(4), ["a", "b", "c", "y"])
    centred = np.column_stack([x, y]) - np.column_stack([x, y]).mean(axis=0)
    assert n == 500 and gram == pytest.approx(centred.T @ centred, abs=1e-6)
    model = bayesian_ridge.fit_bayesian_ridge(df, ["a", "b", "c"], "y")
    assert model.coefficients == pytest.approx([2.0, -1.0, 0.0], abs=0.02)
    errors = model.transform(df).select((F.col("prediction") - F.col("y")).alias("e")).collect()
    assert np.std([r.e for r in errors]) == pytest.approx(0.1, rel=0.2)


def plain_adaboost(x, y, rounds):
    """SAMME with stumps, by recounting all cuts; the votes' winner for each row."""
    w, votes = np.ones(len(y)), np.zeros((2, len(y)))
    for _ in range(rounds):
        best = (-1.0, None)
        for f in range(x.shape[1]):
            for cut in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= cut
                gain = sum(sum((w[s] * (y[s] == c)).sum() ** 2 for c in (0, 1)) / w[s].sum() for s in (left, ~left))
                if gain > best[0] + 1e-9:
                    best = (gain, left)
        guess = np.empty(len(y))
        for s in (best[1], ~best[1]):
            guess[s] = float((w[s] * (y[s] == 1)).sum() > (w[s] * (y[s] == 0)).sum())
        error = w[guess != y].sum() / w.sum()
        alpha = np.log((1 - error) / error)
        votes[guess.astype(int), np.arange(len(y))] += alpha
        w = w * np.where(guess != y, np.exp(alpha), 1.0)
        w *= len(y) / w.sum()
    return votes.argmax(axis=0)


def test_adaboost_equals_a_plain_one(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.uniform(-1, 1, size=(600, 2)), 2)
    label = (x.sum(axis=1) > 0).astype(float)
    df = spark.createDataFrame(np.column_stack([x, label]).tolist(), "a double, b double, y double")
    accuracy = []
    for rounds in (1, 12):
        model = adaboost.AdaBoost(["a", "b"], "y", 2, rounds=rounds).fit(df)
        assert (model.predicted(x) == plain_adaboost(x, label, rounds)).all()
        accuracy.append(model.transform(df).filter("prediction = y").count() / 600)
    assert accuracy[1] > accuracy[0] + 0.05 and accuracy[1] > 0.9


def test_adaboost_multiclass_and_perfect_tree(spark):
    df = spark.createDataFrame([(float(i % 3), float(i % 3)) for i in range(60)], "a double, y double")
    for depth in (3, presets.UNBOUNDED):
        model = adaboost.AdaBoost(["a"], "y", 3, rounds=5, max_depth=depth).fit(df)
        assert len(model.trees) == 1
        assert model.transform(df).filter("prediction = y").count() == 60


def test_store_versions_and_reload(spark):
    store = ModelStore(spark, scratch_path(spark, "models"))
    with pytest.raises(NoChampionError):
        store.load("price")
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "a double, y double")
    model = presets.regressor("linear", ["a"], "y").fit(df)
    store.promote("price", "linear", model, 0.9)
    second = store.promote("price", "linear", model, 0.95)
    assert second.version == 2 and store.current("price") == second
    scored = predictions(store.load("price"), df, ["a"])
    assert scored.columns == ["a", "y", "prediction"]
    assert [r.prediction for r in scored.collect()] == pytest.approx([r.y for r in df.collect()])


SMALL = {"rounds": 2, "trees": 2, "forest_depth": 3}


@pytest.mark.parametrize("name", ["random_forest", "gbt", "gbt_deep", "gbt_subsample", "gbt_indexed", "elastic_net",
                                  "leafwise", "second_order", "ordered"])
def test_price_presets_beat_the_mean(spark, name):
    df = historical_price(bookings(spark, SF)).cache()
    ensure_checkpoint_dir(spark)
    scored = presets.regressor(name, PRICE_PREDICTORS, "adr", **SMALL).fit(df).transform(df)
    assert regression_facts(df, scored, "adr", "prediction").first()["beats_baseline"]


@pytest.mark.parametrize("name", ["random_forest", "extra_trees", "gbt", "gbt_indexed", "decision_tree", "leafwise", "second_order",
                                  "ordered"])
def test_cancel_presets_fit(spark, name):
    df = historical_cancel(bookings(spark, SF)).cache()
    scored = presets.classifier(name, CANCEL_PREDICTORS, "is_canceled", **SMALL).fit(df).transform(df)
    assert classification_facts(df, scored, "is_canceled", "prediction").first()["n_classes"] == 2


@pytest.mark.parametrize("name", ["gbt_multiclass", "gbt_deep", "leafwise", "extra_trees", "random_forest", "decision_tree"])
def test_bands_share_a_model(spark, name):
    df = historical_price(bookings(spark, SF)).withColumn("band", rate_category(F.col("adr")) - 1)
    df = df.filter("band < 3").cache()
    ensure_checkpoint_dir(spark)
    model = presets.classifier(name, PRICE_PREDICTORS, "band", **SMALL, classes=3).fit(df)
    if name in ("gbt_multiclass", "gbt_deep", "leafwise"):
        assert [len(grown) for grown in model.trees] == [3, 3]
    found = classification_facts(df, model.transform(df), "band", "prediction").first()
    # Two rounds at a rate of 0.1 don't outvote the commonest class yet.
    assert found["beats_baseline"] or isinstance(model, BoostedModel)


@pytest.mark.parametrize("name", ["leafwise", "ordered", "random_forest"])
def test_own_models_are_stored(spark, name):
    store = ModelStore(spark, scratch_path(spark, "own"))
    df = historical_price(bookings(spark, SF)).cache()
    model = presets.regressor(name, PRICE_PREDICTORS, "adr", **SMALL).fit(df)
    store.promote("price", name, model, 0.5)
    found = [{r["Booking_ID"]: r["prediction"] for r in m.transform(df).collect()} for m in (model, store.load("price"))]
    assert found[0] == found[1] and len(found[0]) == df.count()


@pytest.mark.parametrize("low", [0, 10 ** 6])
def test_only_possible_neighbours_are_compared_in_full(monkeypatch, low):
    rng = np.random.default_rng(8)
    queries, points = (low + rng.integers(0, 3, (n, 6)).astype(float) for n in (700, 300))  # many equal distances
    whole = knn._squared_distances(queries, points)
    order = np.argsort(whole, axis=1, kind="stable")[:, :4]
    monkeypatch.setattr(knn, "_squared_distances", None)
    rows, picked, distance = knn.nearest(queries, points, 4)
    assert np.array_equal(rows, np.repeat(np.arange(700), 4)) and np.array_equal(picked, order.ravel())
    assert np.array_equal(distance, whole[rows, picked])


@pytest.mark.parametrize("wide", [True, False])
def test_leaves_that_boxes_keep_apart_are_not_compared(monkeypatch, wide):
    rng = np.random.default_rng(9)
    points = np.column_stack([37.0 * rng.integers(0, 12, 9000), rng.integers(0, 7, 9000), rng.integers(0, 3, (9000, 8)) * (wide or 1e-9)])
    queries = np.concatenate([points[:700], points[:100] + 0.3])
    want = knn.nearest(queries, points, 4)
    pairs, near = [], knn.nearest
    monkeypatch.setattr(knn, "nearest", lambda q, p, *rest: pairs.append(len(q) * len(p)) or near(q, p, *rest))
    for reach in (None, want[2].reshape(-1, 4)[:, 3]):
        pairs.clear()
        found = knn.search(queries, points, 4, reach)
        assert all(np.array_equal(x, y) for x, y in zip(found, want))
        assert sum(pairs) < 0.5 * len(queries) * len(points)
    points[17, 3] = queries[5, 1] = np.nan
    assert all(np.array_equal(x, y, equal_nan=True) for x, y in zip(knn.search(queries, points, 4), near(queries, points, 4)))


def test_knn_visits_few_cells(spark, monkeypatch):
    rng = np.random.default_rng(10)
    points = np.column_stack([37 * rng.integers(0, 12, 3000), rng.integers(0, 7, (3000, 2)), rng.integers(0, 2, (3000, 6))]).astype(float)
    rows = [(i, p.tolist(), i % 3) for i, p in enumerate(points)]
    model = knn.fit_knn(spark.createDataFrame(rows[300:], "id bigint, v array<double>, y int"), "id", "v", "y", n_pivots=32)
    visits, compared = [], knn.KnnModel._compared
    monkeypatch.setattr(knn.KnnModel, "_compared", lambda self, v: visits.append(v.count()) or compared(self, v))
    found = model.neighbours(spark.createDataFrame([r[:2] for r in rows[:300]], "qid bigint, v array<double>"), "qid", "v").collect()
    assert len(found) == 300 * 5 and len(model.cells) == 32
    assert visits[0] == 300 and sum(visits) < 300 * 8
    want = knn.nearest(points[:300], points[300:], 5)
    assert {(r["query_id"], r["train_id"] - 300, r["distance"]) for r in found} == set(zip(*(x.tolist() for x in want)))


def test_bands_have_the_same_neighbours_by_cells_of_pivots(spark):
    """As models were stored before: rows of equal distances to a pivot, and no boxes."""
    path = scratch_path(spark, "pivots")
    rows = [(i, [float(i % 12) * 37, float(i % 7), float(i % 3)], i % 14) for i in range(900)]
    old = spark.createDataFrame([(*r, r[0] % 4, 1.0) for r in rows], "id bigint, features array<double>, label int, pivot int, radius double")
    old.write.parquet(f"{path}/rows")
    spark.createDataFrame([(5,)], "k int").write.parquet(f"{path}/settings")
    q = spark.createDataFrame([r[:2] for r in rows[::9]], "qid bigint, v array<double>")
    new = knn.fit_knn(old, "id", "features", "label", n_pivots=16)
    found = [{r["qid"]: r["prediction"] for r in m.classify(q, "qid", "v").collect()} for m in (knn.KnnModel.load(spark, path), new)]
    assert found[0] == found[1] == brute_force([(i, v, y) for i, v, y in rows], [r[:2] for r in rows[::9]], 5)


def _few_values(spark, n=1500):
    """Feature rows with few different values, so bins lose no cut, in an order that is the same everywhere."""
    rng = np.random.default_rng(12)
    numbers = {"lead_time": rng.integers(0, 30, n), "adults": rng.integers(1, 4, n), "children": rng.integers(0, 3, n)}
    places = {c: rng.integers(0, len(levels) + 1, n) for c, levels in VOCABULARY.items()}
    y = rng.normal(size=n) * 5 + numbers["lead_time"] + sum(7 * np.sin(5.0 * p + i) for i, p in enumerate(places.values()))
    ones = {indicator(c, level): (places[c] == i).astype(int) for c, levels in VOCABULARY.items() for i, level in enumerate(levels)}
    table = pd.DataFrame({"Booking_ID": np.arange(n), **numbers, **ones, "rate": y, "gone": (y > np.median(y)).astype(int)})
    return spark.createDataFrame(table), places, [*numbers, *ones]


@pytest.mark.parametrize("label", ["rate", "gone"])
@pytest.mark.parametrize("task_rows", [1 << 20, 0])
def test_indexed_boosting_equals_mllib(spark, monkeypatch, label, task_rows):
    monkeypatch.setattr(boosting, "TASK_ROWS", task_rows)
    df, places, columns = _few_values(spark)
    df = df.withColumns({f"{c}_i": indexed.index(c) for c in places}).cache()
    rows = df.orderBy("Booking_ID").toPandas()
    assert all((rows[f"{c}_i"] == p).all() for c, p in places.items())
    make, own = (presets.regressor, GBTRegressor) if label == "rate" else (presets.classifier, GBTClassifier)
    model = make("gbt_indexed", columns, label, rounds=4).fit(df)
    assert isinstance(model, indexed.IndexedModel) and len(model.boosted.trees) == 4
    stages = [*(VectorAssembler(inputCols=[f"{c}_i"], outputCol=f"{c}_v") for c in places),
              *(VectorIndexer(inputCol=f"{c}_v", outputCol=f"{c}_n", maxCategories=32) for c in places),
              VectorAssembler(inputCols=[*columns[:3], *(f"{c}_n" for c in places)], outputCol="features")]
    theirs = Pipeline(stages=[*stages, own(labelCol=label, maxIter=4, maxDepth=6, stepSize=0.1, seed=42)]).fit(df).transform(df)
    ours = model.transform(theirs.withColumnRenamed("prediction", "theirs")).select("theirs", "prediction").toPandas()
    assert np.isclose(ours["theirs"], ours["prediction"]).mean() > 0.97  # equal gains are settled differently


def test_indexed_boosting_is_stored_and_refuses_missing_values(spark):
    df, _, columns = _few_values(spark, 300)
    df = df.cache()
    store = ModelStore(spark, scratch_path(spark, "indexed"))
    model = presets.classifier("gbt_indexed", columns, "gone", rounds=2).fit(df)
    store.promote("cancel", "gbt_indexed", model, 0.5)
    found = [{r["Booking_ID"]: r["prediction"] for r in m.transform(df).collect()} for m in (model, store.load("cancel"))]
    assert found[0] == found[1] and len(found[0]) == 300
    holed = df.withColumn("adults", F.when(F.col("Booking_ID") != 7, F.col("adults")))
    with pytest.raises(Exception, match="missing value in adults"):
        model.transform(holed).collect()
    with pytest.raises(Exception, match="missing value in adults"):
        presets.classifier("gbt_indexed", columns, "gone", rounds=2).fit(holed)
    for wrong in (F.lit(2), F.lit(None).cast("int")):
        with pytest.raises(ValueError, match="no class"):
            presets.classifier("gbt_indexed", columns, "gone", rounds=2).fit(df.withColumn("gone", wrong))


def test_deep_adaboost_keeps_subtrees_out_of_the_driver(spark, monkeypatch):
    """Rows missed are told by bits where trees are finished in tasks: weights are those of whole trees."""
    monkeypatch.setattr(forests, "TASK_ROWS", 60)
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.integers(0, 9, 500), rng.integers(0, 5, 500)]).astype(float)
    label = ((x.sum(axis=1) + rng.integers(0, 3, 500)) % 4).astype(float)  # equal rows of several classes
    df = spark.createDataFrame(np.column_stack([x, label]).tolist(), "a double, b double, y double").repartition(3)
    model = adaboost.AdaBoost(["a", "b"], "y", 4, rounds=4, max_depth=presets.UNBOUNDED).fit(df)
    rows = model.subtrees.collect()
    assert len(rows) > 4 and {r["tree"] for r in rows} == set(range(len(model.tops)))
    weights = np.ones(500)
    for tree, alpha in zip(model.trees, model.alphas):
        missed = tree.predict(bins.codes_of(x, model.edges)) != label
        error = weights[missed].sum() / weights.sum()
        assert alpha == pytest.approx(np.log((1 - error) / error) + np.log(3))
        weights = weights * np.where(missed, np.exp(alpha), 1.0)
    found = model.transform(df).toPandas()
    assert np.array_equal(found["prediction"], model.predicted(found[["a", "b"]].to_numpy()))
    monkeypatch.setattr(forests, "SHARED_NODES", 1)
    path = scratch_path(spark, "deep")
    model.save(path)
    again = adaboost.AdaBoostModel.load(spark, path).transform(df).toPandas()
    key = ["a", "b", "y", "prediction"]
    assert sorted(map(tuple, again[key].to_numpy())) == sorted(map(tuple, found[key].to_numpy()))


@pytest.mark.parametrize("name, label, own", [
    ("gbt", "rate", {"maxDepth": 3, "stepSize": 0.1}), ("gbt_deep", "rate", {"maxDepth": 5, "maxBins": 255, "stepSize": 0.1}),
    ("gbt", "gone", {"maxDepth": 3, "stepSize": 0.1}), ("gbt_subsample", "rate", {"maxDepth": 6, "stepSize": 0.3, "minInfoGain": 2.0})])
def test_stepped_boosting_equals_mllib(spark, name, label, own):
    df, _, columns = _few_values(spark)
    df = df.cache()
    make, theirs = (presets.regressor, GBTRegressor) if label == "rate" else (presets.classifier, GBTClassifier)
    trees = make(name, columns, label, rounds=4)
    if name == "gbt_subsample":
        assert trees.growth.subsample == 0.8 and trees.growth.min_row_gain == pytest.approx(0.01 / 8)
        trees = replace(trees, growth=replace(trees.growth, subsample=1.0, **stepped.steps(0.3, 2.0)))
    model = trees.fit(df)
    assert isinstance(model, stepped.SteppedModel) and len(model.boosted.trees) == 4
    fitted = Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features"),
                              theirs(labelCol=label, maxIter=4, seed=42, **own)]).fit(df)
    both = model.transform(fitted.transform(df).withColumnRenamed("prediction", "theirs")).select("theirs", "prediction").toPandas()
    assert np.isclose(both["theirs"], both["prediction"]).mean() > 0.97  # equal gains are settled differently
    if name == "gbt_subsample":
        assert [len(t.feature) for grown in model.boosted.trees for t in grown] == [t.numNodes for t in fitted.stages[-1].trees]


def test_stepped_boosting_is_stored_and_refuses_missing_values(spark):
    df, _, columns = _few_values(spark, 300)
    df = df.cache()
    store = ModelStore(spark, scratch_path(spark, "stepped"))
    model = presets.regressor("gbt_subsample", columns, "rate", rounds=2).fit(df)
    store.promote("price", "gbt_subsample", model, 0.5)
    found = [{r["Booking_ID"]: r["prediction"] for r in m.transform(df).collect()} for m in (model, store.load("price"))]
    assert found[0] == found[1] and len(found[0]) == 300
    holed = df.withColumn("adults", F.when(F.col("Booking_ID") != 7, F.col("adults")))
    with pytest.raises(Exception, match="missing value in adults"):
        presets.regressor("gbt", columns, "rate", rounds=2).fit(holed)
    with pytest.raises(Exception, match="missing value in adults"):
        model.transform(holed).collect()
    for wrong in (F.lit(2), F.lit(None).cast("int")):
        with pytest.raises(ValueError, match="no class"):
            presets.classifier("gbt", columns, "gone", rounds=2).fit(df.withColumn("gone", wrong))
