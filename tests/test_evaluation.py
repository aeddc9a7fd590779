import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from innlake.functions import sqltext
from innlake.operators import evaluation, scaling, splitting


def test_split_is_stable_under_repartitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    train, test = splitting.train_test_split(df, "k")
    again, _ = splitting.train_test_split(df.repartition(13).orderBy(F.desc("k")), "k")
    ids = {r.k for r in train.collect()}
    assert ids == {r.k for r in again.collect()}
    assert ids.isdisjoint({r.k for r in test.collect()})
    assert train.count() + test.count() == 2000 and 0.75 < len(ids) / 2000 < 0.85


def test_scaler_uses_the_population_deviation(spark):
    values = [1.0, 2.0, 4.0, 9.0]
    df = spark.createDataFrame([(v, 5.0) for v in values], "x double, c double")
    scaled = scaling.apply_scaler(df, scaling.fit_scaler(df, ["x", "c"]))
    expected = (np.array(values) - np.mean(values)) / np.std(values)
    assert sorted(r.x for r in scaled.collect()) == pytest.approx(sorted(expected))
    assert {r.c for r in scaled.collect()} == {0.0}


def test_pca_centres_and_orders_components(spark):
    rng = np.random.default_rng(0)
    points = rng.normal(size=(200, 3)) @ np.diag([3.0, 1.0, 0.2]) + [10, -5, 3]
    df = spark.createDataFrame(points.tolist(), "a double, b double, c double")
    model = scaling.fit_pca(df, ["a", "b", "c"], k=3)
    scores = np.array([r[0] for r in model.transform(df).select(vector_to_array("pca_scores")).collect()])
    _, singular, _ = np.linalg.svd(points - points.mean(axis=0))
    assert scores.mean(axis=0) == pytest.approx([0, 0, 0], abs=1e-9)
    assert np.sqrt((scores ** 2).sum(axis=0)) == pytest.approx(singular)
    assert model.stages[-1].explainedVariance.toArray() == pytest.approx(singular ** 2 / (singular ** 2).sum())


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    row = evaluation.regression_metrics(df, "y", "p").first()
    mse = (0.25 + 0 + 1) / 3
    assert (row.n_rows, row.mse, row.rmse) == (3, pytest.approx(mse), pytest.approx(mse ** 0.5))
    assert row.r2 == pytest.approx(1 - mse / np.var([1, 2, 4]))
    classes = spark.createDataFrame([(1, 1.0), (0, 1.0), (3, 1.0), (2, 2.0)], "y int, p double")
    row = evaluation.classification_metrics(classes, "y", "p").first()
    assert (row.accuracy, row.label_rmse) == (0.5, pytest.approx((5 / 4) ** 0.5))


def test_constant_target_has_no_r2(spark):
    df = spark.createDataFrame([(1.0, 1.5), (1.0, 2.0)], "y double, p double")
    assert evaluation.regression_metrics(df, "y", "p").first().r2 is None


def test_champion_keeps_the_earlier_of_equals(spark):
    scores = spark.createDataFrame(
        [(0, "a", 0.5), (2, "c", 0.9), (1, "b", 0.9), (3, "d", None)], "ordinal int, candidate string, r2 double")
    assert evaluation.champion(scores, "r2").first().candidate == "b"


def test_a_model_without_metric_never_wins(spark):
    scores = spark.createDataFrame([(0, "a", 0.9), (1, "b", float("nan")), (2, "c", None)], "ordinal int, candidate string, r2 double")
    assert evaluation.champion(scores, "r2").first().candidate == "a"


def test_numbers_without_literal():
    assert sqltext.number(0.1) == "0.1D"
    assert [sqltext.number(float(x)) for x in ("nan", "inf", "-inf")] == ["double('nan')", "double('inf')", "double('-inf')"]
