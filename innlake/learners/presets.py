"""Named model presets over the feature tables.

Linear and logistic models are MLlib's pipelines. Trees without a depth bound, extra trees, boosted
trees with MLlib's parameters and
the boosting variants (leaf-wise, second-order, on ordered target means, on indexed
categories, several classes at once) are this package's own estimators: fit(df) gives a model whose
transform(df) adds `prediction`.
"""

from __future__ import annotations

import math

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame

from innlake.learners.boosting import DEVIANCE, LOGISTIC, SOFTMAX, SQUARED, BoostedTrees, Growth
from innlake.learners.forests import Forest, ForestSpec
from innlake.learners.indexed import IndexedTrees
from innlake.learners.ordered import OrderedTrees
from innlake.learners.stepped import SteppedTrees, steps
from innlake.schemas import ONE_HOT

SEED = 42
FEATURES = "features"


def assemble(columns: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=FEATURES)


def vectors(df: DataFrame, columns: list[str], *kept: str) -> DataFrame:
    """The kept columns and the feature vector."""
    return assemble(columns).transform(df).select(*kept, FEATURES)


def _plain(columns: list[str], estimator: Estimator) -> Pipeline:
    return Pipeline(stages=[assemble(columns), estimator])


#: Depth of trees that are grown until their leaves are pure.
UNBOUNDED = 1 << 30


def _loss(classes: int) -> dict:
    return {"loss": SQUARED} if not classes else {"loss": LOGISTIC} if classes == 2 else {"loss": SOFTMAX, "n_classes": classes}


#: A first tree that is fitted to 1 and -1 counts in full.
_CLASS_STEPS = {"loss": DEVIANCE, "first_rate": 0.5}


def _boosted(name: str, columns: list[str], label: str, rounds: int, classes: int) -> BoostedTrees | IndexedTrees | OrderedTrees:
    """Published defaults of the variants."""
    base = {"rounds": rounds, "seed": SEED, **_loss(classes)}
    if name == "leafwise":
        return BoostedTrees(columns, label, Growth(**base, max_leaves=31, min_rows=20, min_hessian=1e-3))
    if name == "second_order":
        return BoostedTrees(columns, label, Growth(**base, rate=0.3, max_depth=6, l2=1.0, min_hessian=1.0))
    if name == "ordered":
        return OrderedTrees(columns, label, Growth(**base, max_depth=6, l2=3.0))
    if name == "gbt_indexed":
        own = _CLASS_STEPS if classes else steps(0.1)
        return IndexedTrees(columns, label, Growth(**{**base, **own}, max_depth=6, bins=32))
    depth = {"gbt_multiclass": 3, "gbt_deep": 5}[name]
    return BoostedTrees(columns, label, Growth(**base, max_depth=depth, min_hessian=1e-3))


def regressor(
    name: str, columns: list[str], label: str, rounds: int = 100, trees: int = 100,
    forest_depth: int = UNBOUNDED,
) -> Estimator | BoostedTrees | IndexedTrees | OrderedTrees | SteppedTrees | Forest:
    """Price models by name."""
    if name in ("leafwise", "second_order", "ordered", "gbt_indexed"):
        return _boosted(name, columns, label, rounds, 0)
    if name == "random_forest":
        return Forest(columns, label, ForestSpec(trees=trees, max_depth=forest_depth, seed=SEED))
    common = {"featuresCol": FEATURES, "labelCol": label}
    boosted = {"rounds": rounds, "seed": SEED}
    if name == "linear":
        return _plain(columns, LinearRegression(**common, solver="normal"))
    if name == "elastic_net":
        return _plain(columns, LinearRegression(
            **common, regParam=1.0, elasticNetParam=0.5, standardization=False))
    if name == "gbt":
        return SteppedTrees(columns, label, Growth(**boosted, **steps(0.1), max_depth=3, bins=32))
    if name == "gbt_deep":
        return SteppedTrees(columns, label, Growth(**boosted, **steps(0.1), max_depth=5, bins=255))
    if name == "gbt_subsample":
        return SteppedTrees(columns, label, Growth(**boosted, **steps(0.3, 0.01), max_depth=6, subsample=0.8, bins=32))
    raise KeyError(name)


def classifier(
    name: str, columns: list[str], label: str, rounds: int = 100, trees: int = 100,
    forest_depth: int = UNBOUNDED, scaled: list[str] | None = None, classes: int = 2,
) -> Estimator | BoostedTrees | IndexedTrees | OrderedTrees | SteppedTrees | Forest:
    """Cancellation and price-band models by name; labels are 0 to classes - 1.

    scaled: numeric columns to standardise inside the pipeline, so the scaler
    is fitted on the training rows only.
    """
    if name in ("leafwise", "second_order", "ordered", "gbt_multiclass", "gbt_deep", "gbt_indexed"):
        return _boosted(name, columns, label, rounds, classes)
    if name in ("decision_tree", "random_forest", "extra_trees"):
        single, sqrt = name == "decision_tree", max(1, math.isqrt(len(columns)))
        return Forest(columns, label, ForestSpec(
            classes=classes, trees=1 if single else trees, features=0 if single else sqrt, bootstrap=name == "random_forest",
            random_cuts=name == "extra_trees", max_depth=forest_depth, seed=SEED))
    common = {"featuresCol": FEATURES, "labelCol": label}
    if name == "logistic":
        # MLlib standardises internally and returns unscaled coefficients.
        return _plain(columns, LogisticRegression(**common, maxIter=100, family="auto"))
    if name == "logistic_scaled":
        numeric = scaled or [c for c in columns if c not in ONE_HOT]
        rest = [c for c in columns if c not in numeric]
        return Pipeline(stages=[
            VectorAssembler(inputCols=numeric, outputCol="numeric_raw"),
            StandardScaler(inputCol="numeric_raw", outputCol="numeric_scaled", withMean=True),
            VectorAssembler(inputCols=["numeric_scaled", *rest], outputCol=FEATURES),
            LogisticRegression(**common, maxIter=100, standardization=False),
        ])
    if name == "gbt":
        return SteppedTrees(columns, label, Growth(rounds=rounds, seed=SEED, **_CLASS_STEPS, max_depth=3, bins=32))
    raise KeyError(name)

