"""Applying a fitted model to a feature table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innlake.learners.knn import KnnModel, feature_array
from innlake.schemas import CANCEL_PREDICTORS

Scorer = Callable[[DataFrame], DataFrame]


def predictions(model, df: DataFrame, predictors: list[str]) -> DataFrame:
    """The frame with a `prediction` column.

    Neighbour models compare each distinct feature row once: equal rows have
    equal neighbours, so copies cost no extra comparisons.
    """
    if not isinstance(model, KnnModel):
        scored = model.transform(df)
        return scored.select(*df.columns, "prediction")
    keyed = df.withColumn("_row_key", F.md5(F.to_json(feature_array(predictors))))
    queries = (keyed.select("_row_key", feature_array(predictors).alias("features"))
               .dropDuplicates(["_row_key"]))
    found = model.classify(queries, "_row_key", "features")
    return keyed.join(found, "_row_key").drop("_row_key")


def price_scorer(model) -> Scorer:
    """Fill `predicted` with the model's rate."""
    def score(df: DataFrame) -> DataFrame:
        base = df.drop("predicted")
        return model.transform(base).select(*base.columns, F.col("prediction").alias("predicted"))
    return score


def cancel_scorer(model) -> Scorer:
    """Fill `predicted` with the model's class as an integer."""
    def score(df: DataFrame) -> DataFrame:
        scored = predictions(model, df.drop("predicted"), CANCEL_PREDICTORS)
        return (scored.withColumn("predicted", F.col("prediction").cast("int"))
                .drop("prediction"))
    return score
