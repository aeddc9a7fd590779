"""Bayesian ridge regression from one distributed Gram matrix.

Only the (features + 1)-square matrix of sums reaches the driver; its size is
fixed by the feature list.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The usual defaults of the method.
PRIOR = 1e-6
MAX_ROUNDS = 300
TOLERANCE = 1e-3
_SAVED = "features array<string>, coefficients array<double>, intercept double"


@dataclass(frozen=True)
class LinearFormula:
    """A fitted linear model as a plain column expression."""

    features: list[str]
    coefficients: list[float]
    intercept: float

    def save(self, path: str) -> None:
        row = SparkSession.active().createDataFrame([(self.features, self.coefficients, self.intercept)], _SAVED)
        row.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearFormula:
        return cls(*spark.read.schema(_SAVED).parquet(path).first())

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        terms = [F.col(f"`{c}`") * F.lit(float(w)) for c, w in zip(self.features, self.coefficients)]
        return df.withColumn(output, sum(terms, F.lit(float(self.intercept))))


def centred_gram(df: DataFrame, columns: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, means and the Gram matrix of the centred columns.

    Each batch of rows becomes one matrix product; the cells are summed by
    Spark with partial sums in the same stage.
    """
    means_row = df.agg(F.count("*").alias("n"), *[
        F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(columns)
    ]).first()
    n, means = means_row["n"], np.array(means_row[1:], dtype=float)
    width = len(columns)

    def products(batches):
        total = np.zeros((width, width))
        for batch in batches:
            centred = batch.to_numpy(dtype=np.float64) - means
            total += centred.T @ centred
        yield pd.DataFrame({"cells": [total.ravel().tolist()]})

    numeric = df.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(columns)])
    cells = (numeric.mapInPandas(products, "cells array<double>")
             .select(F.posexplode("cells").alias("position", "cell"))
             .groupBy("position").agg(F.sum("cell").alias("total")).collect())
    gram = np.zeros(width * width)
    for row in cells:
        gram[row["position"]] = row["total"]
    return n, means, gram.reshape(width, width)


def fit_bayesian_ridge(df: DataFrame, features: list[str], label: str) -> LinearFormula:
    """Evidence maximisation over noise and weight precision."""
    n, means, gram = centred_gram(df, [*features, label])
    xx, xy, yy = gram[:-1, :-1], gram[:-1, -1], gram[-1, -1]
    eigenvalues, vectors = np.linalg.eigh(xx)
    eigenvalues = np.clip(eigenvalues, 0, None)
    projected = vectors.T @ xy
    noise, weight = 1.0 / max(yy / n, np.finfo(float).eps), 1.0
    coefficients = np.zeros(len(features))
    for _ in range(MAX_ROUNDS):
        previous = coefficients
        coefficients = vectors @ (projected / (eigenvalues + weight / noise))
        residual = yy - 2 * coefficients @ xy + coefficients @ xx @ coefficients
        effective = np.sum(noise * eigenvalues / (weight + noise * eigenvalues))
        weight = (effective + 2 * PRIOR) / (coefficients @ coefficients + 2 * PRIOR)
        noise = (n - effective + 2 * PRIOR) / (max(residual, 0.0) + 2 * PRIOR)
        if np.abs(previous - coefficients).sum() < TOLERANCE:
            break
    intercept = means[-1] - means[:-1] @ coefficients
    return LinearFormula(list(features), coefficients.tolist(), float(intercept))
