"""Standard scaling with the population deviation, and principal components."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame

from innlake.functions.sqltext import name, number


def fit_scaler(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, one aggregate row."""
    row = df.selectExpr(*[
        stat for i, c in enumerate(columns)
        for stat in (f"avg({name(c)}) as mean_{i}", f"stddev_pop({name(c)}) as std_{i}")
    ]).first()
    return {c: (row[f"mean_{i}"], row[f"std_{i}"]) for i, c in enumerate(columns)}


def apply_scaler(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / std; a constant column is centred only."""
    def cell(column: str) -> str:
        mean, std = fitted.get(column, (None, None))
        if mean is None:
            return name(column)
        return f"({name(column)} - {number(mean)}) / {number(std or 1.0)} as {name(column)}"

    return df.selectExpr(*map(cell, df.columns))


def fit_pca(df: DataFrame, columns: list[str], k: int, unit_variance: bool = False) -> PipelineModel:
    """PCA on centred (optionally unit-variance) columns.

    MLlib's PCA projects without centring, so the scaler stage does it.
    """
    return Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="pca_input"),
        StandardScaler(inputCol="pca_input", outputCol="pca_centred", withMean=True, withStd=unit_variance),
        PCA(k=k, inputCol="pca_centred", outputCol="pca_scores"),
    ]).fit(df)
