"""Boosting by steps along the gradient, as MLlib's boosted trees go: the first tree is fitted to the labels (1 and -1
for classes) and counts in full, the others to what the trees before leave, at the rate of the growth.
Missing numbers and labels are errors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.learners.boosting import DEVIANCE, BoostedModel, BoostedTrees, Growth


def missing(column: str) -> Column:
    x = F.col(f"`{column}`").cast("double")
    return x.isNull() | F.isnan(x)


def given(column: str) -> Column:
    """The number; a missing one is an error."""
    return F.when(missing(column), F.raise_error(F.lit(f"missing value in {column}"))).otherwise(F.col(f"`{column}`"))


def check_labels(df: DataFrame, label: str, growth: Growth) -> None:
    wrong = missing(label)
    if growth.loss == DEVIANCE:
        wrong |= ~F.col(f"`{label}`").isin(0, 1)
    if not df.filter(wrong).isEmpty():
        raise ValueError(f"labels in {label} that are missing or no class")


def steps(rate: float, least_gain: float = 0.0) -> dict:
    """What a growth for squared errors takes for MLlib's step and least gain.

    The slopes of its loss are twice the residuals, but for the first tree's, which are the labels; its gain is a fall of variance.
    """
    return {"rate": 2 * rate, "first_rate": 1.0, "min_row_gain": least_gain / 8, "first_row_gain": least_gain / 2}


@dataclass
class SteppedModel:
    """Boosted trees over numbers that are all there."""

    columns: list[str]
    boosted: BoostedModel

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        scored = self.boosted.transform(df.withColumns({c: given(c) for c in self.columns}), output)
        return scored.select(*[F.col(f"`{c}`") for c in df.columns], output)

    def save(self, path: str) -> None:
        self.boosted.save(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SteppedModel:
        boosted = BoostedModel.load(spark, path)
        return cls(boosted.columns, boosted)


@dataclass(frozen=True)
class SteppedTrees:
    """An estimator: fit(df) gives a SteppedModel that adds `prediction`."""

    columns: list[str]
    label: str
    growth: Growth

    def fit(self, df: DataFrame) -> SteppedModel:
        check_labels(df, self.label, self.growth)
        rows = df.withColumns({c: given(c) for c in self.columns})
        return SteppedModel(self.columns, BoostedTrees(self.columns, self.label, self.growth).fit(rows))
