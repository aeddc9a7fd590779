"""Boosting on categories as target means of earlier rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.learners.boosting import BoostedModel, BoostedTrees, Growth
from innlake.operators.target_stats import TargetMeans, ordered_means, target_name
from innlake.schemas import ONE_HOT, VOCABULARY, indicator
from innlake.session import scratch_path


def level(column: str) -> Column:
    """The level whose indicator is 1, or 'other'."""
    out = F.lit("other")
    for name in VOCABULARY[column]:
        out = F.when(F.col(f"`{indicator(column, name)}`") == 1, F.lit(name)).otherwise(out)
    return out


def _named(column: str) -> str:
    return f"{column}_level"


def with_levels(df: DataFrame) -> DataFrame:
    """df with each vocabulary's indicators folded into one column."""
    return df.withColumns({_named(c): level(c) for c in VOCABULARY})


@dataclass
class OrderedModel:
    """Target means of the training rows and the boosted trees over them."""

    means: TargetMeans
    boosted: BoostedModel

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        encoded = self.means.transform(with_levels(df))
        return self.boosted.transform(encoded, output).select(*[F.col(f"`{c}`") for c in df.columns], output)

    def save(self, path: str) -> None:
        self.means.save(path)
        self.boosted.save(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> OrderedModel:
        return cls(TargetMeans.load(spark, path), BoostedModel.load(spark, path))


@dataclass(frozen=True)
class OrderedTrees:
    """An estimator over feature tables with a key; indicators among the columns become target means."""

    columns: list[str]
    label: str
    growth: Growth
    key: str = "Booking_ID"

    def fit(self, df: DataFrame) -> OrderedModel:
        names = [_named(c) for c in VOCABULARY]
        numeric = [c for c in self.columns if c not in ONE_HOT]
        rows = with_levels(df).select(*dict.fromkeys([self.key, *numeric, *names, self.label]))
        path = scratch_path(df.sparkSession, "target-means")
        means = TargetMeans.fit(rows, names, self.label)
        means.save(path)
        means = TargetMeans.load(df.sparkSession, path)
        encoded = ordered_means(rows, self.key, names, self.label)
        encoded.write.parquet(f"{path}/rows")
        encoded = df.sparkSession.read.parquet(f"{path}/rows")
        trees = BoostedTrees([*numeric, *map(target_name, names)], self.label, self.growth)
        return OrderedModel(means, trees.fit(encoded))
