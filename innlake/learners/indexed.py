"""Boosting on categories as indexes, cut by sets of levels, in steps along the gradient (see stepped.py)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.learners.boosting import BoostedModel, BoostedTrees, Growth
from innlake.learners.stepped import check_labels, given
from innlake.schemas import ONE_HOT, VOCABULARY, indicator


def _named(column: str) -> str:
    return f"{column}_index"


def index(column: str) -> Column:
    """The place in the vocabulary of the level whose indicator is 1; 'other' comes last."""
    out = F.lit(len(VOCABULARY[column]))
    for i, name in reversed(list(enumerate(VOCABULARY[column]))):
        out = F.when(F.col(f"`{indicator(column, name)}`") == 1, F.lit(i)).otherwise(out)
    return out


def with_indexes(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with each vocabulary's indicators folded into one column, and the columns' numbers checked."""
    return df.withColumns({c: given(c) for c in columns if c not in ONE_HOT} | {_named(c): index(c) for c in VOCABULARY})


@dataclass
class IndexedModel:
    """Boosted trees over the numbers and indexes."""

    columns: list[str]
    boosted: BoostedModel

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        numeric = [c for c in self.columns if c not in ONE_HOT]
        scored = self.boosted.transform(with_indexes(df, numeric), output)
        return scored.select(*[F.col(f"`{c}`") for c in df.columns], output)

    def save(self, path: str) -> None:
        self.boosted.save(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IndexedModel:
        boosted = BoostedModel.load(spark, path)
        return cls([c for c in boosted.columns if c not in map(_named, VOCABULARY)], boosted)


@dataclass(frozen=True)
class IndexedTrees:
    """An estimator over feature tables; indicators among the columns become indexes. Missing numbers and labels are errors."""

    columns: list[str]
    label: str
    growth: Growth

    def fit(self, df: DataFrame) -> IndexedModel:
        names = [_named(c) for c in VOCABULARY]
        numeric = [c for c in self.columns if c not in ONE_HOT]
        check_labels(df, self.label, self.growth)
        rows = with_indexes(df, numeric).select(*dict.fromkeys([*numeric, *names, self.label]))
        levels = {_named(c): len(VOCABULARY[c]) + 1 for c in VOCABULARY}
        return IndexedModel(numeric, BoostedTrees([*numeric, *names], self.label, self.growth, levels).fit(rows))
