"""Versioned model folders with a pointer to the current champion."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from innlake.learners.adaboost import AdaBoostModel
from innlake.learners.bayesian_ridge import LinearFormula
from innlake.learners.boosting import BoostedModel
from innlake.learners.forests import ForestModel
from innlake.learners.indexed import IndexedModel
from innlake.learners.knn import KnnModel
from innlake.learners.ordered import OrderedModel
from innlake.learners.stepped import SteppedModel

OWN_KINDS = {"knn": KnnModel, "adaboost": AdaBoostModel, "formula": LinearFormula, "boosted": BoostedModel,
             "forest": ForestModel, "ordered": OrderedModel, "indexed": IndexedModel, "stepped": SteppedModel}

POINTER = "name string, version int, candidate string, kind string, path string, metric double"


class NoChampionError(LookupError):
    """No model has been promoted under this name."""


@dataclass(frozen=True)
class Champion:
    name: str
    version: int
    candidate: str
    kind: str
    path: str
    metric: float


class ModelStore:
    """Models below `<root>/<name>/v<version>`; every promotion adds a pointer
    row, the highest version is current."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _pointers(self, name: str) -> str:
        return f"{self.root}/{name}/pointers"

    def current(self, name: str) -> Champion:
        try:
            rows = self.spark.read.schema(POINTER).parquet(self._pointers(name))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise NoChampionError(name) from error
            raise
        latest = rows.orderBy(rows["version"].desc()).first()
        if latest is None:
            raise NoChampionError(name)
        return Champion(**latest.asDict())

    def promote(self, name: str, candidate: str, model, metric: float) -> Champion:
        """Save the model, then point to it; readers never see half a model."""
        try:
            version = self.current(name).version + 1
        except NoChampionError:
            version = 1
        if metric is None or math.isnan(metric):
            raise ValueError(f"{candidate} has no metric")
        path = f"{self.root}/{name}/v{version}"
        kind = next((k for k, own in OWN_KINDS.items() if isinstance(model, own)), "pipeline")
        if kind in OWN_KINDS:
            model.save(path)
        else:
            model.write().overwrite().save(path)
        chosen = Champion(name, version, candidate, kind, path, metric)
        row = self.spark.createDataFrame([tuple(vars(chosen).values())], POINTER)
        row.coalesce(1).write.mode("append").parquet(self._pointers(name))
        return chosen

    def load(self, name: str) -> (PipelineModel | KnnModel | AdaBoostModel | LinearFormula | BoostedModel | ForestModel | OrderedModel
                                  | IndexedModel | SteppedModel):
        chosen = self.current(name)
        if chosen.kind in OWN_KINDS:
            return OWN_KINDS[chosen.kind].load(self.spark, chosen.path)
        return PipelineModel.load(chosen.path)
