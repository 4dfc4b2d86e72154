"""Trees, forests and boosted trees on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame

from ..functions.columns import col, complete_rows
from ..session import ensure_checkpoint_dir, kept

VECTOR = "_vector"


class _Trees:
    def estimator(self, target: str, prediction: str):
        raise NotImplementedError

    def fit(self, df: DataFrame, features: Sequence[str], target: str,
            prediction: str = "prediction") -> PipelineModel:
        """Rows with missing values are left out of the fit and raise in prediction."""
        assembler = VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="error")
        names = list(dict.fromkeys([*features, target]))
        rows = complete_rows(df.select([col(c) for c in names]), names)
        ensure_checkpoint_dir(df.sparkSession)
        with kept(assembler.transform(rows).select(VECTOR, target)) as vectors:
            model = self.estimator(target, prediction).fit(vectors)
        return PipelineModel([assembler, model])


@dataclass(frozen=True)
class Boosted(_Trees):
    """Gradient boosting. Spark offers squared and absolute loss; "absolute" stands in
    where robustness is wanted."""

    n_trees: int = 100
    rate: float = 0.1
    depth: int = 3
    rows: float = 1.0
    features: str = "all"
    leaf: int = 1
    loss: str = "squared"
    bins: int = 32
    seed: int = 6

    def estimator(self, target, prediction):
        return GBTRegressor(
            featuresCol=VECTOR, labelCol=target, predictionCol=prediction, maxIter=self.n_trees, stepSize=self.rate,
            maxDepth=self.depth, subsamplingRate=self.rows, featureSubsetStrategy=self.features,
            minInstancesPerNode=self.leaf, lossType=self.loss, maxBins=self.bins, seed=self.seed,
            checkpointInterval=10, cacheNodeIds=True)


@dataclass(frozen=True)
class Forest(_Trees):
    n_trees: int = 100
    depth: int = 10
    rows: float = 1.0
    features: str = "all"
    leaf: int = 1
    seed: int = 6

    def estimator(self, target, prediction):
        return RandomForestRegressor(
            featuresCol=VECTOR, labelCol=target, predictionCol=prediction, numTrees=self.n_trees,
            maxDepth=self.depth, subsamplingRate=self.rows, featureSubsetStrategy=self.features,
            minInstancesPerNode=self.leaf, seed=self.seed)


@dataclass(frozen=True)
class Tree(_Trees):
    depth: int = 10
    leaf: int = 1
    seed: int = 6

    def estimator(self, target, prediction):
        return DecisionTreeRegressor(
            featuresCol=VECTOR, labelCol=target, predictionCol=prediction, maxDepth=self.depth,
            minInstancesPerNode=self.leaf, seed=self.seed)


def fit_gbt(df, features, target, prediction="prediction", **params) -> PipelineModel:
    return Boosted(**params).fit(df, features, target, prediction)


def fit_forest(df, features, target, prediction="prediction", **params) -> PipelineModel:
    return Forest(**params).fit(df, features, target, prediction)


def fit_tree(df, features, target, prediction="prediction", **params) -> PipelineModel:
    return Tree(**params).fit(df, features, target, prediction)
