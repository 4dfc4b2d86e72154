"""Huber regression: squared error near the line, absolute error far from it."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame

from ..functions.columns import col, complete_rows
from ..operators.transformers import assemble
from ..session import kept
from .linear import LinearFit


@dataclass(frozen=True)
class Huber:
    """``alpha`` is the penalty on squared slopes beside the summed loss; Spark divides
    the loss by twice the row count, so the penalty is divided by the row count."""

    epsilon: float = 1.35
    alpha: float = 0.0001
    max_iter: int = 100

    def fit(self, df: DataFrame, features: Sequence[str], target: str, prediction: str = "prediction") -> LinearFit:
        names = [*features, target]
        rows = complete_rows(df.select(*[col(c).cast("double").alias(c) for c in names]), names)
        with kept(assemble(rows, features, "_x").select("_x", col(target).alias("_y"))) as vectors:
            n = vectors.count()
            fitted = LinearRegression(
                featuresCol="_x", labelCol="_y", loss="huber", epsilon=self.epsilon, regParam=self.alpha / n,
                elasticNetParam=0.0, standardization=False, maxIter=self.max_iter, tol=1e-6).fit(vectors)
            if fitted.hasSummary and fitted.summary.totalIterations >= self.max_iter:
                warnings.warn(f"Huber regression did not converge in {self.max_iter} iterations", stacklevel=2)
        return LinearFit(features, fitted.intercept, fitted.coefficients.toArray().tolist(), prediction)


def fit_huber(df, features, target, epsilon=1.35, alpha=0.0001, prediction="prediction") -> LinearFit:
    return Huber(epsilon, alpha).fit(df, features, target, prediction)
