"""Linear models from one moment matrix, or in passes beyond its width: least squares, ridge, lasso, elastic net.

Every learner in this package has ``fit(df, features, target, prediction)`` and returns
an ML transformer that adds the prediction column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame

from ..functions.columns import col, dot
from ..stage import Fitted
from . import passes, solve
from .gram import WIDEST, collect_gram


class LinearFit(Fitted):
    """Intercept and slopes; predicts with one arithmetic expression."""

    def __init__(self, features=(), intercept=0.0, slopes=(), prediction="prediction"):
        super().__init__(**({"features": list(features), "intercept": float(intercept),
                             "slopes": [float(b) for b in slopes], "prediction": prediction} if features else {}))

    @property
    def intercept(self) -> float:
        return self["intercept"]

    @property
    def slopes(self) -> dict[str, float]:
        return dict(zip(self["features"], self["slopes"]))

    def expression(self) -> Column:
        return dot(self["features"], self["slopes"], self["intercept"])

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self["prediction"], self.expression())


@dataclass(frozen=True)
class Linear:
    """Least squares."""

    def solve(self, g: np.ndarray):
        return solve.ridge(g)

    def by_passes(self, p: passes.Problem):
        return passes.ridge(p)

    def fit_entries(self, df: DataFrame, entries: str, width: int, target: str,
                    prediction: str = "prediction") -> passes.SparseFit:
        """Fit on a column of entries, as ``SparseOneHot`` makes it, of any width."""
        with passes.problem(df, entries, col(target), width) as p:
            return passes.SparseFit(entries, *self.by_passes(p), prediction)

    def fit(self, df: DataFrame, features: Sequence[str], target: str, prediction: str = "prediction") -> LinearFit:
        """Up to WIDEST columns are solved from their moment matrix, more of them in passes over the rows."""
        if len(features) + 1 > WIDEST:
            with passes.problem(df, [col(c) for c in features], col(target), len(features)) as p:
                return LinearFit(features, *self.by_passes(p), prediction)
        found = collect_gram(df, [col(c) for c in [*features, target]])
        if not found:
            raise ValueError("no complete rows to fit on")
        return LinearFit(features, *self.solve(found[()]), prediction)


@dataclass(frozen=True)
class Ridge(Linear):
    """``alpha`` times the squared slopes, added to the sum of squared errors."""

    alpha: float = 1.0

    def solve(self, g: np.ndarray):
        return solve.ridge(g, self.alpha)

    def by_passes(self, p: passes.Problem):
        return passes.ridge(p, self.alpha)


@dataclass(frozen=True)
class ElasticNet(Linear):
    """Half the mean squared error + alpha * (l1_ratio |b| + (1 - l1_ratio) b^2 / 2)."""

    alpha: float = 1.0
    l1_ratio: float = 0.5

    def solve(self, g: np.ndarray):
        return solve.elastic_net(g, self.alpha, self.l1_ratio)

    def by_passes(self, p: passes.Problem):
        return passes.elastic_net(p, self.alpha, self.l1_ratio)


def Lasso(alpha: float = 1.0) -> ElasticNet:
    return ElasticNet(alpha, 1.0)


def fit_linear(df, features, target, prediction="prediction") -> LinearFit:
    return Linear().fit(df, features, target, prediction)


def fit_ridge(df, features, target, alpha, prediction="prediction") -> LinearFit:
    return Ridge(alpha).fit(df, features, target, prediction)


def fit_elastic(df, features, target, alpha, l1_ratio, prediction="prediction") -> LinearFit:
    return ElasticNet(alpha, l1_ratio).fit(df, features, target, prediction)


def fit_lasso(df, features, target, alpha, prediction="prediction") -> LinearFit:
    return Lasso(alpha).fit(df, features, target, prediction)
