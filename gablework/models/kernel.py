"""Gaussian-kernel regression by random Fourier features (Rahimi and Recht 2007)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col, conjunction
from ..operators.profile import fit_moments
from ..stage import Fitted
from . import solve
from .gram import collect_gram


def waves(p: int, n_features: int, gamma: float, seed: int):
    """Frequencies and phases whose cosines approximate exp(-gamma |a - b|^2)."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, math.sqrt(2 * gamma), (p, n_features)), rng.uniform(0, 2 * math.pi, n_features)


@dataclass(frozen=True)
class RandomFourier:
    """Ridge on ``n_features`` cosines. ``gamma`` is a number, "auto" (1 / columns) or
    "scale" (1 / (columns * variance of all entries)). Columns should be scaled alike."""

    gamma: float | str = "scale"
    n_features: int = 100
    alpha: float = 1.0
    seed: int = 6

    def fit(self, df: DataFrame, features: Sequence[str], target: str, prediction: str = "prediction") -> KernelFit:
        features, p = list(features), len(features)
        if self.gamma == "auto":
            gamma = 1 / p
        elif self.gamma == "scale":
            moments = fit_moments(df, features).values()
            mean = sum(m for m, _ in moments) / p
            spread = sum(s * s + m * m for m, s in moments) / p - mean * mean
            gamma = 1 / (p * spread) if spread > 0 else 1.0
        else:
            gamma = float(self.gamma)
        frequencies, phases = waves(p, self.n_features, gamma, self.seed)
        height = math.sqrt(2 / self.n_features)

        def expand(block):
            return np.column_stack([height * np.cos(block[:, :-1] @ frequencies + phases), block[:, -1]])

        g = collect_gram(df, [col(c) for c in [*features, target]], expand=(self.n_features + 1, expand))[()]
        intercept, slopes = solve.ridge(g, self.alpha)
        return KernelFit(features, gamma, self.n_features, self.seed, float(intercept),
                         [float(b) for b in slopes], prediction)


class KernelFit(Fitted):
    """Keeps the seed and the slopes; the waves are drawn again from the seed."""

    def __init__(self, features=(), gamma=1.0, n_features=0, seed=0, intercept=0.0, slopes=(), prediction="prediction"):
        super().__init__(**({"features": list(features), "gamma": gamma, "n_features": n_features, "seed": seed,
                             "intercept": intercept, "slopes": list(slopes), "prediction": prediction}
                            if features else {}))

    def _transform(self, df: DataFrame) -> DataFrame:
        features = self["features"]
        frequencies, phases = waves(len(features), self["n_features"], self["gamma"], self["seed"])
        slopes = math.sqrt(2 / self["n_features"]) * np.asarray(self["slopes"])
        intercept = self["intercept"]

        def predict(x: pd.Series) -> pd.Series:
            block = np.stack(x.to_numpy())
            return pd.Series(np.cos(block @ frequencies + phases) @ slopes + intercept)

        udf = F.pandas_udf(predict, "double")
        complete = conjunction([col(c).isNotNull() for c in features])
        vector = F.array(*[F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in features])
        return df.withColumn(self["prediction"], F.when(complete, udf(vector)))


def fit_rbf(df, features, target, prediction="prediction", **params) -> KernelFit:
    return RandomFourier(**params).fit(df, features, target, prediction)
