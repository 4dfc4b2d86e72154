"""Averaging and stacking of regressors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager, nullcontext
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import col, dot, total
from ..models.gram import collect_gram
from ..models.linear import Linear, LinearFit
from ..models.solve import r_squared
from ..session import kept, side_by_side, small_frame
from ..validation.folds import with_folds
from ..validation.search import fold_values
from .features import FeaturePlan
from .regressor import SCALED, TabularRegressor, fit_together, predict_all_beside
from .target import TargetTransform


def row_mean(columns: Sequence[str]) -> Column:
    return total([col(c) for c in columns]) / F.lit(float(len(columns)))


def average_models(df: DataFrame, predictions: Sequence[str], name: str = "prediction") -> DataFrame:
    """The plain mean of several prediction columns."""
    return df.withColumn(name, row_mean(predictions))


def fold_expression(fits: dict, features: Sequence[str], fold: str) -> Column:
    """The prediction of each row's own fold model: one dot product whose coefficients
    are picked by fold number, so that no row is scored by more than one model."""
    size = max(fits) + 1
    place = (col(fold) + 1).cast("int")

    def picked(value):
        return F.element_at(F.array(*[F.lit(float(value(f)) if f in fits else None).cast("double")
                                      for f in range(size)]), place)

    terms = [picked(lambda f, j=j: fits[f][1][j]) * col(c).cast("double") for j, c in enumerate(features)]
    return reduce(lambda a, b: a + b, terms, picked(lambda f: fits[f][0]))


def oof_predictions(df: DataFrame, learner: Linear, features: Sequence[str], target: str, fold: str = "fold",
                    name: str = "oof") -> tuple[DataFrame, list[LinearFit]]:
    """Out-of-fold predictions of a linear learner from one pass for the fit and one
    projection, and the fold models."""
    from ..validation.search import fold_matrices, training_fits

    fits = training_fits(fold_matrices(df, features, target, fold), learner)
    models = [LinearFit(features, *fits[f], prediction=f"{name}_{f}") for f in sorted(fits)]
    return df.withColumn(name, fold_expression(fits, features, fold)), models


def fold_mean(df: DataFrame, models: Sequence[LinearFit], name: str = "prediction") -> DataFrame:
    """New rows get the mean over the fold models, which for linear models is one model
    with the mean coefficients."""
    n = len(models)
    slopes = np.mean([m["slopes"] for m in models], axis=0)
    return df.withColumn(name, dot(models[0]["features"], slopes.tolist(), sum(m.intercept for m in models) / n))


class Stack:
    """Base regressors, their out-of-fold predictions, and a meta learner on a feature
    subset beside these predictions.

    Every base model sees raw rows and learns its own cleaning and plan inside each
    training part. The out-of-fold table is computed once and read by every meta fit
    that follows.
    """

    def __init__(self, bases: Sequence[TabularRegressor], meta, plan: FeaturePlan, target: str, key: str,
                 cleaning=None, k: int = 10, seed: int | None = 6, chain: Sequence[str] = ("log", "robust")):
        self.bases, self.meta, self.plan, self.target, self.key = list(bases), meta, plan, target, key
        self.cleaning, self.k, self.seed, self.chain = cleaning, k, seed, tuple(chain)
        self.names = [f"base_{i}" for i in range(len(self.bases))]
        self.model = None

    def _predictions(self) -> list[str]:
        return [base.prediction for base in self.bases]

    @contextmanager
    def out_of_fold(self, df: DataFrame) -> Iterator[DataFrame]:
        """The rows with one out-of-fold column per base model, kept while in use. The
        fold models stay with the stack."""
        with kept(with_folds(df, self.k, self.key, self.seed, "_fold")) as rows:
            folds = fold_values(rows, "_fold")
            fitted = side_by_side([
                lambda f=f: fit_together(self.bases, rows.where(F.col("_fold") != f).drop("_fold")) for f in folds])
            self.fold_models = dict(zip(folds, fitted))
            parts = []
            for f in folds:
                held = rows.where(F.col("_fold") == f)
                parts.append(predict_all_beside(self.fold_models[f], held, self.names, self._predictions()))
            with kept(reduce(DataFrame.unionByName, parts)) as table:
                yield table

    def _meta_table(self, with_bases: DataFrame):
        cleaner = self.cleaning.fit(with_bases) if self.cleaning else None
        cleaned = cleaner.transform(with_bases) if cleaner else with_bases
        plan = self.plan.keeping([self.key, self.target, *self.names]).fit(cleaned)
        chain = TargetTransform(self.target, self.chain, SCALED).fit(with_bases)
        stages = [s for s in (cleaner, plan) if s]
        return stages, chain, chain.transform(plan.transform(cleaned)), [*plan.feature_names, *self.names]

    def fit(self, df: DataFrame, oof: DataFrame | None = None) -> Stack:
        """``oof`` is a table from ``out_of_fold``, for several fits in a row."""
        with nullcontext(oof) if oof is not None else self.out_of_fold(df) as table:
            self.stages, self.target_model, wide, self.features = self._meta_table(table)
            self.model = self.meta.fit(wide, self.features, SCALED, "prediction")
        return self

    def sweep(self, df: DataFrame, learners: Sequence[Linear], oof: DataFrame | None = None) -> list[float]:
        """R2 on the training rows of each meta learner, all from one moment matrix."""
        with nullcontext(oof) if oof is not None else self.out_of_fold(df) as table:
            _, _, wide, features = self._meta_table(table)
            g = collect_gram(wide, [col(c) for c in [*features, SCALED]])[()]
        return [r_squared(g, *learner.solve(g)) for learner in learners]

    def predict(self, df: DataFrame) -> DataFrame:
        """Key and prediction of new rows; each base column is the mean over its fold
        models."""
        if self.model is None:
            raise ValueError("fit the stack first")
        folds = sorted(self.fold_models)
        columns = df.columns
        for f in folds:
            df = predict_all_beside(self.fold_models[f], df, [f"_{name}_{f}" for name in self.names], self._predictions())
        means = [row_mean([f"_{name}_{f}" for f in folds]).alias(name) for name in self.names]
        df = df.select(*[col(c) for c in columns], *means)
        for stage in [*self.stages, self.model]:
            df = stage.transform(df)
        return df.select(col(self.key), self.target_model.inverse(F.col("prediction")).alias("prediction"))


def sweep_meta(df: DataFrame, features: Sequence[str], target: str, learners: Iterable[Linear]) -> DataFrame:
    """(step, r2) of every learner on one table, from one pass."""
    g = collect_gram(df, [col(c) for c in [*features, target]])[()]
    rows = [(i, float(r_squared(g, *learner.solve(g)))) for i, learner in enumerate(learners)]
    return small_frame(df.sparkSession, rows, "step int, r2 double")
