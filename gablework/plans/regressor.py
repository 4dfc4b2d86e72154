"""The common regressor: cleaning, feature plan, target chain and learner as one thing."""

from __future__ import annotations

import contextlib
import json
from collections.abc import Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..functions import scores
from ..functions.columns import col
from ..models.gram import WIDEST, collect_gram
from ..models.linear import Linear, LinearFit
from ..session import kept, side_by_side
from ..stage import Step
from .cleaning import CleaningRules
from .features import CARRIED, FeaturePlan
from .target import TargetModel, TargetTransform

SCALED = "_scaled_target"


class InversePrediction(Step):
    """The prediction back on the scale of the target."""

    def __init__(self, target=None, fitted=(), prediction="prediction"):
        super().__init__(**({"target": target, "fitted": list(fitted), "prediction": prediction} if target else {}))

    def _transform(self, df: DataFrame) -> DataFrame:
        chain = TargetModel(self["target"], self["fitted"], self["target"])
        return df.withColumn(self["prediction"], chain.inverse(col(self["prediction"])))


class TabularRegressor:
    """``fit`` learns every part on the given rows only and returns a ``PipelineModel``:
    raw rows in, keys and predictions out. Save it with ``sources.save_model``."""

    def __init__(self, learner, plan: FeaturePlan, target: str, cleaning: CleaningRules | None = None,
                 chain: Sequence[str] = ("log", "standard"), keep: Iterable[str] = (), prediction: str = "prediction"):
        self.learner, self.target, self.cleaning, self.chain = learner, target, cleaning, tuple(chain)
        self.keep, self.prediction = list(keep), prediction
        self.plan = plan.keeping([*self.keep, target])
        self.model: PipelineModel | None = None
        self._best: tuple | None = None

    def search(self, df: DataFrame, grid: Sequence, fold: str = "fold", refit_plan: bool = True,
               scoring: str = "neg_mse") -> TabularRegressor:
        """Try every learner of the grid by cross-validation and take the best one; fit
        afterwards."""
        from ..validation.search import search_regressor

        self._best = search_regressor(self, df, grid, fold, refit_plan, scoring)
        self.learner = self._best[0]
        return self

    def _searched(self) -> tuple:
        if self._best is None:
            raise ValueError("search first")
        return self._best

    @property
    def best_learner(self):
        """The learner with the best mean score, with its parameters."""
        return self._searched()[0]

    @property
    def best_score(self) -> float:
        return self._searched()[1]

    def prepare(self, df: DataFrame):
        """Fitted cleaning, plan and chain, and the wide table with the scaled target."""
        def features():
            cleaner = self.cleaning.fit(df) if self.cleaning else None
            cleaned = cleaner.transform(df) if cleaner else df
            return cleaner, cleaned, self.plan.fit(cleaned)

        (cleaner, cleaned, plan), chain = side_by_side(
            [features, lambda: TargetTransform(self.target, self.chain, SCALED).fit(df)])
        return [s for s in (cleaner, plan) if s], chain, chain.transform(plan.transform(cleaned))

    def fit(self, df: DataFrame) -> PipelineModel:
        self.model, = fit_together([self], df)
        return self.model

    def preparation(self) -> str:
        """What is learned before the learner; equal texts mean equal wide tables."""
        cleaning = self.cleaning.getOrDefault("config") if self.cleaning else None
        return json.dumps([cleaning, self.plan.getOrDefault("config"), self.target, self.chain])

    def _fitted(self) -> PipelineModel:
        if self.model is None:
            raise ValueError("fit the model first")
        return self.model

    def predict(self, df: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
        out = self._fitted().transform(df)
        return out.select(*[col(c) for c in dict.fromkeys([*self.keep, *extra]) if c in out.columns],
                          col(self.prediction))

    def score(self, df: DataFrame) -> dict[str, float]:
        """R2 on the log scale, MSLE (no root) and RMSLE of the model on labeled rows."""
        y, p = col(self.target), col(self.prediction)
        row = self.predict(df, [self.target]).agg(
            scores.r2(F.log(y), F.log(p)).alias("r2"), scores.msle(y, p).alias("msle"),
            scores.rmsle(y, p).alias("rmsle")).first()
        return row.asDict()


def fit_together(regressors: Sequence[TabularRegressor], df: DataFrame) -> list[PipelineModel]:
    """Fit several regressors on the same rows. Those that share cleaning, plan and chain
    share the prepared table, and the linear ones among them one moment matrix, up to its WIDEST columns."""
    models: dict[int, PipelineModel] = {}
    groups: dict[str, list[int]] = {}
    for i, r in enumerate(regressors):
        groups.setdefault(r.preparation(), []).append(i)
    for members in groups.values():
        stages, chain, wide = regressors[members[0]].prepare(df)
        names = stages[-1].feature_names
        linear = [i for i in members if isinstance(regressors[i].learner, Linear) and len(names) < WIDEST]
        fits = {}
        with contextlib.ExitStack() as stack:
            if len(members) > len(linear):
                # iterative learners read the table many times
                wide = stack.enter_context(kept(wide))
            if linear:
                g = collect_gram(wide, [col(c) for c in [*names, SCALED]])[()]
                fits = {i: LinearFit(names, *regressors[i].learner.solve(g), regressors[i].prediction) for i in linear}
            for i in members:
                r = regressors[i]
                model = fits[i] if i in fits else r.learner.fit(wide, names, SCALED, r.prediction)
                tail = InversePrediction(r.target, chain["fitted"], r.prediction)
                models[i] = PipelineModel([*stages, model, tail])
    return [models[i] for i in range(len(regressors))]


def predict_beside(model, df: DataFrame, name: str, prediction: str = "prediction") -> DataFrame:
    """The table as it was plus one prediction column: the row travels along in a struct,
    so that no join is needed to bring the two together."""
    carried = df.select("*", F.struct(*[col(c) for c in df.columns]).alias(CARRIED))
    return model.transform(carried).select(f"{CARRIED}.*", col(prediction).alias(name))


def predict_all_beside(models: Sequence[PipelineModel], df: DataFrame, names: Sequence[str],
                       predictions: Sequence[str]) -> DataFrame:
    """``predict_beside`` for the models of one ``fit_together``: those that share a preparation go through it once."""
    columns, groups = df.columns, {}
    for model, name, prediction in zip(models, names, predictions):
        groups.setdefault(tuple(map(id, model.stages[:-2])), []).append((model, name, prediction))
    for members in groups.values():
        wide = df.select("*", F.struct(*[col(c) for c in df.columns]).alias(CARRIED))
        for stage in members[0][0].stages[:-2]:
            wide = stage.transform(wide)
        for model, name, prediction in members:
            before = wide.columns
            for stage in model.stages[-2:]:
                wide = stage.transform(wide)
            wide = wide.select(*[col(c) for c in before], col(prediction).alias(name))
        df = wide.select(f"{CARRIED}.*", *[col(name) for _, name, _ in members])
    return df.select([col(c) for c in [*columns, *names]])

