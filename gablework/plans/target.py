"""Target chains: transform the target for fitting, turn predictions back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import col, log_of_positive
from ..operators import distribution as D
from ..operators.profile import fit_moments
from ..operators.transformers import QUARTILES, _or_one, quartiles_of
from ..stage import Fitted, Learner


class TargetTransform(Learner):
    """``steps`` from "log", "yeo_johnson", "standard", "robust", each fitted on the
    outcome of the ones before. A target of 0 or less has no log, which is an error; a missing one stays missing."""

    def __init__(self, target: str | None = None, steps: Sequence[str] = ("log", "standard"),
                 output: str | None = None):
        super().__init__(**({"target": target, "steps": list(steps), "output": output or target} if target else {}))

    def _fit(self, df: DataFrame) -> TargetModel:
        y, fitted = col(self["target"]).cast("double"), []
        for step in self["steps"]:
            current = df.select(_chain(y, fitted).alias("y"))
            if step == "log":
                constants = []
            elif step == "yeo_johnson":
                constants = [D.fit_yeo_johnson(current, ["y"])[0][0]]
            elif step == "standard":
                mean, std = fit_moments(current, ["y"])["y"]
                constants = [mean, _or_one(std)]
            elif step == "robust":
                low, mid, high = quartiles_of(D.exact_quantiles(current, ["y"], QUARTILES)[0])
                constants = [mid, _or_one(high - low)]
            else:
                raise ValueError(f"unknown target step {step!r}")
            fitted.append([step, constants])
        return TargetModel(self["target"], fitted, self["output"])


def _chain(y: Column, fitted) -> Column:
    for step, constants in fitted:
        if step == "log":
            y = log_of_positive(y, "the target")
        elif step == "yeo_johnson":
            y = D.yeo_johnson(y, F.lit(constants[0]))
        else:
            y = (y - F.lit(constants[0])) / F.lit(constants[1])
    return y


class TargetModel(Fitted):
    def __init__(self, target=None, fitted=(), output=None):
        super().__init__(**({"target": target, "fitted": list(fitted), "output": output} if target else {}))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self["output"], _chain(col(self["target"]).cast("double"), self["fitted"]))

    def forward(self, y: Column) -> Column:
        return _chain(y, self["fitted"])

    def inverse(self, y: Column) -> Column:
        for step, constants in reversed(self["fitted"]):
            if step == "log":
                y = F.exp(y)
            elif step == "yeo_johnson":
                y = D.yeo_johnson_inverse(y, constants[0])
            else:
                y = y * F.lit(constants[1]) + F.lit(constants[0])
        return y
