"""One elastic net per group, all from one pass: the group is a key of the moment matrix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import col
from ..operators.lookup import LookupModel, freeze
from .gram import gram, square
from .solve import elastic_net, ridge


def fit_by_group(df: DataFrame, group: str, features: Sequence[str], target: str,
                 params: Mapping | None = None, default: tuple[float, float] = (0.0, 1.0),
                 prediction: str = "prediction") -> GroupedFit:
    """``params`` maps a group to (alpha, l1_ratio); groups not listed use ``default``.

    Each task adds up its rows per group, so a group with most of the rows is no
    heavier than others; the solver sees one small matrix per group.
    """
    params, (alpha, l1_ratio) = dict(params or {}), default
    matrices = gram(df.where(col(group).isNotNull()), [col(c) for c in [*features, target]], [group])
    schema = T.StructType([df.schema[group], T.StructField("n", T.DoubleType()),
                           T.StructField("intercept", T.DoubleType()),
                           T.StructField("slopes", T.ArrayType(T.DoubleType()))])

    def solved(batches):
        for frame in batches:
            rows = []
            for key, flat in zip(frame[group], frame["gram"]):
                g = square(flat)
                a, r = params.get(key, (alpha, l1_ratio))
                intercept, b = elastic_net(g, a, r) if a else ridge(g)
                rows.append((key, float(g[0, 0]), float(intercept), [float(v) for v in b]))
            yield pd.DataFrame(rows, columns=[group, "n", "intercept", "slopes"])

    return GroupedFit(group, ["intercept", "slopes"], freeze(matrices.mapInPandas(solved, schema)),
                      features=list(features), prediction=prediction)


class GroupedFit(LookupModel):
    """A table of (group, intercept, slopes); rows of unseen groups get no prediction."""

    def _transform(self, df: DataFrame) -> DataFrame:
        joined = self.attach(df)
        slopes = col("_found_slopes")
        # a fold over arrays: a chain of many plus signs is too deep to parse
        terms = F.zip_with(slopes, F.array(*[col(c).cast("double") for c in self["features"]]), lambda b, x: b * x)
        value = F.when(slopes.isNotNull(), F.aggregate(terms, col("_found_intercept"), lambda total, term: total + term))
        return joined.withColumn(self["prediction"], value).drop("_found_intercept", "_found_slopes")

    def coefficients(self, spark) -> DataFrame:
        """(group, intercept, one column per feature)."""
        return self.table(spark).select(
            col(self["key"]), "intercept", *[F.col("slopes")[i].alias(c) for i, c in enumerate(self["features"])])
