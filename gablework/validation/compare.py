"""Comparing data variants: repeated cross-validation and the two-sample t test."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col, finite
from ..models.gram import gram, square
from ..models.linear import Linear
from ..models.solve import squared_error
from ..session import kept, small_frame
from .folds import with_folds
from .search import cv_rmse

def repeat_cv(df: DataFrame, variants: Mapping[str, Sequence[str]], target: str, key: str, k: int = 10,
              repeats: int = 10, learner=None, seed: int = 6) -> DataFrame:
    """(variant, repeat, mean_rmse, std_rmse): k-fold cross-validation, repeated with
    other folds, of feature sets that share one table.

    Every repeat deals each row anew by a hash of its key and the repeat. A linear learner reads the rows once:
    there is one moment matrix per repeat and fold over the columns of all variants, and the folds of one repeat
    are looked at together. Other learners are fitted per repeat and fold.
    """
    learner = learner or Linear()
    rows = []
    if isinstance(learner, Linear):
        columns = list(dict.fromkeys(c for features in variants.values() for c in features))
        dealt = df.select(*[col(c) for c in [*columns, target]], col(key).alias("_dealt_by"),
                          F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("_repeat"))
        dealt = dealt.withColumn("_fold", F.pmod(F.xxhash64("_dealt_by", F.col("_repeat") + seed), F.lit(k)).cast("int"))
        with kept(gram(dealt, [col(c) for c in [*columns, target]], ["_repeat", "_fold"])) as matrices:
            for repeat in range(1, repeats + 1):
                folds = [square(r["gram"]) for r in matrices.where(F.col("_repeat") == repeat).orderBy("_fold").collect()]
                for name, features in variants.items():
                    at = [0, *[1 + columns.index(c) for c in features], len(columns) + 1]
                    own = [g[np.ix_(at, at)] for g in folds if g[0, 0] > 0]
                    total = sum(own)
                    errors = [math.sqrt(squared_error(g, *learner.solve(total - g))) for g in own]
                    rows.append((name, repeat, float(np.mean(errors)), float(np.std(errors))))
    else:
        for repeat in range(1, repeats + 1):
            folded = with_folds(df, k, key, seed + repeat, "_fold")
            for name, features in variants.items():
                errors = [r["rmse"] for r in cv_rmse(folded, learner, features, target, "_fold").collect()]
                rows.append((name, repeat, float(np.mean(errors)), float(np.std(errors))))
    return small_frame(df.sparkSession, rows, "variant string, repeat int, mean_rmse double, std_rmse double")


def ttest(df: DataFrame, value: str, variant: str, a, b) -> DataFrame:
    """Student's t test with equal variances of two groups of rows: diff, t, df, p_value. NaN for an empty
    group, or if both have one row."""
    v, g = finite(col(value).cast("double")), col(variant)

    def stats(which):
        x = F.when(g == F.lit(which), v)
        return F.avg(x), F.var_samp(x), F.count(x).cast("double")

    (ma, va, na), (mb, vb, nb) = stats(a), stats(b)
    row = df.agg(ma.alias("ma"), va.alias("va"), na.alias("na"), mb.alias("mb"), vb.alias("vb"), nb.alias("nb")).first()
    freedom = row["na"] + row["nb"] - 2
    if min(row["na"], row["nb"]) < 1 or freedom < 1:  # nothing to compare
        diff = row["ma"] - row["mb"] if row["na"] and row["nb"] else math.nan
        return small_frame(df.sparkSession, [(diff, math.nan, freedom, math.nan)], "diff double, t double, df double, p_value double")
    diff = row["ma"] - row["mb"]
    pooled = sum((row[f"n{s}"] - 1) * (row[f"v{s}"] or 0.0) for s in "ab") / freedom  # one row has no variance
    error = math.sqrt(pooled * (1 / row["na"] + 1 / row["nb"]))
    t = diff / error if error > 0 else math.copysign(math.inf, diff) if diff else math.nan
    return small_frame(df.sparkSession, [(diff, t, freedom, two_sided(t, freedom))],
                       "diff double, t double, df double, p_value double")


def two_sided(t: float, freedom: float) -> float:
    """P(|T| >= |t|) for Student's t."""
    if math.isnan(t):
        return math.nan
    if math.isinf(t):
        return 0.0
    return incomplete_beta(freedom / 2, 0.5, freedom / (freedom + t * t))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    tiny, c = 1e-300, 1.0
    d = 1 / max(1 - (a + b) * x / (a + 1), tiny)
    fraction = d
    for m in range(1, 1000):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + top * d) or tiny)
            c = (1 + top / c) or tiny
            fraction *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * fraction / a


def compare_variants(df: DataFrame, variants: Mapping[str, Sequence[str]], target: str, key: str,
                     k: int = 10, repeats: int = 10, learner=None) -> DataFrame:
    """Repeated cross-validation of two feature sets and the t test on their errors."""
    (a, _), (b, _) = variants.items()
    return ttest(repeat_cv(df, variants, target, key, k, repeats, learner), "mean_rmse", "variant", a, b).select(
        F.lit(a).alias("first"), F.lit(b).alias("second"), "*")
