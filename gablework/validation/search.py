"""Cross-validation and grid search.

Linear models need one pass: the moment matrix per fold gives every training matrix as
total minus fold, and every fold error from the held-out matrix. Other learners are
fitted fold by fold.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import scores
from ..functions.columns import col, complete_rows
from ..models.gram import collect_gram, gram, square
from ..models.linear import Linear
from ..models.solve import elastic_net, r_squared, ridge, squared_error
from ..session import kept, runs_in_tasks, side_by_side, small_frame

def fold_matrices(df: DataFrame, features: Sequence[str], target: str, fold: str) -> dict[int, np.ndarray]:
    return {k[0]: g for k, g in sorted(
        collect_gram(df, [col(c) for c in [*features, target]], [fold]).items())}


def training_fits(matrices: dict, learner: Linear) -> dict:
    """{fold: (intercept, slopes)} fitted on the other folds."""
    total = sum(matrices.values())
    return {f: learner.solve(total - g) for f, g in matrices.items()}


def cv_rmse(df: DataFrame, learner, features: Sequence[str], target: str, fold: str = "fold") -> DataFrame:
    """(fold, n, rmse) of the held-out rows."""
    if isinstance(learner, Linear):
        matrices = fold_matrices(df, features, target, fold)
        fits = training_fits(matrices, learner)
        rows = [(int(f), int(round(g[0, 0])), float(np.sqrt(squared_error(g, *fits[f])))) for f, g in matrices.items()]
        return small_frame(df.sparkSession, rows, "fold int, n bigint, rmse double")
    held_out = out_of_fold(df, learner, features, target, fold)
    y, p = col(target), col("_prediction")
    return held_out.groupBy(col(fold).alias("fold")).agg(F.count(y).alias("n"), scores.rmse(y, p).alias("rmse"))


def fold_values(df: DataFrame, fold: str) -> list:
    """The folds in order; rows without one belong to none."""
    return sorted(r[0] for r in complete_rows(df.select(col(fold)), [fold]).distinct().collect())


def out_of_fold(df: DataFrame, learner, features: Sequence[str], target: str, fold: str) -> DataFrame:
    """The rows with ``_prediction`` from the model that did not see their fold."""
    narrow = df.select(*[col(c) for c in dict.fromkeys([*features, target, fold])])
    with kept(narrow) as rows:
        folds = fold_values(rows, fold)
        models = side_by_side([
            lambda f=f: learner.fit(rows.where(col(fold) != F.lit(f)), features, target, "_prediction") for f in folds])
    parts = [m.transform(df.where(col(fold) == F.lit(f))).select(*[col(c) for c in df.columns], "_prediction")
             for f, m in zip(folds, models)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def grid_search(df: DataFrame, features: Sequence[str], target: str, alphas: Iterable[float],
                l1_ratios: Iterable[float], fold: str = "fold", group: str | None = None) -> DataFrame:
    """Elastic-net scores of every grid point: [group,] l1_ratio, alpha, neg_mse and r2,
    each the mean over the folds.

    The rows are read once. Grid lines (one l1_ratio of one group) are then solved in
    parallel tasks, along falling alpha from the solution before.
    """
    groups = [group] if group else []
    source = df.where(col(group).isNotNull()) if group else df
    columns = [col(c) for c in [*features, target]]
    falling = sorted({float(a) for a in alphas}, reverse=True)
    lines = F.array(*[F.lit(float(r)) for r in l1_ratios])
    matrices = gram(source, columns, [*groups, fold]).withColumn("l1_ratio", F.explode(lines))
    schema = T.StructType([*[df.schema[g] for g in groups], *[
        T.StructField(n, T.DoubleType()) for n in ("l1_ratio", "alpha", "neg_mse", "r2")]])

    def line(key: tuple[Any, ...], frame: pd.DataFrame) -> pd.DataFrame:
        ratio, folds = key[-1], [square(flat) for flat in frame.sort_values(fold)["gram"]]
        total, starts, rows = sum(folds), [None] * len(folds), []
        for alpha in falling:
            errors, fits = [], []
            for i, held in enumerate(folds):
                if len(folds) < 2:
                    break
                train = total - held
                intercept, b = elastic_net(train, alpha, ratio, starts[i]) if alpha else ridge(train)
                starts[i] = b
                errors.append(squared_error(held, intercept, b))
                fits.append(r_squared(held, intercept, b))
            if errors:
                rows.append((*key, alpha, -float(np.mean(errors)), float(np.mean(fits))))
        return pd.DataFrame(rows, columns=[f.name for f in schema.fields])

    return matrices.groupBy(*[col(g) for g in groups], "l1_ratio").applyInPandas(line, schema)


def best_points(table: DataFrame, group: str | None = None, scoring: str = "neg_mse") -> DataFrame:
    """The best grid point, of all or per group; the smaller alpha, then l1_ratio, on ties."""
    point = F.struct("alpha", "l1_ratio", "neg_mse", "r2")
    order = F.struct(col(scoring), -F.col("alpha"), -F.col("l1_ratio"))
    source = table.groupBy(col(group)) if group else table.groupBy()
    picked = source.agg(F.max_by(point, order).alias("p"))
    return picked.select(*([col(group)] if group else []), "p.*")


def search_regressor(regressor, df: DataFrame, grid: Sequence, fold: str, refit_plan: bool = True,
                     scoring: str = "neg_mse") -> tuple:
    """(best learner, best score, all scores) over any learners, for a TabularRegressor.

    ``refit_plan`` learns cleaning, plan and target chain inside each training part; with
    False they are learned once on all rows, which lets the held-out rows leak into the
    scaling but needs fewer passes.
    """
    with kept(df) as rows:
        return _search(regressor, rows, grid, fold, refit_plan, scoring)


def _search(regressor, df: DataFrame, grid: Sequence, fold: str, refit_plan: bool, scoring: str) -> tuple:
    from ..plans.regressor import SCALED

    shared = None if refit_plan else regressor.prepare(df.drop(fold))
    linear = all(isinstance(learner, Linear) for learner in grid)

    def of_fold(f) -> list[tuple[float, float]]:
        train, held = df.where(col(fold) != F.lit(f)), df.where(col(fold) == F.lit(f))
        stages, chain, _ = shared or regressor.prepare(train)

        def widen(rows):
            for stage in stages:
                rows = stage.transform(rows)
            return chain.transform(rows)

        names = stages[-1].feature_names
        columns = [col(c) for c in [*names, SCALED]]
        if linear:
            train_g, held_g = (collect_gram(widen(rows), columns)[()] for rows in (train, held))
            fits = [learner.solve(train_g) for learner in grid]
            return [(-squared_error(held_g, *fit), r_squared(held_g, *fit)) for fit in fits]
        y, p, results = col(SCALED), col("_prediction"), []
        with kept(widen(train)) as rows, kept(widen(held)) as rest:
            for learner in grid:
                scored = learner.fit(rows, names, SCALED, "_prediction").transform(rest)
                row = scored.agg((-scores.mse(y, p)).alias("neg_mse"), scores.r2(y, p).alias("r2")).first()
                results.append((row["neg_mse"], row["r2"]))
        return results

    by_fold = side_by_side([lambda f=f: of_fold(f) for f in fold_values(df, fold)])
    column = 0 if scoring == "neg_mse" else 1
    means = [float(np.mean([results[i][column] for results in by_fold])) for i in range(len(grid))]
    best = int(np.argmax(means))
    return grid[best], means[best], list(zip(grid, means))


runs_in_tasks(__name__)
