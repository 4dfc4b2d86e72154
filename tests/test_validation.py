from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.models import trees
from gablework.models.linear import ElasticNet, Lasso, Linear, Ridge
from gablework.plans import ensemble
from gablework.validation import compare, folds, scores, search
from test_models import X, data, plain_elastic  # noqa: F401


def test_folds_partition_the_rows(t):
    for seed in (None, 1, 2):
        counts = [r["count"] for r in folds.with_folds(t, 7, "id", seed).groupBy("fold").count().collect()]
        assert len(counts) == 7 and sum(counts) == t.count()
    moved = folds.with_folds(folds.with_folds(t, 7, "id", 1), 7, "id", 2, "other").where("fold <> other").count()
    assert moved > 0


def held_out_errors(frame, solve):
    out = {}
    for f in range(4):
        train, held = frame[frame.fold != f], frame[frame.fold == f]
        a, b = solve(train[X].to_numpy(), train["y"].to_numpy())
        out[f] = float(np.mean((held["y"] - a - held[X].to_numpy() @ b) ** 2))
    return out


def least_squares(x, y):
    c = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x]), y, rcond=None)[0]
    return c[0], c[1:]


def test_cv_rmse(data):  # noqa: F811
    df, frame = data
    got = {r["fold"]: r["rmse"] for r in search.cv_rmse(df, Linear(), X, "y").collect()}
    for f, mse in held_out_errors(frame, least_squares).items():
        assert abs(got[f] - np.sqrt(mse)) < 1e-6


def test_cv_rmse_of_trees(data):  # noqa: F811
    df, _ = data
    rows = search.cv_rmse(df, trees.Tree(depth=4), X, "y").collect()
    assert sum(r["n"] for r in rows) == 4000 and all(r["rmse"] > 0 for r in rows)


def test_grid_search(data):  # noqa: F811
    df, frame = data
    alphas, ratios = [0.01, 0.1, 1.0], [0.2, 1.0]
    table = {(r["alpha"], r["l1_ratio"]): r for r in search.grid_search(df, X, "y", alphas, ratios).collect()}
    assert len(table) == 6
    for (alpha, ratio), row in table.items():
        errors = held_out_errors(frame, lambda x, y: plain_elastic(x, y, alpha, ratio, 200))
        assert abs(row["neg_mse"] + np.mean(list(errors.values()))) < 1e-4
    best = search.best_points(search.grid_search(df, X, "y", alphas, ratios)).first()
    assert best["neg_mse"] == max(r["neg_mse"] for r in table.values())


def test_grid_search_by_group(data):  # noqa: F811
    df, _ = data
    table = search.grid_search(df, X, "y", [0.01, 0.5], [0.5], group="g")
    assert table.count() == 8
    alone = search.grid_search(df.where("g = 'hot'"), X, "y", [0.01, 0.5], [0.5])
    a = sorted(r["neg_mse"] for r in table.where("g = 'hot'").collect())
    np.testing.assert_allclose(a, sorted(r["neg_mse"] for r in alone.collect()), rtol=1e-9)
    assert search.best_points(table, "g").count() == 4


def test_out_of_fold_never_sees_its_own_fold(data):  # noqa: F811
    df, frame = data
    # the target of fold 2 is spoiled: its own predictions must not notice
    spoiled = df.withColumn("y", F.when(F.col("fold") == 2, F.col("y") + 1e6).otherwise(F.col("y")))
    clean, _ = ensemble.oof_predictions(df, Linear(), X, "y")
    other, _ = ensemble.oof_predictions(spoiled, Linear(), X, "y")
    a = clean.where("fold = 2").agg(F.sum("oof")).first()[0]
    b = other.where("fold = 2").agg(F.sum("oof")).first()[0]
    assert abs(a - b) < 1e-3
    assert abs(other.where("fold = 1").agg(F.avg("oof")).first()[0]) > 1e4


def test_fold_mean_is_the_mean_of_fold_models(data):  # noqa: F811
    df, _ = data
    _, models = ensemble.oof_predictions(df, Ridge(5.0), X, "y")
    out = df
    for m in models:
        out = m.transform(out)
    out = ensemble.fold_mean(ensemble.average_models(out, [m["prediction"] for m in models], "mean"), models, "direct")
    assert out.where("abs(mean - direct) > 1e-6").count() == 0


def test_repeat_cv(data):  # noqa: F811
    df, _ = data
    variants = {"all": X, "few": X[:2]}
    rows = compare.repeat_cv(df, variants, "y", "id", k=5, repeats=4, learner=ElasticNet(0.001, 0.5)).collect()
    assert len(rows) == 8
    means = {v: np.mean([r["mean_rmse"] for r in rows if r["variant"] == v]) for v in variants}
    assert 0.48 < means["all"] < 0.53 < means["few"]
    tested = compare.compare_variants(df, variants, "y", "id", k=5, repeats=4).first()
    assert tested["diff"] < 0 and tested["p_value"] < 1e-6


def test_t_distribution():
    # critical values of the two-sided test
    for t, freedom, p in ((12.706, 1, 0.05), (2.228, 10, 0.05), (2.750, 30, 0.01), (1.960, 1e6, 0.05)):
        assert abs(compare.two_sided(t, freedom) - p) < 2e-4
    assert compare.two_sided(0.0, 5) == 1.0


def test_counts_and_scores(t):
    same = scores.check_counts(t, t, "neighborhood")
    assert same.where("not complete").count() == 0
    short = scores.check_counts(t, t.where("liv_area > 100"), "neighborhood")
    assert short.where("not complete").count() > 0
    perfect = scores.score(t.withColumn("p", F.col("sale_price")), "sale_price", "p").first()
    assert perfect["r2"] == 1.0 and perfect["rmse"] == 0.0


@pytest.mark.parametrize("learner", [Lasso(0.01), Ridge(3.0)])
def test_sweep_equals_single_fits(data, learner):  # noqa: F811
    from gablework.functions.scores import r2

    df, _ = data
    swept = ensemble.sweep_meta(df, X, "y", [learner]).first()["r2"]
    single = learner.fit(df, X, "y").transform(df).agg(r2(F.col("y"), F.col("prediction"))).first()[0]
    assert abs(swept - single) < 1e-9
