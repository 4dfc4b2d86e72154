from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gablework.functions import scores
from gablework.functions.columns import col
from gablework.models import gram as G, grouped, kernel, linear, robust, solve, trees

X = [f"x{i}" for i in range(5)]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    n = 4000
    x = rng.normal(0, [1, 2, 0.5, 3, 1], (n, 5)) + [0, 10, -3, 0, 100]
    x[:, 4] = x[:, 0] * 0.5 + x[:, 4]
    y = x @ [2.0, -1.0, 0.0, 0.5, 1.0] + 7 + rng.normal(0, 0.5, n)
    frame = pd.DataFrame(x, columns=X).assign(
        y=y, g=np.where(rng.random(n) < 0.6, "hot", rng.choice(list("abc"), n)), fold=np.arange(n) % 4, id=np.arange(n))
    return spark.createDataFrame(frame).repartition(5).cache(), frame


def plain_elastic(x, y, alpha, l1_ratio, sweeps=3000):
    """Coordinate descent on the rows themselves."""
    xm, ym, n = x.mean(0), y.mean(), len(y)
    xc, b = x - xm, np.zeros(x.shape[1])
    r = y - ym
    for _ in range(sweeps):
        for j in range(len(b)):
            r = r + xc[:, j] * b[j]
            rho = xc[:, j] @ r / n
            b[j] = np.sign(rho) * max(abs(rho) - alpha * l1_ratio, 0) / (xc[:, j] @ xc[:, j] / n + alpha * (1 - l1_ratio))
            r = r - xc[:, j] * b[j]
    return ym - xm @ b, b


def test_least_squares_and_ridge(data):
    df, frame = data
    x, y = frame[X].to_numpy(), frame["y"].to_numpy()
    fit = linear.fit_linear(df, X, "y")
    expected = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x]), y, rcond=None)[0]
    np.testing.assert_allclose([fit.intercept, *fit["slopes"]], expected, rtol=1e-7, atol=1e-7)
    xc = x - x.mean(0)
    b = np.linalg.solve(xc.T @ xc + 50 * np.eye(5), xc.T @ (y - y.mean()))
    np.testing.assert_allclose(linear.fit_ridge(df, X, "y", 50.0)["slopes"], b, rtol=1e-7)


@pytest.mark.parametrize("alpha, ratio", [(0.05, 0.4), (0.3, 1.0), (0.1, 0.0)])
def test_elastic_net(data, alpha, ratio):
    df, frame = data
    fit = linear.fit_elastic(df, X, "y", alpha, ratio)
    intercept, b = plain_elastic(frame[X].to_numpy(), frame["y"].to_numpy(), alpha, ratio, 300)
    np.testing.assert_allclose(fit["slopes"], b, atol=1e-6)
    assert abs(fit.intercept - intercept) < 1e-4


def test_collinear_columns(data):
    df, _ = data
    twice = df.withColumn("x9", F.col("x0") * 2)
    fit = linear.fit_linear(twice, ["x0", "x9"], "y")
    assert np.isfinite(fit["slopes"]).all()


def test_numpy_matrix_equals_builtin(data, monkeypatch):
    df, _ = data
    holes = df.withColumn("x2", F.when(F.col("id") % 50 != 0, F.col("x2")))
    columns = [col(c) for c in [*X, "y"]]
    built = G.collect_gram(holes, columns, ["g", "fold"])
    monkeypatch.setattr(G, "BUILTIN_PRODUCTS", 0)
    monkeypatch.setattr(G, "HELD_DOUBLES", 100)
    own = G.collect_gram(holes, columns, ["g", "fold"])
    assert built.keys() == own.keys() and len(own) == 16
    for key in own:
        np.testing.assert_allclose(own[key], built[key], rtol=1e-9, atol=1e-6)
    total = G.collect_gram(holes, columns)[()]
    np.testing.assert_allclose(sum(own.values()), total, rtol=1e-9, atol=1e-6)
    assert total[0, 0] == 4000 - 80


def test_groups(data):
    df, frame = data
    fit = grouped.fit_by_group(df, "g", X, "y", params={"hot": (0.05, 0.5)})
    table = {r["g"]: r for r in fit.coefficients(df.sparkSession).collect()}
    hot, a = frame[frame["g"] == "hot"], frame[frame["g"] == "a"]
    np.testing.assert_allclose([table["hot"][c] for c in X], plain_elastic(
        hot[X].to_numpy(), hot["y"].to_numpy(), 0.05, 0.5, 300)[1], atol=1e-6)
    expected = np.linalg.lstsq(np.column_stack([np.ones(len(a)), a[X]]), a["y"], rcond=None)[0]
    np.testing.assert_allclose([table["a"][c] for c in X], expected[1:], atol=1e-6)
    new = df.sparkSession.createDataFrame([("unseen", *[1.0] * 5)], ["g", *X])
    assert fit.transform(new).first()["prediction"] is None


def test_huber_withstands_outliers(data):
    df, _ = data
    spoiled = df.withColumn("y", F.when(F.col("id") % 20 == 0, F.col("y") + 500).otherwise(F.col("y")))
    fit = robust.fit_huber(spoiled, X[:4], "y", epsilon=1.35)
    slopes = list(fit.slopes.values())
    assert abs(slopes[1] + 1.0) < 0.05 and abs(slopes[3] - 0.5) < 0.05


def r2(df, prediction="prediction"):
    return df.agg(scores.r2(F.col("y"), F.col(prediction))).first()[0]


@pytest.mark.parametrize("learner", [
    trees.Boosted(n_trees=12, rate=0.3), trees.Boosted(n_trees=8, rate=0.3, loss="absolute", features="sqrt", rows=0.9),
    trees.Forest(n_trees=8, depth=6), trees.Tree(depth=5)])
def test_trees_beat_the_mean(data, learner):
    df, frame = data
    out = learner.fit(df, X, "y").transform(df)
    assert out.count() == len(frame)
    assert r2(out) > 0.4


def test_kernel_bends(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(-3, 3, 3000)
    frame = pd.DataFrame({"x": x, "z": rng.normal(0, 1, 3000), "y": np.sin(2 * x) + rng.normal(0, 0.05, 3000)})
    df = spark.createDataFrame(frame)
    fit = kernel.fit_rbf(df, ["x", "z"], "y", gamma=0.5, n_features=150, alpha=0.1)
    assert r2(fit.transform(df)) > 0.9
    assert r2(linear.fit_linear(df, ["x", "z"], "y").transform(df)) < 0.4
    assert fit.transform(df.withColumn("z", F.lit(None).cast("double"))).first()["prediction"] is None
    rows = frame[["x", "z"]].to_numpy()[:40]
    w, b = kernel.waves(2, 20_000, 0.5, 1)
    z = np.sqrt(2 / 20_000) * np.cos(rows @ w + b)
    true = np.exp(-0.5 * ((rows[:, None] - rows[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - true).max() < 0.06


def test_fit_needs_rows(data):
    df, _ = data
    with pytest.raises(ValueError):
        linear.fit_linear(df.where("id < 0"), X, "y")


def test_scores_from_matrices(data):
    df, frame = data
    g = G.collect_gram(df, [col(c) for c in [*X, "y"]])[()]
    intercept, b = solve.ridge(g)
    p = intercept + frame[X].to_numpy() @ b
    assert abs(solve.squared_error(g, intercept, b) - np.mean((frame["y"] - p) ** 2)) < 1e-6
    assert abs(solve.r_squared(g, intercept, b) - (1 - np.var(frame["y"] - p) / np.var(frame["y"]))) < 1e-8
