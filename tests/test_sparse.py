"""Sparse encoding and linear models in passes, beside the dense encoding and the moment matrix."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.models import passes
from gablework.models.gram import collect_gram
from gablework.models.linear import ElasticNet, Linear, Ridge
from gablework.operators.sparse import SparseOneHot, SparseOneHotModel
from gablework.operators.transformers import OneHot


@pytest.fixture(scope="module")
def sales(spark):
    """Two categories of 30 and 12 levels, one of them hot, a number far from 0, and a target on them."""
    rng = np.random.default_rng(4)
    n = 3_000
    a, b = np.where(rng.random(n) < 0.4, 0, rng.integers(0, 30, n)), rng.integers(0, 12, n)
    x = 2_000 + 20 * rng.normal(size=n)
    y = 5 * np.sin(a) + b / 3 + 0.1 * (x - 2_000) + rng.normal(size=n)
    rows = [(i, f"a{a[i]:02d}", int(b[i]), float(x[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id int, a string, b int, x double, y double").cache()


@pytest.fixture(scope="module")
def both(sales):
    """The same features as entries and as columns."""
    encoder = SparseOneHot(["a", "b"], ["x"]).fit(sales)
    dense = OneHot(["a", "b"]).fit(sales).transform(sales)
    names = [c for c in dense.columns if c.startswith(("a_", "b_"))] + ["x"]
    return encoder, encoder.transform(sales), dense, names


def test_entries_are_the_dense_columns(both):
    encoder, sparse, dense, names = both
    assert encoder.width == len(names)
    wide = dense.select("id", F.array(*[F.col(c).cast("double") for c in names]).alias("d"))
    for r in sparse.select("id", "entries").join(wide, "id").collect():
        found = np.zeros(encoder.width)
        for e in r["entries"]:
            found[e["at"]] = e["x"]
        assert np.array_equal(found, r["d"])
    labels = sorted(encoder.names(sparse.sparkSession).collect())
    assert [f"{r['column']}_{r['level']}" if r["level"] else r["column"] for r in labels] == names


@pytest.mark.parametrize("learner", [Linear(), Ridge(7.0), ElasticNet(0.05, 0.5), ElasticNet(0.1, 0.0)])
def test_passes_agree_with_the_matrix(both, learner):
    encoder, sparse, dense, names = both
    intercept, slopes = learner.solve(collect_gram(dense, [F.col(c) for c in [*names, "y"]])[()])
    fit = learner.fit_entries(sparse, "entries", encoder.width, "y")
    assert fit.slopes == pytest.approx(slopes, abs=1e-4) and fit.intercept == pytest.approx(intercept, abs=0.1)
    assert [bool(v) for v in fit.slopes] == [bool(v) for v in slopes]  # the same columns leave
    r = fit.transform(sparse).join(dense.select("id", *names), "id").first()
    assert r["prediction"] == pytest.approx(intercept + sum(s * r[c] for s, c in zip(slopes, names)), abs=1e-3)


def test_optimality_of_an_elastic_net(both):
    encoder, sparse, _, _ = both
    alpha, ratio = 0.03, 0.7
    with passes.problem(sparse, "entries", F.col("y"), encoder.width) as p:
        _, b = passes.elastic_net(p, alpha, ratio)
        slope = p.product(b, True) / p.n + alpha * (1 - ratio) * b
    scale = np.sqrt(p.spread / p.n) + 1e-12
    assert np.all(np.abs(slope + alpha * ratio * np.sign(b))[b != 0] / scale[b != 0] < 1e-4)
    assert np.all(np.abs(slope[b == 0]) <= alpha * ratio + 1e-5) and 0 < (b == 0).sum()


def test_twenty_thousand_levels_fit_and_predict(spark):
    """Three rows a level: least squares gives the mean of each, ridge draws it to the center."""
    df = spark.range(60_000).select("id", (F.col("id") % 20_000).alias("level"),
                                    (F.col("id") % 20_000 % 101 + F.col("id") % 7).cast("double").alias("y")).cache()
    encoder = SparseOneHot(["level"], drop=None).fit(df)
    hot = encoder.transform(df)
    means = {r["level"]: r["m"] for r in df.groupBy("level").agg(F.avg("y").alias("m")).collect()}
    exact = Linear().fit_entries(hot, "entries", encoder.width, "y").transform(hot).select("level", "prediction").collect()
    assert encoder.width == 20_000 and all(abs(r["prediction"] - means[r["level"]]) < 1e-6 for r in exact)
    center = float(np.mean(list(means.values())))
    drawn = Ridge(2.0).fit_entries(hot, "entries", encoder.width, "y").transform(hot).select("level", "prediction").collect()
    assert all(abs(r["prediction"] - (center + 0.6 * (means[r["level"]] - center))) < 1e-6 for r in drawn)


def test_wide_tables_are_fitted_in_passes(spark, monkeypatch):
    from gablework.models import linear

    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 12))
    y = x @ np.arange(12.0) + 3
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], [f"c{i}" for i in range(12)] + ["y"])
    monkeypatch.setattr(linear, "WIDEST", 10)  # the same route as beyond 2,000
    fit = Linear().fit(df, [f"c{i}" for i in range(12)], "y")
    assert list(fit.slopes.values()) == pytest.approx(list(range(12)), abs=1e-6) and fit.intercept == pytest.approx(3)


def test_missing_values_and_unseen_levels(spark, tmp_path):
    rows = [(1, "u", 1.0, 1.0), (2, "v", 2.0, 3.0), (3, None, 0.0, 2.0), (4, "v", None, 9.0),
            (5, "u", math.nan, 9.0), (6, "v", math.inf, 9.0), (7, "u", 3.0, math.nan), (8, "v", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "id int, a string, x double, y double").withColumn("_lk0", F.lit("kept"))
    with pytest.raises(Exception, match="unseen level in a: missing"):
        SparseOneHot(["a"]).fit(df).transform(df).collect()
    model = SparseOneHot(["a"], ["x"], drop=None, unseen="ignore").fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    out = SparseOneHotModel.load(str(tmp_path / "m")).transform(df)
    found = {r["id"]: r["entries"] and [tuple(e) for e in r["entries"]] for r in out.collect()}
    assert found == {1: [(0, 1.0), (2, 1.0)], 2: [(1, 1.0), (2, 2.0)], 3: [(2, 0.0)], 4: None, 5: None, 6: None,
                     7: [(0, 1.0), (2, 3.0)], 8: [(1, 1.0), (2, 1.0)]}
    assert out.columns == ["id", "a", "x", "y", "_lk0", "entries"] and out.first()["_lk0"] == "kept"
    with passes.problem(out, "entries", F.col("y"), model.width) as p:
        assert p.n == 4
    predicted = {r["id"]: r["prediction"] for r in Linear().fit_entries(out, "entries", 3, "y").transform(out).collect()}
    assert predicted[4] is None and predicted[7] is not None
    empty = SparseOneHot(["a"]).fit(df.limit(0))
    assert empty.width == 0
    with pytest.raises(ValueError, match="no complete rows"):
        Linear().fit_entries(out.where("id = 4"), "entries", 3, "y")


def test_unconverged_solutions_are_told(both):
    encoder, sparse, _, _ = both
    with passes.problem(sparse, "entries", F.col("y"), encoder.width) as p:
        with pytest.warns(UserWarning, match="did not converge in 2 steps"):
            passes.elastic_net(p, 0.01, 0.5, most=2)


def test_partial_sums_travel_in_few_chunks_at_a_time():
    """A task's partial sums are as wide as the table, so they leave it in small batches; chunks of zeros stay."""
    from gablework.models import passes

    held = {c: np.full(4, float(c)) for c in range(100)}
    batches = list(passes._chunks(held))
    assert max(b.num_rows for b in batches) <= 32
    sent = {c: np.frombuffer(v, float) for b in batches for c, v in zip(b.column("chunk").to_pylist(), b.column("sums").to_pylist())}
    assert sorted(sent) == list(range(1, 100)) and all((v == c).all() for c, v in sent.items())
