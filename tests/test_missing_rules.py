"""NaN, infinite and constant columns: one rule for narrow and wide tables, and no division by zero."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.functions import scores, text
from gablework.models import gram as gram_module
from gablework.models.linear import fit_linear
from gablework.operators import profile
from gablework.operators.distribution import exact_quantiles
from gablework.validation.compare import ttest
from gablework.validation.search import cv_rmse
from gablework.models.linear import Linear


@pytest.fixture(scope="module")
def spiky(spark):
    """Twenty columns, of which x0 has a NaN and x1 is constant."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 20))
    x[7, 0] = math.nan
    x[:, 1] = 3.0
    y = 2 * x[:, 2] - x[:, 3] + rng.normal(size=300) * 0.1
    rows = [(*map(float, r), float(v), i % 4 if i % 50 else None) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ", ".join(f"x{i} double" for i in range(20)) + ", y double, fold int"), x, y


def test_narrow_and_wide_correlations_agree(spiky):
    df, x, _ = spiky
    names = [f"x{i}" for i in range(20)]
    wide = {(r.a, r.b): r.r for r in profile.corr_matrix(df, names).collect()}
    narrow = {(r.a, r.b): r.r for r in profile.corr_matrix(df, names[:6]).collect()}
    for (a, b), r in narrow.items():
        i, j = int(a[1:]), int(b[1:])
        keep = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        if 1 in (i, j):
            assert r is None and wide[a, b] is None
        else:
            assert r == pytest.approx(np.corrcoef(x[keep, i], x[keep, j])[0, 1]) and wide[a, b] == pytest.approx(r)


def test_narrow_and_wide_matrices_agree(spiky, monkeypatch):
    df, _, _ = spiky
    columns = [F.col(c) for c in ("x0", "x2", "y")]
    narrow = gram_module.collect_gram(df, columns, ["fold"])
    monkeypatch.setattr(gram_module, "BUILTIN_PRODUCTS", 0)
    wide = gram_module.collect_gram(df, columns, ["fold"])
    assert narrow.keys() == wide.keys() == {(0,), (1,), (2,), (3,)}
    assert all(np.allclose(narrow[k], wide[k]) for k in narrow)


def test_folds_leave_out_rows_without_one(spiky):
    df, _, _ = spiky
    assert sorted(r.fold for r in cv_rmse(df, Linear(), ["x2", "x3"], "y").collect()) == [0, 1, 2, 3]


def test_wide_sums_parse(spark):
    names = [f"c{i}" for i in range(1500)]
    df = spark.range(3).select(*[(F.col("id") * i).alias(n) for i, n in enumerate(names)])
    got = [r[0] for r in df.select(F.expr(text.dot(names, [0.5] * 1500, 1.0))).collect()]
    assert got == [1 + 0.5 * sum(i * k for i in range(1500)) for k in range(3)]


@pytest.mark.parametrize("values", [
    [1.002 ** i for i in range(12_000)],
    [float(i) * 1e300 for i in range(-170, 170)],
    [math.inf, -math.inf, math.nan, None, *map(float, range(11_001))],
    [float(i % 7) for i in range(12_000)],
    [float(i) if i % 3 else 5.0 for i in range(16_000)]])
def test_quantiles_take_few_passes(spark, monkeypatch, values):
    from gablework.operators import distribution

    calls = []
    real = distribution._tighten
    monkeypatch.setattr(distribution, "_tighten", lambda *a: (calls.append(1), real(*a)))
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 0.9, 1.0])[0]
    good = np.sort([v for v in values if v is not None and math.isfinite(v)])
    for q, (low, high, share) in found.items():
        position = q * (len(good) - 1)
        k = math.floor(position)
        assert (low, high) == (good[k], good[min(k + 1, len(good) - 1)]) and share == pytest.approx(position - k)
    assert len(calls) <= 1


def test_no_spread_gives_no_value(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 2.0, 2.5), ("b", 4.0, 3.0)], "g string, y double, p double")
    by_group = {r.g: r.r2 for r in df.groupBy("g").agg(scores.r2(F.col("y"), F.col("p")).alias("r2")).collect()}
    assert by_group["a"] is None and by_group["b"] is not None
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert profile.normal_test(flat, ["v"]).first().statistic is None
    assert all(r.normal_density is None or math.isnan(r.normal_density) for r in profile.normal_fit(flat, "v", 4).collect())
    assert profile.corr_with(df, "p", ["y"]).first().r == pytest.approx(np.corrcoef([1, 2, 4], [2, 2.5, 3])[0, 1])


def test_ttest_of_single_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 4.0)], "g string, v double")
    r = ttest(df, "v", "g", "a", "b").first()
    assert r.diff == -2.0 and r.df == 1.0 and math.isfinite(r.t)
    assert math.isnan(ttest(df, "v", "g", "a", "none").first().t)


def test_infinity_is_missing_in_moments_correlations_and_fits(spark):
    from gablework.models.linear import fit_linear
    from gablework.operators.transformers import RobustScale, StandardScale

    clean = [(float(i), float(i % 7), 2.0 * i + i % 7) for i in range(40)]
    spiked = [*clean, (math.inf, 1.0, 5.0), (-math.inf, 2.0, 5.0), (3.0, 1.0, math.inf), (math.nan, 1.0, 5.0)]
    a, b = (spark.createDataFrame(rows, "x double, z double, y double") for rows in (clean, spiked[:42] + spiked[43:]))
    for learner in (StandardScale(["x"]), RobustScale(["x"])):
        good, found = learner.fit(a), learner.fit(b)
        assert found["centers"] == pytest.approx(good["centers"]) and found["widths"] == pytest.approx(good["widths"])
    everything = spark.createDataFrame(spiked, "x double, z double, y double")
    fit = fit_linear(everything, ["x", "z"], "y")
    assert fit.slopes == pytest.approx({"x": 2.0, "z": 1.0}) and fit.intercept == pytest.approx(0.0, abs=1e-8)
    for df in (everything, everything.select(*everything.columns, *[(everything.x + i).alias(f"x{i}") for i in range(12)])):
        r = {(v.a, v.b): v.r for v in profile.corr_matrix(df, df.columns).collect()}
        pair = r.get(("x", "y"), r.get(("y", "x")))
        assert pair == pytest.approx(np.corrcoef([c[0] for c in clean], [c[2] for c in clean])[0, 1])
