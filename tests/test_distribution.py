from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from gablework.operators import distribution as D, profile, transformers as T


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(1)
    n = 30_000
    frame = pd.DataFrame({
        "many": np.exp(rng.normal(0, 3, n)) - 5,          # long tail, all values different
        "hot": np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 50, n)),
        "grade": rng.integers(1, 11, n).astype(float),
        "same": np.full(n, 3.0),
    })
    frame["y"] = frame["grade"] ** 2.3 * 10 + rng.normal(0, 20, n)
    frame.loc[::17, "many"] = np.nan
    df = spark.createDataFrame(frame).withColumn("many", F.when(~F.isnan("many"), F.col("many"))).repartition(6)
    return df.cache(), frame


def test_quantiles_are_exact(sample):
    df, frame = sample
    columns, qs = ["many", "hot", "grade", "same"], [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = D.exact_quantiles(df, columns, qs)
    for c, spots in zip(columns, found):
        expected = np.nanpercentile(frame[c], [q * 100 for q in qs])
        got = [D.between(*spots[q]) for q in qs]
        np.testing.assert_allclose(got, expected, rtol=1e-12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e9, 1e9) | st.sampled_from([0.0, 1.0]), min_size=1, max_size=40))
def test_quantiles_of_any_numbers(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    spots = D.exact_quantiles(df, ["x"], [0.25, 0.5])[0]
    np.testing.assert_allclose([D.between(*spots[q]) for q in (0.25, 0.5)], np.percentile(values, [25, 50]),
                               rtol=1e-9, atol=1e-9)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert D.exact_quantiles(df, ["x"], [0.5]) == [{}]
    assert T.RobustScale(["x"]).fit(df)["widths"] == [1.0]


def log_likelihood(x, lam):
    t = np.array([T.yeo_johnson_value(v, lam) for v in x])
    return -len(x) / 2 * math.log(t.var()) + (lam - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()


def test_lambda_maximizes_the_likelihood(sample):
    df, frame = sample
    found = D.fit_yeo_johnson(df, ["many", "hot", "grade", "same"])
    assert found[3][0] == 1.0
    for c, (lam, _) in zip(["many", "hot", "grade"], found):
        x = frame[c].dropna().to_numpy()
        best = log_likelihood(x, lam)
        assert all(best >= log_likelihood(x, lam + d) - 1e-6 for d in (-0.01, -0.001, 0.001, 0.01))


def test_yeo_johnson_inverse_at_special_powers(spark):
    df = spark.createDataFrame([(-3.5,), (-0.2,), (0.0,), (0.7,), (12.0,)], "x double")
    for lam in (-1.3, 0.0, 0.5, 1.0, 2.0, 2.7):
        fit = T.YeoJohnsonModel(["x"], [lam])
        back = [r["x"] for r in fit.inverse(fit.transform(df)).collect()]
        np.testing.assert_allclose(back, [-3.5, -0.2, 0.0, 0.7, 12.0], atol=1e-9)


def test_best_power_against_plain_fits(sample):
    df, frame = sample
    grid = D.linspace(0.1, 4.0, 200)
    power, r2 = D.best_powers(df, ["grade"], "y", grid)[0]
    scores = [np.corrcoef(frame["grade"] ** p, frame["y"])[0, 1] ** 2 for p in grid]
    assert abs(r2 - max(scores)) < 1e-6
    assert abs(power - grid[int(np.argmax(np.round(scores, 6)))]) < 1e-9


def test_wide_correlations_equal_builtin(t):
    columns = ["overall_qual", "frontage", "liv_area", "bsmt_sf", "garage_yr", "sale_price"]
    from gablework.models.gram import pairwise_correlations

    a = {(r["a"], r["b"]): r["r"] for r in profile.corr_matrix(t, columns).collect()}
    b = {(r["a"], r["b"]): r["r"] for r in pairwise_correlations(t, columns).collect()}
    assert a.keys() == b.keys()
    for pair in a:
        assert abs(a[pair] - b[pair]) < 1e-9


def test_histogram_counts_every_row(t):
    assert profile.histogram(t, "liv_area", 50).agg(F.sum("n_rows")).first()[0] == t.count()


def kurtosis_z(x):
    """Anscombe and Glynn, written out again in plain Python."""
    n = len(x)
    m = np.mean(x)
    b2 = np.mean((x - m) ** 4) / np.mean((x - m) ** 2) ** 2
    scaled = (b2 - 3 * (n - 1) / (n + 1)) / math.sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5)))
    s = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / s * (2 / s + math.sqrt(1 + 4 / s ** 2))
    return (1 - 2 / (9 * a) - ((1 - 2 / a) / (1 + scaled * math.sqrt(2 / (a - 4)))) ** (1 / 3)) / math.sqrt(2 / (9 * a))


def test_normality_statistic_at_published_values(spark):
    # the kurtosis part of 0..19 is -1.70581, its skewness is 0; the skewness part of the second is 0.446264
    for values, skew_part in ((list(range(20)), 0.0), ([2, 8, 0, 4, 1, 9, 9, 0], 0.44626385374196975)):
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        row = profile.normal_test(df, ["x"]).first()
        z = kurtosis_z(np.array(values, dtype=float))
        assert abs(row["statistic"] - z * z - skew_part ** 2) < 1e-6
        assert abs(row["p_value"] - math.exp(-row["statistic"] / 2)) < 1e-9
    assert abs(kurtosis_z(np.arange(20.0)) + 1.7058104152122062) < 1e-9
