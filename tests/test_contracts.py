"""Errors and warnings where a row or a solution would go wrong unnoticed, and wide grouped predictions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.models import grouped, robust, solve
from gablework.operators.transformers import LogZScore
from gablework.plans import presets
from gablework.plans.target import TargetTransform


@pytest.mark.parametrize("bad", [0.0, -1.0])
def test_logs_of_zero_and_below_are_errors(spark, bad):
    good = spark.createDataFrame([(1.0,), (2.0,), (None,), (8.0,)], "y double")
    spoiled = good.union(spark.createDataFrame([(bad,)], "y double"))
    for learner, what in ((TargetTransform("y"), "the target"), (LogZScore(["y"]), "y")):
        with pytest.raises(Exception, match=f"no logarithm of {what}: {bad}"):
            learner.fit(spoiled)
        model = learner.fit(good)
        with pytest.raises(Exception, match=f"no logarithm of {what}"):
            model.transform(spoiled).collect()
        assert [r["y"] is None for r in model.transform(good).collect()] == [False, False, True, False]


def test_solvers_tell_when_they_stop_early(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 6)) @ rng.normal(size=(6, 6))
    z = np.column_stack([np.ones(200), x, x @ np.arange(6.0) + rng.normal(size=200)])
    with pytest.warns(UserWarning, match="did not converge in 1 sweeps"):
        solve.elastic_net(z.T @ z, 0.01, 0.5, sweeps=1)
    df = spark.createDataFrame(z[:, 1:].tolist(), [f"x{i}" for i in range(6)] + ["y"])
    with pytest.warns(UserWarning, match="did not converge in 1 iterations"):
        robust.Huber(max_iter=1).fit(df, [f"x{i}" for i in range(6)], "y")


def test_grouped_predictions_of_many_features(spark):
    rng = np.random.default_rng(3)
    names, n = [f"x{i}" for i in range(60)], 400
    x, g = rng.normal(size=(n, 60)), np.arange(n) % 2
    y = x @ np.arange(60.0) * (1 + g) + g
    df = spark.createDataFrame([(int(k), *map(float, r), float(v)) for k, r, v in zip(g, x, y)],
                               ["g", *names, "y"])
    out = grouped.fit_by_group(df, "g", names, "y").transform(
        df.unionByName(df.limit(1).withColumn("g", F.lit(9).cast("long"))).unionByName(
            df.limit(1).withColumn("x7", F.lit(None).cast("double"))))
    rows = out.collect()
    known = [r for r in rows if r["g"] != 9 and r["x7"] is not None]
    assert len(known) == n and all(r["prediction"] == pytest.approx(r["y"], abs=1e-6) for r in known)
    assert [r["prediction"] for r in rows if r["g"] == 9 or r["x7"] is None] == [None, None]


def test_the_tree_preset_closes_with_a_robust_scale():
    assert presets.tree_plan()["final"] == "robust" == presets.linear2_plan()["final"]
