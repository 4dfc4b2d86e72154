from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gablework import sources
from gablework.catalog.models import model_round_trip, regressor
from gablework.models.linear import ElasticNet, Lasso, Ridge
from gablework.models.trees import Boosted, Tree
from gablework.operators import match, transformers as T
from gablework.plans import ensemble, presets, regressor as regressor_module
from gablework.plans.cleaning import CleaningRules
from gablework.plans.features import FeaturePlan, block
from gablework.plans.regressor import TabularRegressor, predict_beside
from gablework.plans.target import TargetTransform
from gablework.session import fresh_path, shared_folder
from gablework.stage import unique


# --- stored models ---

def test_stored_regressor_holds_its_look_up(t, tmp_path):
    """A stored model with group values outlives the scratch folder of the session that fitted it."""
    from gablework.session import delete_path

    plan = FeaturePlan([block("a", ["liv_area"], scale=["standard"]), block("b", ["zoning"], fill="None", one_hot=True)])
    fitted = TabularRegressor(Ridge(1.0), plan, "sale_price", keep=["id"], cleaning=CleaningRules(
        group="neighborhood", target="sale_price", modes=["zoning"])).fit(t)
    rows = t.withColumn("zoning", F.when(F.col("id") % 3 > 0, F.col("zoning"))).drop("sale_price")
    before = [tuple(r) for r in fitted.transform(rows).select("id", "prediction").orderBy("id").collect()]
    path = str(tmp_path / "regressor")
    sources.save_model(fitted, path)
    delete_path(t.sparkSession, fitted.stages[0].frozen()["path"])
    again = sources.load_model(path)
    assert again.stages[0].frozen()["path"].startswith(path)
    assert [tuple(r) for r in again.transform(rows).select("id", "prediction").orderBy("id").collect()] == before
    second = str(tmp_path / "second")
    sources.save_model(again, second)
    assert sources.load_model(second).stages[0].frozen()["path"].startswith(second)
    assert CleaningRules(powers={"x": ("liv_area", 2)}).fit(t).frozen() is None


# --- transformers ------------------------------------------------------------

def test_scaling(t, pdf):
    out = T.StandardScale(["liv_area"]).fit(t).transform(t).agg(F.avg("liv_area"), F.stddev_pop("liv_area")).first()
    np.testing.assert_allclose(out, [0, 1], atol=1e-9)
    fit = T.YeoJohnson(["sale_price"], standardize=True).fit(t)
    out = fit.transform(t).agg(F.avg("sale_price"), F.stddev_pop("sale_price"), F.skewness("sale_price")).first()
    np.testing.assert_allclose(out[:2], [0, 1], atol=1e-9)
    assert abs(out[2]) < abs(pdf["sale_price"].skew())
    for learner in (T.StandardScale(["sale_price"]), T.RobustScale(["sale_price"]), T.LogZScore(["sale_price"]),
                    T.YeoJohnson(["sale_price"], standardize=True)):
        fit = learner.fit(t)
        back = fit.inverse(fit.transform(t.withColumn("before", F.col("sale_price"))))
        assert back.where("abs(before - sale_price) > 1e-6 * before").count() == 0


def test_one_hot_errors_on_unseen_levels(spark):
    seen = spark.createDataFrame([("a", 3), ("b", 1)], "s string, k int")
    fit = T.OneHot(["s", "k"]).fit(seen)
    assert fit.transform(seen).columns == ["s_b", "k_3"]
    for bad in [("c", 1), (None, 1), ("a", 2)]:
        new = spark.createDataFrame([bad], "s string, k int")
        with pytest.raises(Exception, match="unseen level"):
            fit.transform(new).collect()
    ignoring = T.OneHot(["s"], drop=None, unseen="ignore").fit(seen)
    new = spark.createDataFrame([("c", 1), (None, 1)], "s string, k int")
    assert {tuple(r)[1:] for r in ignoring.transform(new).collect()} == {(0, 0)}


def test_too_many_levels(spark):
    with pytest.raises(ValueError, match="levels"):
        T.OneHot(["id"], most_levels=5).fit(spark.range(10))


def test_dummies_equal_pandas(t, pdf):
    narrow = ["id", "zoning", "qual"]
    ours = T.get_dummies(t.select(narrow)).toPandas().set_index("id").sort_index()
    theirs = pd.get_dummies(pdf[narrow]).set_index("id").astype(int)
    assert ours[sorted(ours)].equals(theirs[sorted(theirs)].astype(ours.dtypes.iloc[0]))


# --- plans -------------------------------------------------------------------

def test_plan_drops_unlisted_and_keeps_keys(t):
    plan = FeaturePlan([block("a", ["liv_area"], scale=["yeo_johnson", "robust"]),
                        block("b", ["zoning"], fill="None", one_hot=True)], keep=["id"])
    model = plan.fit(t)
    wide = model.transform(t)
    assert wide.columns == ["id", *model.feature_names]
    q = wide.selectExpr("percentile(liv_area, array(0.25, 0.5, 0.75)) q").first()["q"]
    np.testing.assert_allclose([q[1], q[2] - q[0]], [0, 1], atol=1e-9)


def test_plan_final_scaling(t):
    plan = FeaturePlan([block("a", ["liv_area", "fl1_sf"], scale=["standard"]), block("b", ["full_bath"])],
                       final="robust")
    q = plan.fit(t).transform(t).selectExpr("percentile(full_bath, array(0.25, 0.5, 0.75)) q").first()["q"]
    assert q[1] == 0 and q[2] - q[0] == 1


def test_plan_refuses_double_columns():
    with pytest.raises(ValueError, match="two blocks"):
        FeaturePlan([block("a", ["x"]), block("b", ["x"])])
    with pytest.warns(UserWarning, match="repeated"):
        assert block("a", ["x", "x"])["columns"] == ["x"]
    with pytest.warns(UserWarning):
        unique(["a", "a"])


@pytest.mark.parametrize("steps", [("log", "standard"), ("log", "yeo_johnson", "robust"), ("yeo_johnson", "standard")])
def test_target_chain_inverts(t, steps):
    chain = TargetTransform("sale_price", steps).fit(t)
    y = F.col("sale_price")
    assert t.where(F.abs(chain.inverse(chain.forward(y)) - y) > 1e-6 * y).count() == 0


# --- regressors --------------------------------------------------------------

@pytest.fixture(scope="module")
def split(t):
    return t.where("id % 4 <> 0"), t.where("id % 4 = 0")


def test_regressor(split, spark):
    train, test = split
    r = regressor(presets.elastic())
    with pytest.raises(ValueError, match="fit"):
        r.predict(test)
    model = r.fit(train)
    assert r.score(train)["r2"] > 0.5 and 0 < r.score(test)["msle"] < 0.5
    out = r.predict(test.drop("sale_price"))
    assert out.columns == ["id", "prediction"] and out.count() == test.count()
    path = fresh_path(spark, "model")
    sources.save_model(model, path)
    again = sources.load_model(path)
    both = predict_beside(again, predict_beside(model, test, "a"), "b")
    assert both.count() == test.count() and both.where("a <> b or a is null").count() == 0
    assert set(test.columns) < set(both.columns)


def test_round_trip_query(spark):
    """It called a helper by a module that no longer had it."""
    own = spark.range(240).selectExpr(
        "id", "concat('N', id % 4) neighborhood", "IF(id % 11 = 0, NULL, concat('Z', id % 3)) zoning",
        "IF(id % 19 = 0, NULL, concat('E', id % 2)) electrical", "IF(id % 3 = 0, 'N', 'Y') central_air",
        "element_at(array('Ex', 'Gd', 'TA', 'Fa', 'Po', NULL), cast(id % 6 AS int) + 1) qual", "1 + id % 7 overall_qual",
        "IF(id % 29 = 0, NULL, 1 + id % 9) overall_cond", "IF(id % 7 = 0, NULL, 10 * (1 + id % 5)) frontage",
        "10.0D + id * 37 % 101 liv_area", "IF(id % 23 = 0, NULL, cast(id % 13 AS double)) bsmt_sf",
        "cast(id % 17 AS double) fl1_sf", "cast(id % 4 AS double) fl2_sf", "id % 3 full_bath", "id % 2 half_bath",
        "IF(id % 17 = 0, NULL, cast(1992 + id % 7 AS int)) garage_yr", "cast(1990 + id % 8 AS int) yr_built",
        "cast(1993 + id % 9 AS int) yr_remod", "cast(1 + id % 12 AS int) mo_sold", "cast(1994 + id % 8 AS int) yr_sold",
        "500.0D + 40 * (id * 37 % 101) + 100 * (id % 7) sale_price")
    rows = model_round_trip(own).collect()
    assert sorted(r["id"] for r in rows) == list(range(0, 240, 4)) and all(r["same"] is True for r in rows)


def test_tree_regressor_round_trip(split, spark):
    train, test = split
    r = regressor(Boosted(n_trees=5, rate=0.3))
    model = r.fit(train)
    assert r.score(train)["r2"] > 0.3
    path = fresh_path(spark, "trees")
    sources.save_model(model, path)
    both = predict_beside(sources.load_model(path), predict_beside(model, test, "a"), "b")
    assert both.where("a <> b").count() == 0


@pytest.mark.parametrize("refit", [True, False])
def test_search_regressor(split, refit):
    from gablework.validation import folds, search

    train = folds.with_folds(split[0], 3, "id", seed=1)
    grid = [ElasticNet(0.001, 0.5), ElasticNet(5.0, 0.5)]
    r = regressor(None)
    with pytest.raises(ValueError, match="search"):
        r.best_score
    r.search(train, grid, "fold", refit_plan=refit)
    assert r.learner == r.best_learner == grid[0] and -1.0 < r.best_score < 0.0
    if refit:
        best, score, _ = search.search_regressor(regressor(None), train, [Tree(2), Tree(6)], "fold", scoring="r2")
        assert score > 0.3


def test_stack(split):
    train, test = split
    plan = FeaturePlan([block("a", ["liv_area"], scale=["standard"])])
    bases = [regressor(Ridge(5.0)), regressor(ElasticNet(0.01, 0.5))]
    stack = ensemble.Stack(bases, Lasso(0.001), plan, "sale_price", "id", k=3)
    with stack.out_of_fold(train) as table:
        assert table.count() == train.count() and table.where("base_0 is null or base_1 is null").count() == 0
        # rows of a fold are scored by the model fitted without them
        f = 1
        held = table.where(F.col("_fold") == f).select("id", "base_0")
        other = predict_beside(stack.fold_models[f][0], train, "p").select("id", "p")
        assert held.join(other, "id").where("abs(base_0 - p) > 1e-9 * p").count() == 0
        stack.fit(train, table)
        r2 = stack.sweep(train, [Lasso(a) for a in (0.0001, 0.1, 10.0)], table)
    assert r2[0] >= r2[1] >= r2[2]
    out = stack.predict(test.drop("sale_price"))
    assert out.count() == test.count() and out.where("prediction is null or prediction <= 0").count() == 0


def test_stack_prepares_rows_once_for_all_bases_of_a_fold(split, monkeypatch):
    """Cleaning and plan were gone through once per base and fold, in methods too long to be compiled."""
    from gablework.plans.cleaning import CleaningModel

    train, test = split
    spark = train.sparkSession
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    spark.conf.unset(limit)
    plan = FeaturePlan([block("a", ["liv_area"], scale=["standard"])])
    bases = [regressor(Ridge(5.0)), regressor(Tree(2)), regressor(ElasticNet(0.01, 0.5))]
    other_plan = TabularRegressor(Ridge(1.0), FeaturePlan([block("b", ["overall_qual"])]), "sale_price",
                                  CleaningRules(powers={"square": ("liv_area", 2)}), keep=["id"])
    stack = ensemble.Stack([*bases, other_plan], Ridge(1.0), plan, "sale_price", "id", k=2)
    stack.fit(train)
    cleaned = []
    transform = CleaningModel._transform
    monkeypatch.setattr(CleaningModel, "_transform", lambda self, df: cleaned.append(self) or transform(self, df))
    out = stack.predict(test.drop("sale_price"))
    assert len(cleaned) == 2 * 2  # folds times different preparations, not times bases
    assert int(spark.conf.get(limit)) <= 8000
    assert out.count() == test.count() and out.where("prediction is null").count() == 0
    spark.conf.set(limit, before)
    names = ["p0", "p1", "p2", "p3"]
    together = regressor_module.predict_all_beside(stack.fold_models[0], test, names, ["prediction"] * 4)
    assert together.columns == [*test.columns, *names]
    for name, model in zip(names, stack.fold_models[0]):
        alone = predict_beside(model, test, "alone").select("id", "alone")
        assert together.join(alone, "id").where(f"abs({name} - alone) > 1e-9 * alone").count() == 0


def test_presets_on_a_house_table(spark):
    """Every preset fits and predicts a table with the house-price columns."""
    rng = np.random.default_rng(5)
    n = 120
    letters = ["Ex", "Gd", "TA", "Fa", "Po", None]
    frame = {c: rng.choice(letters, n) for c in presets.GRADED}
    for c in [*presets.CATEGORIES, "MSZoning", "Utilities", "Electrical", "Functional", "CentralAir", "Exterior1st",
              "Exterior2nd", "SaleType", "MiscFeature", "Alley", "Condition2"]:
        frame[c] = rng.choice(["A", "B", "C", None], n)
    made = {"scaledOverallQual", "SF", "numBaths", "bsmtBaths", "squareMo", "quadMo", "hexMo", "garageDiff", "remodDiff"}
    numeric = [*presets.AREAS, *presets.COUNTS, *presets.TREE_AREAS, "LotArea", "MSSubClass", "MoSold", "YearBuilt"]
    for c in numeric:
        if c not in made:
            frame[c] = rng.integers(1, 9, n)
    frame["Id"], frame["SalePrice"] = np.arange(n), 1000.0 * frame["OverallQual"] + 100 * rng.random(n) + 500
    df = spark.createDataFrame(pd.DataFrame(frame)).cache()
    for cleaning, plan, learner in (
            (presets.house_cleaning(), presets.linear_plan(), presets.elastic()),
            (presets.house_cleaning(), presets.linear2_plan(), presets.ridge()),
            (presets.tree_cleaning(), presets.tree_plan(), presets.leafwise(n_trees=2)),
            (presets.house_cleaning(), presets.meta_plan(), presets.fourier())):
        r = TabularRegressor(learner, plan, "SalePrice", cleaning, keep=["Id"])
        r.fit(df)
        assert r.predict(df).where("prediction is not null").count() == n
    assert len(presets.lineup()) == 5


# --- sources and matching ----------------------------------------------------

def test_csv_missing_texts(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Id,Price,Kind\n1,2.5,NA\n2,NaN,x\n3,,None\n")
    for schema in ("Id bigint, Price double, Kind string", None):
        rows = sources.load_table(spark, str(path), schema=schema).orderBy("Id").collect()
        assert [r["Price"] for r in rows] == [2.5, None, None]
        assert [r["Kind"] for r in rows] == [None, "x", None]


def test_csv_with_a_wrong_value_raises(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Id,Price\n1,many\n")
    with pytest.raises(Exception):
        sources.load_table(spark, str(path), schema="Id bigint, Price double").collect()


def test_predictions_are_not_overwritten(spark, t, tmp_path):
    path = str(tmp_path / "out")
    sources.write_predictions(t, path, "id", "sale_price", header=("Id", "SalePrice"))
    assert sources.load_table(spark, path, "Id bigint, SalePrice double").count() == t.count()
    with pytest.raises(Exception):
        sources.write_predictions(t, path, "id", "sale_price")


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_match_sources_equals_pandas_merge(spark):
    a = pd.DataFrame({"k": [1.0, 1.0, 2.0, None, 5.0], "m": [1, 1, 2, 3, 5], "v": [10, 11, 12, 13, 14]})
    b = pd.DataFrame({"k": [1.0, 2.0, 2.0, None, 9.0], "m": [1, 2, 2, 3, 9], "v": [20, 21, 22, 23, 24], "w": list("abcde")})
    ours = match.match_sources(*[spark.createDataFrame(x.astype(object).where(x.notna(), None).values.tolist(), s)
                                 for x, s in ((a, "k double, m bigint, v bigint"),
                                              (b, "k double, m bigint, v bigint, w string"))], ["k", "m"])
    theirs = pd.merge(a, b, how="outer", on=["k", "m"])
    assert ours.columns == list(theirs.columns)
    clean = [tuple(None if pd.isna(v) else v for v in r) for r in theirs.itertuples(index=False)]
    assert sorted(map(repr, [tuple(map(_num, r)) for r in ours.collect()])) == sorted(
        map(repr, [tuple(map(_num, r)) for r in clean]))


def _num(v):
    return float(v) if isinstance(v, (int, float)) else v


def test_union_split_returns_the_parts(t):
    a, b = match.union_split(t.where("id < 100"), t.where("id >= 100"), lambda df: df)
    assert a.count() + b.count() == t.count() and a.columns == t.columns
