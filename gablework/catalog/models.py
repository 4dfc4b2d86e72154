"""Models, validation and ensembles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..models import boosting, grouped, kernel, linear, robust, trees
from ..models.linear import Lasso, Linear
from ..operators import missing
from ..operators.sparse import SparseOneHot
from ..plans import ensemble, presets
from ..plans.cleaning import CleaningRules
from ..plans.features import FeaturePlan, block
from ..plans.regressor import TabularRegressor, predict_beside
from ..session import fresh_path, small_frame
from ..sources import load_model, save_model
from ..validation import compare, folds, scores, search
from .prepare import LISTING_RULES
from .profile import rounded
from .registry import query

Y = "sale_price"
TWO = ["liv_area", "overall_qual"]
COMPLETE = ["overall_qual", "liv_area", "fl1_sf", "fl2_sf", "full_bath", "half_bath", "yr_built", "yr_remod",
            "mo_sold"]
# Centered sums of two features and the target, over all rows.
S2 = """
, m AS (SELECT count(*) AS n, avg(liv_area) AS m1, avg(overall_qual) AS m2, avg(sale_price) AS my,
    covar_pop(liv_area, liv_area) AS s11, covar_pop(overall_qual, overall_qual) AS s22,
    covar_pop(liv_area, overall_qual) AS s12, covar_pop(liv_area, sale_price) AS s1y,
    covar_pop(overall_qual, sale_price) AS s2y FROM listings)
"""


def coefficients(t: DataFrame, fit: linear.LinearFit, digits: int = 2) -> DataFrame:
    rows = [("intercept", fit.intercept), *fit.slopes.items()]
    return rounded(small_frame(t.sparkSession, rows, "term string, value double"), digits, "value")


def _terms(intercept: str, first: str, second: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{term}' AS term, round({value}, 2) AS value FROM {source}"
        for term, value in (("intercept", intercept), ("liv_area", first), ("overall_qual", second)))


# --- linear models -----------------------------------------------------------

@query(S2 + """
, b AS (SELECT (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
               (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM m)
""" + _terms("my - b1 * m1 - b2 * m2", "b1", "b2", "b"))
def linear_fit(t: DataFrame) -> DataFrame:
    return coefficients(t, linear.fit_linear(t, TWO, Y))


@query(S2 + """
, p AS (SELECT *, s11 + 5000.0::double / n AS r11, s22 + 5000.0::double / n AS r22 FROM m)
, b AS (SELECT (s1y * r22 - s2y * s12) / (r11 * r22 - s12 * s12) AS b1,
               (s2y * r11 - s1y * s12) / (r11 * r22 - s12 * s12) AS b2, m1, m2, my FROM p)
""" + _terms("my - b1 * m1 - b2 * m2", "b1", "b2", "b"))
def ridge_fit(t: DataFrame) -> DataFrame:
    return coefficients(t, linear.fit_ridge(t, TWO, Y, alpha=5000.0))


# Coordinate descent on the two-feature sums; the number of sweeps is far beyond need.
DESCENT = """
, descent(k, b1, b2) AS (
  SELECT 0, 0.0::double, 0.0::double
  UNION ALL
  SELECT k + 1, n1, sign(s2y - s12 * n1) * greatest(abs(s2y - s12 * n1) - {l1}, 0) / (s22 + {l2})
  FROM (SELECT k, b2, m.*, sign(s1y - s12 * b2) * greatest(abs(s1y - s12 * b2) - {l1}, 0) / (s11 + {l2}) AS n1
        FROM descent, m) WHERE k < 600)
, b AS (SELECT b1, b2, m1, m2, my FROM descent, m WHERE k = 600)
"""


def _descent(alpha: float, l1_ratio: float) -> str:
    # "RECURSIVE" belongs to the WITH that opens the text
    return S2 + DESCENT.format(l1=f"{alpha * l1_ratio!r}::double", l2=f"{alpha * (1 - l1_ratio)!r}::double")


@query(_descent(4.0, 0.25) + _terms("my - b1 * m1 - b2 * m2", "b1", "b2", "b"), recursive=True)
def elastic_net(t: DataFrame) -> DataFrame:
    return coefficients(t, linear.fit_elastic(t, TWO, Y, alpha=4.0, l1_ratio=0.25))


@query(_descent(20000.0, 1.0) + _terms("my - b1 * m1 - b2 * m2", "b1", "b2", "b"), recursive=True)
def lasso_fit(t: DataFrame) -> DataFrame:
    return coefficients(t, linear.fit_lasso(t, TWO, Y, alpha=20000.0))


@query("SELECT id, round(avg(sale_price) OVER (PARTITION BY id % 1500), 2) AS prediction FROM listings")
def linear_wide(t: DataFrame) -> DataFrame:
    """Least squares on 1,500 levels, which gives the mean of each."""
    encoder = SparseOneHot(["level"]).fit(with_level := t.select("id", Y, (F.col("id") % 1500).alias("level")))
    fit = linear.Linear().fit_entries(hot := encoder.transform(with_level), "entries", encoder.width, Y)
    # to six digits first, below which lies the solver's tolerance: some means end in exactly half a cent
    return rounded(rounded(fit.transform(hot).select("id", "prediction"), 6, "prediction"), 2, "prediction")


@query("""
, levels AS (SELECT id, sale_price, id // 8 AS level FROM listings),
means AS (SELECT level, count(*) AS n, avg(sale_price) AS m FROM levels GROUP BY level),
center AS (SELECT sum(m * n / (n + 3.0)) / sum(n / (n + 3.0)) AS b FROM means)
SELECT id, round(b + n / (n + 3.0) * (m - b), 1) AS prediction FROM levels JOIN means USING (level), center""")
def ridge_levels(t: DataFrame) -> DataFrame:
    """Ridge on a level per few rows, far more columns than a matrix could hold: means drawn to one center."""
    encoder = SparseOneHot(["level"], drop=None).fit(
        with_level := t.select("id", Y, F.expr("id div 8").alias("level")))
    fit = linear.Ridge(3.0).fit_entries(hot := encoder.transform(with_level), "entries", encoder.width, Y)
    return rounded(fit.transform(hot).select("id", "prediction"), 1, "prediction")


@query()
def huber_fit(t: DataFrame) -> DataFrame:
    return coefficients(t, robust.fit_huber(t, TWO, Y, epsilon=1.35, alpha=0.0001))


# --- trees and kernels: trees are fewer than in the presets, to keep checks short, but for gbt_leafwise ----

def predicted(t: DataFrame, model) -> DataFrame:
    return model.transform(t).select("id", "prediction")


@query()
def gbt_fit(t: DataFrame) -> DataFrame:
    return predicted(t, presets.boosted(n_trees=30, rate=0.2).fit(t, COMPLETE, Y, key="id"))


@query()
def gbt_leafwise(t: DataFrame) -> DataFrame:
    return predicted(t, presets.leafwise().fit(t, COMPLETE, Y, key="id"))


@query()
def gbt_many_shallow(t: DataFrame) -> DataFrame:
    return predicted(t, presets.many_shallow(n_trees=20).fit(t, COMPLETE, Y))


@query()
def forest_fit(t: DataFrame) -> DataFrame:
    return predicted(t, trees.fit_forest(t, COMPLETE, Y, n_trees=20, depth=6))


@query()
def tree_fit(t: DataFrame) -> DataFrame:
    return predicted(t, trees.fit_tree(t, COMPLETE, Y, depth=6))


# The best single cut of one feature, from sums per value.
STUMP = """
, cells AS (SELECT overall_qual AS x, count(*)::double AS n, sum(sale_price) AS s FROM listings GROUP BY 1)
, {name}_cuts AS (
  SELECT a.x AS cut, sum(b.n) FILTER (b.x <= a.x) AS nl, sum({s}) FILTER (b.x <= a.x) AS sl,
    sum(b.n) FILTER (b.x > a.x) AS nr, sum({s}) FILTER (b.x > a.x) AS sr FROM cells a, {source} b GROUP BY a.x)
, {name} AS (SELECT cut, sl / nl AS lo, sr / nr AS hi FROM {name}_cuts WHERE nr > 0
          ORDER BY sl * sl / nl + sr * sr / nr DESC LIMIT 1)
"""
FIRST_STUMP = STUMP.format(name="first", s="b.s", source="cells")


@query(FIRST_STUMP + """
SELECT id, round(CASE WHEN overall_qual <= cut THEN lo ELSE hi END, 3) AS prediction FROM listings, first""")
def tree_stump(t: DataFrame) -> DataFrame:
    return rounded(predicted(t, trees.fit_tree(t, ["overall_qual"], Y, depth=1)), 3, "prediction")


# The second tree is fitted to the slope of the squared error, twice the residual.
@query(FIRST_STUMP + """
, rest AS (SELECT x, n, 2 * (s - n * CASE WHEN x <= cut THEN lo ELSE hi END) AS s FROM cells, first)
""" + STUMP.split("\n", 2)[2].format(name="second", s="b.s", source="rest") + """
SELECT id, round(CASE WHEN overall_qual <= f.cut THEN f.lo ELSE f.hi END
  + 0.25::double * CASE WHEN overall_qual <= g.cut THEN g.lo ELSE g.hi END, 3) AS prediction
FROM listings, first f, second g""")
def gbt_stumps(t: DataFrame) -> DataFrame:
    fit = trees.fit_gbt(t, ["overall_qual"], Y, n_trees=2, rate=0.25, depth=1)
    return rounded(predicted(t, fit), 3, "prediction")


# --- histogram boosting: Huber loss, best-first leaves, dropped trees; one feature, so that SQL can follow ------------

# One round: residuals of {before}, their clipped gradients, the best cut of one feature, a value for each side.
HUBER_ROUND = """
, r{k} AS (SELECT id, x, y - f AS r FROM {before})
, d{k} AS (SELECT quantile_cont(abs(r), 0.9) AS d FROM r{k})
, c{k} AS (SELECT x, count(*)::double AS n, sum(greatest(least(r, d), -d)) AS s FROM r{k}, d{k} GROUP BY x)
, o{k} AS (SELECT a.x AS cut, sum(b.n) FILTER (b.x <= a.x) AS nl, sum(b.s) FILTER (b.x <= a.x) AS sl,
    sum(b.n) FILTER (b.x > a.x) AS nr, sum(b.s) FILTER (b.x > a.x) AS sr FROM c{k} a, c{k} b GROUP BY a.x)
, b{k} AS (SELECT cut FROM o{k} WHERE nr > 0 ORDER BY sl * sl / nl + sr * sr / nr DESC LIMIT 1)
, m{k} AS (SELECT x <= cut AS low, median(r) AS m FROM r{k}, b{k} GROUP BY 1)
, v{k} AS (SELECT low, m + avg(greatest(least(r - m, d), -d)) AS v
    FROM r{k}, b{k}, d{k}, m{k} WHERE (x <= cut) = low GROUP BY low, m)
, f{k} AS (SELECT p.id, p.x, p.y, p.f + 0.25::double * v AS f FROM {before} p, b{k}, v{k} WHERE (p.x <= cut) = low)
"""


@query("""
, f0 AS (SELECT id, overall_qual AS x, sale_price AS y, median(sale_price) OVER () AS f FROM listings)
""" + HUBER_ROUND.format(k=1, before="f0") + HUBER_ROUND.format(k=2, before="f1")
       + "SELECT id, round(f, 3) AS prediction FROM f2")
def gbt_huber(t: DataFrame) -> DataFrame:
    fit = boosting.fit_boosting(t, ["overall_qual"], Y, n_trees=2, rate=0.25, depth=1, loss="huber")
    return rounded(predicted(t, fit), 3, "prediction")


# Strength of a side: its sum shrunk by l1, squared, over its count plus l2.
LEAF_STRENGTH = "power(greatest(abs({s}) - 40000000, 0), 2) / ({n} + 500)"
LEAF_CUTS = """
, {name} AS (
  SELECT *, {left} + {right} - {whole} AS gain FROM (
    SELECT {of} a.x AS cut, sum(b.n) FILTER (b.x <= a.x) AS nl, sum(b.s) FILTER (b.x <= a.x) AS sl,
      sum(b.n) FILTER (b.x > a.x) AS nr, sum(b.s) FILTER (b.x > a.x) AS sr, sum(b.n) AS n, sum(b.s) AS s
    FROM {source} a JOIN {source} b ON {same} GROUP BY ALL) WHERE nr > 0 ORDER BY gain DESC LIMIT 1)
"""
_STRENGTHS = {side: LEAF_STRENGTH.format(s=s, n=n) for side, s, n in (("left", "sl", "nl"), ("right", "sr", "nr"), ("whole", "s", "n"))}


@query("""
, p AS (SELECT id, overall_qual AS x, sale_price - avg(sale_price) OVER () AS r, avg(sale_price) OVER () AS f FROM listings)
, c AS (SELECT x, count(*)::double AS n, sum(r) AS s FROM p GROUP BY x)
""" + LEAF_CUTS.format(name="one", of="", source="c", same="true", **_STRENGTHS)
       + ", sided AS (SELECT c.*, x <= cut AS low FROM c, one)\n"
       + LEAF_CUTS.format(name="two", of="a.low,", source="sided", same="a.low = b.low", **_STRENGTHS) + """
, leafed AS (SELECT p.*, (x <= one.cut)::int * 2 + (x <= two.cut AND (x <= one.cut) = two.low)::int AS leaf FROM p, one, two)
, leaves AS (SELECT leaf, sign(sum(r)) * greatest(abs(sum(r)) - 40000000, 0) / (count(*) + 500) AS v FROM leafed GROUP BY leaf)
SELECT id, round(f + 0.5::double * v, 3) AS prediction FROM leafed JOIN leaves USING (leaf)""")
def gbt_three_leaves(t: DataFrame) -> DataFrame:
    """Best-first growth to three leaves, with penalties large enough to change cuts and values."""
    fit = boosting.fit_boosting(t, ["overall_qual"], Y, n_trees=1, rate=0.5, depth=None, leaves=3, l1=4e7, l2=500.0)
    return rounded(predicted(t, fit), 3, "prediction")


# Every earlier tree is dropped in every round, so each tree is fitted to the same residuals and k trees weigh 1/k each.
@query(FIRST_STUMP + """
, base AS (SELECT avg(sale_price) AS f FROM listings)
SELECT id, round(f + 0.5::double * (CASE WHEN overall_qual <= cut THEN lo ELSE hi END - f), 3) AS prediction
FROM listings, first, base""")
def gbt_dart(t: DataFrame) -> DataFrame:
    fit = boosting.fit_boosting(t, ["overall_qual"], Y, n_trees=3, rate=0.5, depth=1, drop=1.0, skip_drop=0.0)
    return rounded(predicted(t, fit), 3, "prediction")


@query()
def gbt_dart_leaves(t: DataFrame) -> DataFrame:
    return predicted(t, presets.dart(n_trees=20).fit(t, COMPLETE, Y, key="id"))


@query()
def rbf_fit(t: DataFrame) -> DataFrame:
    from ..operators.transformers import StandardScale

    scaled = StandardScale(COMPLETE).fit(t).transform(t.select("id", *COMPLETE, Y))
    return predicted(scaled, kernel.fit_rbf(scaled, COMPLETE, Y, gamma="scale", n_features=100, alpha=1.0))


# --- one model per group -----------------------------------------------------

GROUP_SQL = """
, g AS (SELECT neighborhood, avg(liv_area) AS m1, avg(sale_price) AS my, covar_pop(liv_area, liv_area) AS s11,
          covar_pop(liv_area, sale_price) AS s1y,
          CASE WHEN neighborhood = 'NATION_7' THEN 50.0 ELSE 10.0 END::double AS alpha,
          CASE WHEN neighborhood = 'NATION_7' THEN 0.5 ELSE 0.05 END::double AS l1
        FROM listings GROUP BY neighborhood)
, c AS (SELECT neighborhood, sign(s1y) * greatest(abs(s1y) - alpha * l1, 0) / (s11 + alpha * (1 - l1)) AS slope, m1, my
        FROM g)
"""


def _group_models(t: DataFrame) -> grouped.GroupedFit:
    return grouped.fit_by_group(t, "neighborhood", ["liv_area"], Y, params={"NATION_7": (50.0, 0.5)},
                                default=(10.0, 0.05))


@query(GROUP_SQL + "SELECT neighborhood, round(my - slope * m1, 3) AS intercept, round(slope, 4) AS liv_area FROM c")
def group_models(t: DataFrame) -> DataFrame:
    return rounded(rounded(_group_models(t).coefficients(t.sparkSession), 3, "intercept"), 4, "liv_area")


@query(GROUP_SQL + """
SELECT id, neighborhood, round(my - slope * m1 + slope * liv_area, 3) AS prediction
FROM listings JOIN c USING (neighborhood)""")
def group_predict(t: DataFrame) -> DataFrame:
    fitted = _group_models(t).transform(t.select("id", "neighborhood", "liv_area"))
    return rounded(fitted, 3, "prediction").select("id", "neighborhood", "prediction")


# --- the whole chain ---------------------------------------------------------

RULES = {k: v for k, v in LISTING_RULES.items() if k != "recode"}


def regressor(learner, keep=("id",)) -> TabularRegressor:
    plan = FeaturePlan([
        block("categories", ["neighborhood", "zoning", "electrical"], fill="None", one_hot=True, unseen="ignore"),
        block("areas", ["liv_area", "sf", "frontage", "overall_qual"], fill=0, scale=["yeo_johnson", "robust"]),
        block("differences", ["garage_diff", "remod_diff"], fill=0, scale=["standard"]),
        block("flags", ["central_air", "has_bsmt", "two_story", "new_house", "has_garage"]),
        block("counts", ["qual", "num_baths", "overall_cond"], fill=0),
    ])
    return TabularRegressor(learner, plan, Y, CleaningRules(**RULES), chain=("log", "standard"), keep=keep)


TRAIN, TEST = "id % 4 <> 0", "id % 4 = 0"


@query()
def predict_new(t: DataFrame) -> DataFrame:
    model = regressor(presets.elastic())
    model.fit(t.where(TRAIN))
    return model.predict(t.where(TEST).drop(Y))


@query("SELECT id, true AS same FROM listings WHERE id % 4 = 0")
def model_round_trip(t: DataFrame) -> DataFrame:
    """A stored model predicts what it predicted before."""
    before = regressor(presets.ridge()).fit(t.where(TRAIN))
    path = fresh_path(t.sparkSession, "model")
    save_model(before, path)
    after = load_model(path)
    test = t.where(TEST).drop(Y)
    both = predict_beside(after, predict_beside(before, test, "before"), "after")
    return both.select("id", (F.col("before") == F.col("after")).alias("same"))


# --- validation --------------------------------------------------------------

@query("SELECT cast(id % 5 AS int) AS fold, count(*) AS n_rows FROM listings GROUP BY 1")
def fold_counts(t: DataFrame) -> DataFrame:
    return folds.with_folds(t, 5, "id").groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"))


FOLD_FITS = """
, f AS (SELECT i AS fold, regr_slope(sale_price, liv_area) AS b, regr_intercept(sale_price, liv_area) AS a
        FROM listings, (SELECT unnest(range(5)) AS i) WHERE id % 5 <> i GROUP BY i)
"""


@query(FOLD_FITS + """
SELECT cast(fold AS int) AS fold, count(*) AS n, round(sqrt(avg(pow(sale_price - a - b * liv_area, 2))), 3) AS rmse
FROM listings JOIN f ON id % 5 = fold GROUP BY fold""")
def cv_rmse(t: DataFrame) -> DataFrame:
    return rounded(search.cv_rmse(folds.with_folds(t, 5, "id"), Linear(), ["liv_area"], Y), 3, "rmse")


# One feature: the elastic-net solution of every fold and grid point in closed form.
GRID_SQL = """
, grid AS (SELECT unnest([0.5, 5.0, 50.0, 500.0])::double AS alpha)
, ratios AS (SELECT unnest([0.1, 0.5, 1.0])::double AS l1_ratio)
, sums AS (SELECT {g}i AS fold, avg(liv_area) AS m1, avg(sale_price) AS my, covar_pop(liv_area, liv_area) AS s11,
             covar_pop(liv_area, sale_price) AS s1y
           FROM listings, (SELECT unnest(range(5)) AS i) WHERE id % 5 <> i GROUP BY {g}i)
, fits AS (SELECT {g}fold, alpha, l1_ratio, m1, my,
             sign(s1y) * greatest(abs(s1y) - alpha * l1_ratio, 0) / (s11 + alpha * (1 - l1_ratio)) AS b
           FROM sums, grid, ratios)
, errors AS (SELECT {g2}alpha, l1_ratio, fold, avg(pow(sale_price - my - b * (liv_area - m1), 2)) AS mse,
               1 - avg(pow(sale_price - my - b * (liv_area - m1), 2)) / var_pop(sale_price) AS r2
             FROM listings l JOIN fits f ON l.id % 5 = f.fold {on} GROUP BY {g2}alpha, l1_ratio, fold)
SELECT {g}alpha, l1_ratio, round(-avg(mse) / 1e6, 4) AS neg_mse, round(avg(r2), 6) AS r2
FROM errors GROUP BY {g}alpha, l1_ratio"""
ALPHAS, RATIOS = [0.5, 5.0, 50.0, 500.0], [0.1, 0.5, 1.0]


def _scores(table: DataFrame) -> DataFrame:
    return table.withColumns({"neg_mse": F.round(F.col("neg_mse") / 1e6, 4), "r2": F.round("r2", 6)})


@query(GRID_SQL.format(g="", g2="", on=""))
def grid_search(t: DataFrame) -> DataFrame:
    return _scores(search.grid_search(folds.with_folds(t, 5, "id"), ["liv_area"], Y, ALPHAS, RATIOS))


@query(GRID_SQL.format(g="neighborhood, ", g2="l.neighborhood, ", on="AND l.neighborhood = f.neighborhood"))
def group_grid_search(t: DataFrame) -> DataFrame:
    return _scores(search.grid_search(folds.with_folds(t, 5, "id"), ["liv_area"], Y, ALPHAS, RATIOS,
                                      group="neighborhood"))


@query()
def grid_search_best(t: DataFrame) -> DataFrame:
    """Best of 100 points over many features, by squared error and by R2."""
    table = search.grid_search(folds.with_folds(t, 5, "id", seed=6), COMPLETE, Y,
                               [10 ** (i / 3) for i in range(-3, 7)], [(i + 1) / 10 for i in range(10)])
    with_mse = search.best_points(table).withColumn("scoring", F.lit("neg_mse"))
    return with_mse.unionByName(search.best_points(table, scoring="r2").withColumn("scoring", F.lit("r2")))


@query()
def grid_search_trees(t: DataFrame) -> DataFrame:
    """Best depth of a tree by cross-validated R2, plan learned inside each fold."""
    folded = folds.with_folds(t, 3, "id")
    best, score, _ = search.search_regressor(
        regressor(None), folded, [trees.Tree(depth=d, leaf=10) for d in (3, 6)], "fold", scoring="r2")
    return small_frame(t.sparkSession, [(best.depth, score)], "depth int, r2 double")


PREDICTED = """
, line AS (SELECT regr_slope(sale_price, liv_area) AS b, regr_intercept(sale_price, liv_area) AS a FROM listings)
, p AS (SELECT id, neighborhood, sale_price AS y, abs(a + b * liv_area) + 1 AS p FROM listings, line)
"""


def _predicted(t: DataFrame) -> DataFrame:
    fit = linear.fit_linear(t, ["liv_area"], Y, prediction="_line")
    return fit.transform(t).withColumn("p", F.abs("_line") + 1)


@query(PREDICTED + """
SELECT count(y) AS n, round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(y)), 6) AS r2,
  round(sqrt(avg(pow(y - p, 2))), 3) AS rmse FROM p""")
def score_r2(t: DataFrame) -> DataFrame:
    return rounded(rounded(scores.score(_predicted(t), Y, "p"), 6, "r2"), 3, "rmse")


@query(PREDICTED + """
SELECT round(avg(pow(ln(y) - ln(p), 2)), 6) AS msle, round(sqrt(avg(pow(ln(y) - ln(p), 2))), 6) AS rmsle FROM p""")
def score_msle(t: DataFrame) -> DataFrame:
    return rounded(scores.score_logs(_predicted(t), Y, "p"), 6, "msle", "rmsle")


@query(PREDICTED + """
SELECT neighborhood, count(y) AS n, round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(y)), 6) AS r2,
  round(sqrt(avg(pow(y - p, 2))), 3) AS rmse FROM p GROUP BY neighborhood""")
def score_by_group(t: DataFrame) -> DataFrame:
    return rounded(rounded(scores.score(_predicted(t), Y, "p", "neighborhood"), 6, "r2"), 3, "rmse")


def _variants(t: DataFrame) -> tuple[DataFrame, dict]:
    """One table with the frontage filled both ways and a flag where it was missing."""
    fitted = missing.GroupModeImputer("neighborhood", ["frontage"]).fit(t)
    wide = fitted.transform(t.withColumns({"frontage_zero": F.coalesce("frontage", F.lit(0)),
                                           "null_frontage": F.col("frontage").isNull().cast("int")}))
    common = ["liv_area", "fl1_sf"]
    return wide.withColumnRenamed("frontage", "frontage_mode"), {
        "zero": [*common, "frontage_zero"], "mode": [*common, "frontage_mode"],
        "zero_flag": [*common, "frontage_zero", "null_frontage"]}


@query()
def repeat_cv(t: DataFrame) -> DataFrame:
    wide, variants = _variants(t)
    return compare.repeat_cv(wide, variants, Y, "id", k=10, repeats=10)


@query("""
, s AS (SELECT avg(sale_price) FILTER (id % 2 = 0) AS ma, var_samp(sale_price) FILTER (id % 2 = 0) AS va,
          count(sale_price) FILTER (id % 2 = 0)::double AS na, avg(sale_price) FILTER (id % 2 = 1) AS mb,
          var_samp(sale_price) FILTER (id % 2 = 1) AS vb, count(sale_price) FILTER (id % 2 = 1)::double AS nb
        FROM listings)
SELECT round(ma - mb, 4) AS diff, na + nb - 2 AS df, round((ma - mb)
  / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb)), 6) AS t FROM s""")
def ttest_groups(t: DataFrame) -> DataFrame:
    tested = compare.ttest(t.withColumn("odd", F.col("id") % 2), Y, "odd", 0, 1)
    return rounded(rounded(tested, 4, "diff"), 6, "t").select("diff", "df", "t")


@query()
def compare_variants(t: DataFrame) -> DataFrame:
    wide, variants = _variants(t)
    pairs = [("zero", "mode"), ("zero_flag", "zero")]
    parts = [compare.compare_variants(wide, {a: variants[a], b: variants[b]}, Y, "id", k=10, repeats=10)
             for a, b in pairs]
    return parts[0].unionByName(parts[1])


@query("""
SELECT neighborhood, count(*) AS rows_in, count(*) AS rows_out, true AS complete FROM listings GROUP BY neighborhood""")
def check_counts(t: DataFrame) -> DataFrame:
    out = _group_models(t).transform(t).where(F.col("prediction").isNotNull())
    return scores.check_counts(t, out, "neighborhood")


# --- ensembles ---------------------------------------------------------------

@query("""
, f AS (SELECT regr_slope(ln(sale_price), liv_area) AS b1, regr_intercept(ln(sale_price), liv_area) AS a1,
          regr_slope(ln(sale_price), overall_qual) AS b2, regr_intercept(ln(sale_price), overall_qual) AS a2
        FROM listings)
SELECT id, round(exp((a1 + b1 * liv_area + a2 + b2 * overall_qual) / 2), 3) AS prediction FROM listings, f""")
def average_ensemble(t: DataFrame) -> DataFrame:
    logs = t.withColumn("_log", F.log(Y))
    fits = [linear.fit_linear(logs, [x], "_log", prediction=f"p_{x}") for x in TWO]
    both = fits[1].transform(fits[0].transform(t))
    averaged = ensemble.average_models(both, [f"p_{x}" for x in TWO])
    return averaged.select("id", F.round(F.exp("prediction"), 3).alias("prediction"))


@query(FOLD_FITS + """
SELECT id, cast(fold AS int) AS fold, round(a + b * liv_area, 3) AS oof FROM listings JOIN f ON id % 5 = fold""")
def oof_predictions(t: DataFrame) -> DataFrame:
    folded = folds.with_folds(t.select("id", "liv_area", Y), 5, "id")
    table, _ = ensemble.oof_predictions(folded, Linear(), ["liv_area"], Y)
    return rounded(table, 3, "oof").select("id", "fold", "oof")


@query("""
, f AS (SELECT i AS fold, regr_slope(sale_price, liv_area) AS b, regr_intercept(sale_price, liv_area) AS a
        FROM listings, (SELECT unnest(range(5)) AS i) WHERE id % 4 <> 0 AND id % 5 <> i GROUP BY i)
SELECT id, round((SELECT avg(a) FROM f) + (SELECT avg(b) FROM f) * liv_area, 3) AS prediction
FROM listings WHERE id % 4 = 0""")
def fold_mean_predict(t: DataFrame) -> DataFrame:
    folded = folds.with_folds(t.where(TRAIN).select("id", "liv_area", Y), 5, "id")
    _, models = ensemble.oof_predictions(folded, Linear(), ["liv_area"], Y)
    return rounded(ensemble.fold_mean(t.where(TEST), models), 3, "prediction").select("id", "prediction")


def _stack(meta) -> ensemble.Stack:
    plan = FeaturePlan([block("areas", ["liv_area", "overall_qual"], fill=0, scale=["yeo_johnson", "standard"]),
                        block("grades", ["qual"])], final="robust")
    bases = [regressor(presets.elastic()), regressor(presets.ridge())]
    return ensemble.Stack(bases, meta, plan, Y, "id", CleaningRules(**RULES), k=3)


@query()
def stack_meta(t: DataFrame) -> DataFrame:
    return _stack(Lasso(0.001)).fit(t.where(TRAIN)).predict(t.where(TEST).drop(Y))


@query("""
, f AS (SELECT i AS fold, regr_slope(sale_price, liv_area) AS b, regr_intercept(sale_price, liv_area) AS a
        FROM listings, (SELECT unnest(range(5)) AS i) WHERE id % 5 <> i GROUP BY i)
, o AS (SELECT sale_price AS y, a + b * liv_area AS x FROM listings JOIN f ON id % 5 = fold)
, s AS (SELECT covar_pop(x, x) AS sxx, covar_pop(x, y) AS sxy, covar_pop(y, y) AS syy FROM o)
, alphas AS (SELECT i AS step, pow(10.0::double, -5 + i * (7 / 19.0::double)) * 1e7 AS alpha
             FROM (SELECT unnest(range(20)) AS i))
, c AS (SELECT step, sign(sxy) * greatest(abs(sxy) - alpha, 0) / sxx AS b, sxx, sxy, syy FROM s, alphas)
SELECT cast(step AS int) AS step, round(1 - (syy - 2 * b * sxy + b * b * sxx) / syy, 6) AS r2 FROM c""")
def sweep_meta(t: DataFrame) -> DataFrame:
    """Twenty penalties of a lasso on out-of-fold predictions."""
    folded = folds.with_folds(t.select("id", "liv_area", Y), 5, "id")
    table, _ = ensemble.oof_predictions(folded, Linear(), ["liv_area"], Y)
    learners = [Lasso(10.0 ** (-5 + i * (7 / 19.0)) * 1e7) for i in range(20)]
    return rounded(ensemble.sweep_meta(table, ["oof"], Y, learners), 6, "r2")


@query()
def sweep_stack(t: DataFrame) -> DataFrame:
    """Training R2 of a whole stack over meta penalties, from one out-of-fold table."""
    alphas = [10.0 ** (-5 + i * (7 / 19.0)) for i in range(20)]
    r2 = _stack(None).sweep(t.where(TRAIN), [Lasso(a) for a in alphas])
    return small_frame(t.sparkSession, list(zip(alphas, r2)), "alpha double, r2 double")
