"""Feature transformers and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col, total
from ..operators import derive, distribution, missing, transformers
from ..operators.sparse import SparseOneHot
from ..plans.features import FeaturePlan, block
from ..plans.target import TargetTransform
from ..session import small_frame
from .profile import rounded
from .registry import query

SCALED = ["liv_area", "bsmt_sf", "sale_price"]


@query("""
SELECT id, round((liv_area - (SELECT avg(liv_area) FROM listings)) / (SELECT stddev_pop(liv_area) FROM listings), 6) AS liv_area,
  round((bsmt_sf - (SELECT avg(bsmt_sf) FROM listings)) / (SELECT stddev_pop(bsmt_sf) FROM listings), 6) AS bsmt_sf,
  round((sale_price - (SELECT avg(sale_price) FROM listings)) / (SELECT stddev_pop(sale_price) FROM listings), 6) AS sale_price
FROM listings""")
def standard_scale(t: DataFrame) -> DataFrame:
    narrow = t.select("id", *SCALED)
    return rounded(transformers.StandardScale(SCALED).fit(narrow).transform(narrow), 6, *SCALED)


QUARTILE_SQL = ", q AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) AS {c}_lo, quantile_cont({c}, 0.5) AS {c}_mid, quantile_cont({c}, 0.75) AS {c}_hi"
    for c in SCALED) + " FROM listings)\n"


@query(QUARTILE_SQL + "SELECT id, " + ", ".join(
    f"round(({c} - {c}_mid) / ({c}_hi - {c}_lo), 6) AS {c}" for c in SCALED) + " FROM listings, q")
def robust_scale(t: DataFrame) -> DataFrame:
    narrow = t.select("id", *SCALED)
    return rounded(transformers.RobustScale(SCALED).fit(narrow).transform(narrow), 6, *SCALED)


YEO_COLUMNS = ["sale_price", "liv_area", "bsmt_sf"]


@query("""
, grid AS (SELECT -2 + i * cast(0.1 AS double) AS raw, i FROM (SELECT unnest(range(41)) AS i))
, lambdas AS (SELECT round(raw, 6) AS lam FROM grid)
, long AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS x FROM listings WHERE {c} IS NOT NULL" for c in YEO_COLUMNS) + """)
, scored AS (
  SELECT column_name, lam, round(-count(*) / cast(2 AS double)
      * ln(var_pop(CASE WHEN lam = 0 THEN ln(x + 1) ELSE (pow(x + 1, lam) - 1) / lam END))
      + (lam - 1) * sum(ln(x + 1)), 3) AS log_likelihood
  FROM long, lambdas GROUP BY column_name, lam)
SELECT column_name, lam AS lambda, log_likelihood FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY log_likelihood DESC, lam) AS place FROM scored)
WHERE place = 1""")
def yeo_johnson(t: DataFrame) -> DataFrame:
    found = distribution.fit_yeo_johnson(t, YEO_COLUMNS, refine=0)
    return small_frame(t.sparkSession, [(c, lam, score) for c, (lam, score) in zip(YEO_COLUMNS, found)],
                       "column_name string, lambda double, log_likelihood double")


def _flags(column: str, levels, source: str | None = None) -> str:
    return ", ".join(f"""cast(coalesce({source or column} = {v!r}, false) AS int) AS "{column}_{v}\"""" for v in levels)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(f"""
SELECT id, {_flags('zoning', [*SEGMENTS[1:], 'None'], "coalesce(zoning, 'None')")},
  {_flags('overall_cond', range(1, 10))} FROM listings""")
def one_hot(t: DataFrame) -> DataFrame:
    narrow = missing.fill_constant(t.select("id", "zoning", "overall_cond"), ["zoning"], "None")
    narrow = missing.fill_constant(narrow, ["overall_cond"], 0)
    return transformers.OneHot(["zoning", "overall_cond"]).fit(narrow).transform(narrow)


@query(f"SELECT id, {_flags('zoning', [s for s in SEGMENTS if s != 'FURNITURE'])} FROM listings")
def one_hot_ignore(t: DataFrame) -> DataFrame:
    narrow = t.select("id", "zoning")
    known = narrow.where("zoning <> 'FURNITURE'")
    return transformers.OneHot(["zoning"], drop=None, unseen="ignore").fit(known).transform(narrow)


@query("""
SELECT id, dense_rank() OVER (ORDER BY neighborhood) - 1 AS place,
  (SELECT count(DISTINCT neighborhood) FROM listings) + dense_rank() OVER (ORDER BY id // 3) - 1 AS deal_place,
  (SELECT count(DISTINCT neighborhood) + count(DISTINCT id // 3) FROM listings) AS area_place, liv_area
FROM listings""")
def one_hot_sparse(t: DataFrame) -> DataFrame:
    """Entries of a table with a level per few rows."""
    narrow = t.select("id", "neighborhood", F.expr("id div 3").alias("deal"), "liv_area")
    fit = SparseOneHot(["neighborhood", "deal"], ["liv_area"], drop=None).fit(narrow)
    e = F.col("entries")
    return fit.transform(narrow).select(
        "id", *[e[i]["at"].cast("bigint").alias(n) for i, n in enumerate(["place", "deal_place", "area_place"])],
        e[2]["x"].alias("liv_area"))


@query(f"""
SELECT id, liv_area, {_flags('zoning', SEGMENTS)}, {_flags('qual', ['Ex', 'Fa', 'Gd', 'Po', 'TA'])},
  {_flags('mo_sold', [str(m) for m in range(1, 13)], 'cast(mo_sold AS varchar)')} FROM listings""")
def dummies(t: DataFrame) -> DataFrame:
    return transformers.get_dummies(
        t.select("id", "liv_area", "zoning", "qual", F.col("mo_sold").cast("string").alias("mo_sold")))


PLAN_BLOCKS = dict(
    none=dict(columns=["zoning", "electrical"], fill="None", one_hot=True),
    zero=dict(columns=["overall_cond"], fill=0, one_hot=True),
    scaled=dict(columns=["liv_area", "frontage"], fill=0, scale=["robust"]),
    defaults=dict(fill={"central_air": "Y"}, one_hot=True),
    filled=dict(columns=["bsmt_sf"], fill=0),
    differences=dict(columns=["garage_diff", "remod_diff"], fill=0, scale=["standard"]),
    flags=dict(columns=["has_garage"]),
)


def example_plan(**options) -> FeaturePlan:
    return FeaturePlan([block(name, **b) for name, b in PLAN_BLOCKS.items()], **options)


def prepared(t: DataFrame) -> DataFrame:
    t = derive.diff_columns(t, {"garage_diff": ("garage_yr", "yr_built"), "remod_diff": ("yr_remod", "yr_built")})
    return derive.flag_present(t, "garage_yr", "has_garage")


def _plan_sql(fit_on: str, apply_to: str) -> str:
    return f"""
, filled AS (
  SELECT id, coalesce(zoning, 'None') AS zoning, coalesce(electrical, 'None') AS electrical,
    coalesce(overall_cond, 0) AS overall_cond, liv_area, coalesce(frontage, 0) AS frontage,
    coalesce(central_air, 'Y') AS central_air, coalesce(bsmt_sf, 0) AS bsmt_sf,
    coalesce(garage_yr - yr_built, 0) AS garage_diff, yr_remod - yr_built AS remod_diff,
    garage_yr IS NOT NULL AS has_garage FROM listings)
, fit AS (
  SELECT min(zoning) AS z1, min(electrical) AS e1, min(overall_cond) AS o1, min(central_air) AS c1,
    quantile_cont(liv_area, 0.5) AS lm, quantile_cont(liv_area, 0.75) - quantile_cont(liv_area, 0.25) AS lw,
    quantile_cont(frontage, 0.5) AS fm, quantile_cont(frontage, 0.75) - quantile_cont(frontage, 0.25) AS fw,
    avg(garage_diff) AS gm, stddev_pop(garage_diff) AS gs, avg(remod_diff) AS rm, stddev_pop(remod_diff) AS rs
  FROM filled WHERE {fit_on})
SELECT id, round((zoning <> z1)::int + (electrical <> e1)::int + (overall_cond <> o1)::int
    + (liv_area - lm) / lw + (frontage - fm) / fw + (central_air <> c1)::int + bsmt_sf
    + (garage_diff - gm) / gs + (remod_diff - rm) / rs + has_garage::int, 6) AS row_sum,
  (zoning = 'None')::double AS "zoning_None", round((liv_area - lm) / lw, 6) AS liv_area,
  round((garage_diff - gm) / gs, 6) AS garage_diff
FROM filled, fit WHERE {apply_to}"""


def _row_sums(wide: DataFrame, names) -> DataFrame:
    return wide.select("id", F.round(total([col(n) for n in names]), 6).alias("row_sum"), "zoning_None",
                       F.round("liv_area", 6).alias("liv_area"), F.round("garage_diff", 6).alias("garage_diff"))


@query(_plan_sql("true", "true"))
def feature_plan(t: DataFrame) -> DataFrame:
    ready = prepared(t)
    model = example_plan(keep=["id"]).fit(ready)
    return _row_sums(model.transform(ready), model.feature_names)


@query(_plan_sql("id % 4 <> 0", "id % 4 = 0"))
def plan_on_test(t: DataFrame) -> DataFrame:
    ready = prepared(t)
    model = example_plan(keep=["id"]).fit(ready.where("id % 4 <> 0"))
    return _row_sums(model.transform(ready.where("id % 4 = 0")), model.feature_names)


@query("""
, logs AS (SELECT id, ln(sale_price) AS y, sale_price FROM listings)
, fit AS (SELECT avg(y) AS m, stddev_pop(y) AS s, quantile_cont(y, 0.5) AS mid,
            quantile_cont(y, 0.75) - quantile_cont(y, 0.25) AS w FROM logs)
SELECT id, round((y - m) / s, 6) AS standard, round((y - mid) / w, 6) AS robust,
  round(sale_price, 4) AS standard_back, round(sale_price, 4) AS robust_back, round(sale_price, 4) AS power_back
FROM logs, fit""")
def target_round_trip(t: DataFrame) -> DataFrame:
    narrow = t.select("id", "sale_price")
    y = col("sale_price")
    chains = {"standard": ("log", "standard"), "robust": ("log", "robust"), "power": ("log", "yeo_johnson", "robust")}
    fitted = {name: TargetTransform("sale_price", steps).fit(narrow) for name, steps in chains.items()}
    return narrow.select(
        "id", *[F.round(fitted[n].forward(y), 6).alias(n) for n in ("standard", "robust")],
        *[F.round(m.inverse(m.forward(y)), 4).alias(f"{n}_back") for n, m in fitted.items()])
