"""Sources, selection, missing values, recoding and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import sources
from ..functions.columns import col
from ..operators import derive, missing, select
from ..plans.cleaning import CleaningRules
from ..session import fresh_path
from .registry import query

SMALL = ("id", "neighborhood", "zoning", "frontage", "bsmt_sf", "sale_price")
OUTLIER = "liv_area > 250 AND sale_price < 500000"

# The rules the reference applies to its sales table, on the stand-in columns.
LISTING_RULES = dict(
    group="neighborhood", target="sale_price",
    modes=["zoning", "frontage"],
    equals={"central_air": "Y"},
    recode={"zoning": {"HOUSEHOLD": "FURNITURE"}},
    merge={"zoning": (["MACHINERY", "BUILDING"], "Oth")},
    clamp={"overall_cond": 3},
    keep={"electrical": ("O", "Oth")},
    present={"has_garage": "garage_yr"},
    diffs={"garage_diff": ("garage_yr", "yr_built"), "remod_diff": ("yr_remod", "yr_built")},
    powers={"square_mo": ("mo_sold", 2), "quad_mo": ("mo_sold", 4)},
    grades=["qual"],
    sums={"sf": ["bsmt_sf", "fl1_sf", "fl2_sf"]},
    weights={"num_baths": {"full_bath": 1, "half_bath": 0.5}},
    nonzero={"has_bsmt": "bsmt_sf", "two_story": "fl2_sf"},
    same={"new_house": ("yr_built", "yr_sold")},
)


# --- sources and sinks -------------------------------------------------------

@query("SELECT * FROM listings")
def load_table(t: DataFrame) -> DataFrame:
    path = fresh_path(t.sparkSession, "listings-csv")
    t.write.csv(path, header=True)
    return sources.load_table(t.sparkSession, path, schema=t.schema)


@query("""
, fit AS (SELECT regr_slope(sale_price, liv_area) AS b, regr_intercept(sale_price, liv_area) AS a FROM listings)
SELECT id AS "Id", round(a + b * liv_area, 2) AS "SalePrice" FROM listings, fit""")
def write_predictions(t: DataFrame) -> DataFrame:
    from ..models.linear import fit_linear

    spark = t.sparkSession
    model = fit_linear(t, ["liv_area"], "sale_price", prediction="predicted")
    path = fresh_path(spark, "predictions")
    sources.write_predictions(model.transform(t), path, "id", "predicted", header=("Id", "SalePrice"))
    return (sources.load_table(spark, path, schema="Id bigint, SalePrice double")
            .select("Id", F.round("SalePrice", 2).alias("SalePrice")))


@query("""
SELECT count(*) AS n_rows, cast(21 AS bigint) AS n_cols FROM listings""")
def table_shape(t: DataFrame) -> DataFrame:
    return sources.shape(t)


# --- selection ---------------------------------------------------------------

@query("""
SELECT id, liv_area, sale_price FROM listings
WHERE NOT coalesce(liv_area > 250 AND sale_price < 500000, false)""")
def outlier_filter(t: DataFrame) -> DataFrame:
    return select.remove_outliers(t, OUTLIER).select("id", "liv_area", "sale_price")


@query("SELECT id, neighborhood, qual, liv_area, sale_price FROM listings")
def select_features(t: DataFrame) -> DataFrame:
    return select.select_features(t, ["id", "neighborhood", "qual", "liv_area", "mo_sold", "sale_price"],
                                  drop=["mo_sold"])


@query("""
SELECT id, overall_qual, overall_cond, frontage, liv_area, bsmt_sf, fl1_sf, fl2_sf, full_bath, half_bath,
  garage_yr, yr_built, yr_remod, mo_sold, yr_sold, sale_price FROM listings""")
def numeric_columns(t: DataFrame) -> DataFrame:
    return select.numeric_columns(t)


@query("""
SELECT id, cast(liv_area AS int) AS liv_area, cast(bsmt_sf AS int) AS bsmt_sf,
  cast(mo_sold AS varchar) AS mo_sold, cast(yr_sold AS varchar) AS yr_sold FROM listings""")
def cast_columns(t: DataFrame) -> DataFrame:
    typed = select.cast_columns(t, ["liv_area", "bsmt_sf"], "int")
    return select.cast_columns(typed, ["mo_sold", "yr_sold"], "string").select(
        "id", "liv_area", "bsmt_sf", "mo_sold", "yr_sold")


@query('SELECT id AS listing_id, fl1_sf AS "1stsf", liv_area AS livarea FROM listings')
def rename_regex(t: DataFrame) -> DataFrame:
    other = t.select(col("id"), F.col("fl1_sf").alias("X1st.sf"), F.col("liv_area").alias("liv.area"))
    return select.rename(select.rename_regex(other, "(^X)|([.])"), {"id": "listing_id"})


@query("SELECT bsmt_sf, fl1_sf, fl2_sf FROM listings")
def columns_matching(t: DataFrame) -> DataFrame:
    return select.columns_matching(t, "_sf$")


@query("SELECT id, zoning, liv_area FROM listings UNION ALL SELECT id, NULL, sale_price FROM listings")
def split_xy(t: DataFrame) -> DataFrame:
    x, y = select.split_xy(t.select("id", "zoning", "liv_area", "sale_price"), "sale_price", key="id")
    return x.unionByName(y.withColumnRenamed("sale_price", "liv_area"), allowMissingColumns=True)


@query("SELECT id, neighborhood, sale_price FROM listings WHERE neighborhood = 'NATION_7'")
def one_group(t: DataFrame) -> DataFrame:
    return select.one_group(t, "neighborhood", "NATION_7").select("id", "neighborhood", "sale_price")


# --- missing values ----------------------------------------------------------

@query("""
SELECT id, coalesce(zoning, 'None') AS zoning, coalesce(electrical, 'None') AS electrical,
  coalesce(qual, 'None') AS qual FROM listings""")
def fill_none(t: DataFrame) -> DataFrame:
    columns = ["zoning", "electrical", "qual"]
    return missing.fill_constant(t.select("id", *columns), columns, "None")


@query("""
SELECT id, coalesce(bsmt_sf, 0) AS bsmt_sf, coalesce(frontage, 0) AS frontage,
  coalesce(garage_yr, 0) AS garage_yr FROM listings""")
def fill_zero(t: DataFrame) -> DataFrame:
    columns = ["bsmt_sf", "frontage", "garage_yr"]
    return missing.fill_constant(t.select("id", *columns), columns, 0)


@query("""
SELECT id, coalesce(electrical, 'Oth') AS electrical, coalesce(central_air, 'Y') AS central_air,
  coalesce(zoning, 'BUILDING') AS zoning FROM listings""")
def dict_impute(t: DataFrame) -> DataFrame:
    return missing.DictImputer({"electrical": "Oth", "central_air": "Y", "zoning": "BUILDING"},
                               keep=["id"]).transform(t)


@query("""
SELECT id, coalesce(bsmt_sf, 0) AS bsmt_sf, coalesce(frontage, 0) AS frontage,
  bsmt_sf IS NULL AS null_bsmt_sf, frontage IS NULL AS null_frontage FROM listings""")
def null_flags(t: DataFrame) -> DataFrame:
    columns = ["bsmt_sf", "frontage"]
    flagged = missing.add_null_flags(t.select("id", *columns), columns)
    return missing.fill_constant(flagged, columns, 0)


def _choice_sql(direction: str) -> str:
    def ranked(c):
        return f"""
, {c}_ranked AS (
  SELECT neighborhood, {c}, row_number() OVER (PARTITION BY neighborhood ORDER BY count(*) {direction}, {c}) AS place
  FROM listings WHERE neighborhood IS NOT NULL AND {c} IS NOT NULL GROUP BY neighborhood, {c})"""
    return ranked("zoning") + ranked("frontage") + """
, choice AS (
  SELECT g.neighborhood, z.zoning, f.frontage
  FROM (SELECT DISTINCT neighborhood FROM listings WHERE neighborhood IS NOT NULL) g
  LEFT JOIN (SELECT * FROM zoning_ranked WHERE place = 1) z USING (neighborhood)
  LEFT JOIN (SELECT * FROM frontage_ranked WHERE place = 1) f USING (neighborhood))
"""


MODE_SQL = _choice_sql("DESC")


@query(MODE_SQL + "SELECT * FROM choice")
def group_mode(t: DataFrame) -> DataFrame:
    return missing.group_choice(t, "neighborhood", ["zoning", "frontage"])


@query(_choice_sql("ASC") + "SELECT * FROM choice")
def group_rarest(t: DataFrame) -> DataFrame:
    return missing.group_choice(t, "neighborhood", ["zoning", "frontage"], strategy="rarest")


@query(MODE_SQL + """
SELECT id, l.neighborhood, coalesce(l.zoning, c.zoning) AS zoning, coalesce(l.frontage, c.frontage) AS frontage
FROM listings l LEFT JOIN choice c ON l.neighborhood = c.neighborhood""")
def group_mode_impute(t: DataFrame) -> DataFrame:
    columns = ["zoning", "frontage"]
    fitted = missing.GroupModeImputer("neighborhood", columns).fit(t)
    return fitted.transform(t.select("id", "neighborhood", *columns))


@query(MODE_SQL + """
, variants AS (
  SELECT 'zero' AS variant, coalesce(frontage, 0) AS frontage FROM listings
  UNION ALL SELECT 'mode', coalesce(l.frontage, c.frontage)
  FROM listings l LEFT JOIN choice c ON l.neighborhood = c.neighborhood)
SELECT variant, round(avg(frontage), 6) AS mean, count(*) - count(frontage) AS n_missing
FROM variants GROUP BY variant""")
def impute_compare(t: DataFrame) -> DataFrame:
    narrow = t.select("neighborhood", "frontage")
    parts = [missing.impute_variant(narrow, "frontage", how, "neighborhood").withColumn("variant", F.lit(how))
             for how in ("zero", "mode")]
    return (parts[0].unionByName(parts[1]).groupBy("variant")
            .agg(F.round(F.avg("frontage"), 6).alias("mean"),
                 F.count_if(F.col("frontage").isNull()).alias("n_missing")))


COLUMNS = ["id", "neighborhood", "zoning", "electrical", "central_air", "qual", "overall_qual", "overall_cond",
           "frontage", "liv_area", "bsmt_sf", "fl1_sf", "fl2_sf", "full_bath", "half_bath", "garage_yr",
           "yr_built", "yr_remod", "mo_sold", "yr_sold", "sale_price"]
PROFILE_SQL = ", profile AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing FROM listings" for c in COLUMNS) + ")\n"


@query(PROFILE_SQL + "SELECT * FROM profile ORDER BY n_missing DESC, column_name LIMIT 5")
def null_profile(t: DataFrame) -> DataFrame:
    return missing.null_profile(t, 5)


@query(PROFILE_SQL + "SELECT cast(sum(n_missing) AS bigint) AS n_missing FROM profile")
def null_total(t: DataFrame) -> DataFrame:
    return missing.null_total(t)


@query("SELECT neighborhood, count(*) - count(frontage) AS n_missing FROM listings GROUP BY neighborhood")
def null_by_group(t: DataFrame) -> DataFrame:
    return missing.null_by_group(t, "frontage", "neighborhood")


@query("""
SELECT neighborhood, count(*) AS n_rows, count(*) - count(frontage) AS n_missing
FROM listings GROUP BY neighborhood""")
def null_vs_total(t: DataFrame) -> DataFrame:
    return missing.null_vs_total(t, "frontage", "neighborhood")


@query("""
, counted AS (
  SELECT CASE WHEN id % 4 <> 0 THEN 'train' ELSE 'test' END AS part,
    count(*) - count(zoning) AS zoning, count(*) - count(qual) AS qual, count(*) - count(liv_area) AS liv_area
  FROM listings GROUP BY 1)
SELECT * FROM (
  SELECT part, 'zoning' AS column_name, zoning AS n_missing FROM counted
  UNION ALL SELECT part, 'qual', qual FROM counted UNION ALL SELECT part, 'liv_area', liv_area FROM counted)
WHERE n_missing > 0""")
def columns_with_nulls(t: DataFrame) -> DataFrame:
    columns = ["zoning", "qual", "liv_area"]

    def part(name, rows):
        return missing.columns_with_nulls(rows, columns).select(F.lit(name).alias("part"), "column_name", "n_missing")

    return part("train", t.where("id % 4 <> 0")).unionByName(part("test", t.where("id % 4 = 0")))


CLEAN_SQL = MODE_SQL + """
, filled AS (
  SELECT l.* EXCLUDE (zoning, frontage), coalesce(l.zoning, c.zoning) AS zoning,
    coalesce(l.frontage, c.frontage) AS frontage
  FROM listings l LEFT JOIN choice c ON l.neighborhood = c.neighborhood)
, cleaned AS (
  SELECT * EXCLUDE (central_air, zoning, overall_cond, electrical, qual),
    coalesce(central_air = 'Y', false) AS central_air,
    CASE WHEN zoning = 'HOUSEHOLD' THEN 'FURNITURE' WHEN zoning IN ('MACHINERY', 'BUILDING') THEN 'Oth'
         ELSE zoning END AS zoning,
    CASE WHEN overall_cond < 3 THEN 3 ELSE overall_cond END AS overall_cond,
    CASE WHEN electrical = 'O' THEN 'O' ELSE 'Oth' END AS electrical,
    garage_yr IS NOT NULL AS has_garage,
    garage_yr - yr_built AS garage_diff, yr_remod - yr_built AS remod_diff,
    pow(cast(mo_sold AS double), 2) AS square_mo, pow(cast(mo_sold AS double), 4) AS quad_mo,
    CASE qual WHEN 'Ex' THEN 5 WHEN 'Gd' THEN 4 WHEN 'TA' THEN 3 WHEN 'Fa' THEN 2 WHEN 'Po' THEN 1 ELSE 0 END AS qual,
    bsmt_sf + fl1_sf + fl2_sf AS sf, full_bath + cast(0.5 AS double) * half_bath AS num_baths,
    coalesce(bsmt_sf <> 0, true) AS has_bsmt, coalesce(fl2_sf <> 0, true) AS two_story,
    coalesce(yr_built = yr_sold, false) AS new_house
  FROM filled)
"""


@query(CLEAN_SQL + "SELECT * FROM cleaned")
def clean_table(t: DataFrame) -> DataFrame:
    return CleaningRules(**LISTING_RULES).fit(t).transform(t)


# --- recoding ----------------------------------------------------------------

@query("""
SELECT id, CASE overall_qual WHEN 7 THEN 6 WHEN 1 THEN 2 ELSE overall_qual END AS overall_qual,
  CASE qual WHEN 'Po' THEN 'Fa' WHEN 'Ex' THEN NULL ELSE qual END AS qual,
  CASE zoning WHEN 'HOUSEHOLD' THEN 'FURNITURE' ELSE zoning END AS zoning FROM listings""")
def recode_values(t: DataFrame) -> DataFrame:
    return derive.recode(t.select("id", "overall_qual", "qual", "zoning"), {
        "overall_qual": {7: 6, 1: 2}, "qual": {"Po": "Fa", "Ex": None}, "zoning": {"HOUSEHOLD": "FURNITURE"}})


@query("""
SELECT id, CASE WHEN zoning IN ('MACHINERY', 'BUILDING') THEN 'Oth' ELSE zoning END AS zoning FROM listings""")
def merge_levels(t: DataFrame) -> DataFrame:
    return derive.merge_levels(t.select("id", "zoning"), "zoning", ["MACHINERY", "BUILDING"], "Oth")


@query("SELECT id, CASE WHEN electrical = 'O' THEN 'O' ELSE 'Oth' END AS electrical FROM listings")
def keep_or_other(t: DataFrame) -> DataFrame:
    return derive.keep_or_other(t.select("id", "electrical"), "electrical", "O")


@query("SELECT id, CASE WHEN overall_cond < 3 THEN 3 ELSE overall_cond END AS overall_cond FROM listings")
def clamp_low(t: DataFrame) -> DataFrame:
    return derive.clamp_low(t.select("id", "overall_cond"), "overall_cond", 3)


@query("""
SELECT id, CASE qual WHEN 'Ex' THEN 5 WHEN 'Gd' THEN 4 WHEN 'TA' THEN 3 WHEN 'Fa' THEN 2 WHEN 'Po' THEN 1
  ELSE 0 END AS qual FROM listings""")
def ordinal_encode(t: DataFrame) -> DataFrame:
    return derive.ordinal_encode(t.select("id", "qual"), ["qual"])


@query("""
SELECT id, coalesce(central_air = 'Y', false) AS central_air, garage_yr IS NOT NULL AS has_garage,
  coalesce(bsmt_sf <> 0, true) AS has_bsmt, coalesce(fl2_sf <> 0, true) AS two_story,
  coalesce(garage_yr = yr_built, false) AS same_year FROM listings""")
def flag_columns(t: DataFrame) -> DataFrame:
    t = derive.flag_equals(t, "central_air", "Y")
    t = derive.flag_present(t, "garage_yr", "has_garage")
    t = derive.flag_nonzero(t, {"has_bsmt": "bsmt_sf", "two_story": "fl2_sf"})
    t = derive.flag_same(t, "garage_yr", "yr_built", "same_year")
    return t.select("id", "central_air", "has_garage", "has_bsmt", "two_story", "same_year")


@query("""
SELECT id, coalesce(zoning IN ('MACHINERY', 'BUILDING'), false) AS in_group FROM listings""")
def flag_in(t: DataFrame) -> DataFrame:
    return derive.flag_in(t, "zoning", ["MACHINERY", "BUILDING"], "in_group").select("id", "in_group")


@query("""
, first_seen AS (SELECT zoning, min(id) AS first_id FROM listings WHERE id % 4 <> 0 AND zoning IS NOT NULL GROUP BY zoning)
, codes AS (SELECT zoning, row_number() OVER (ORDER BY first_id) - 1 AS code FROM first_seen)
SELECT id, l.zoning, cast(coalesce(code, -1) AS bigint) AS code
FROM listings l LEFT JOIN codes c ON l.zoning = c.zoning""")
def factorize(t: DataFrame) -> DataFrame:
    fitted = missing.Factorizer("zoning", "id", "code").fit(t.where("id % 4 <> 0"))
    return fitted.transform(t.select("id", "zoning"))


# --- derived columns ---------------------------------------------------------

@query("SELECT id, garage_yr - yr_built AS garage_diff, yr_remod - yr_built AS remod_diff FROM listings")
def diff_columns(t: DataFrame) -> DataFrame:
    return derive.diff_columns(t, {"garage_diff": ("garage_yr", "yr_built"), "remod_diff": ("yr_remod", "yr_built")}
                               ).select("id", "garage_diff", "remod_diff")


@query("SELECT id, bsmt_sf + fl1_sf + fl2_sf AS sf FROM listings")
def sum_columns(t: DataFrame) -> DataFrame:
    return derive.sum_columns(t, ["bsmt_sf", "fl1_sf", "fl2_sf"], "sf").select("id", "sf")


@query("SELECT id, full_bath + cast(0.5 AS double) * half_bath AS num_baths FROM listings")
def weighted_sum(t: DataFrame) -> DataFrame:
    return derive.weighted_sum(t, {"full_bath": 1, "half_bath": 0.5}, "num_baths").select("id", "num_baths")


@query("""
SELECT id, pow(cast(mo_sold AS double), 2) AS square_mo, pow(cast(mo_sold AS double), 4) AS quad_mo,
  pow(cast(mo_sold AS double), 6) AS hex_mo, pow(cast(mo_sold AS double), 8) AS oct_mo FROM listings""")
def power_columns(t: DataFrame) -> DataFrame:
    powers = {"square_mo": 2, "quad_mo": 4, "hex_mo": 6, "oct_mo": 8}
    return derive.power_columns(t, "mo_sold", powers).select("id", *powers)


@query("SELECT id, round(pow(cast(overall_qual AS double), cast(2.75 AS double)), 6) AS scaled_qual FROM listings")
def scale_power(t: DataFrame) -> DataFrame:
    scaled = derive.scale_power(t, "overall_qual", 2.75, "scaled_qual")
    return scaled.select("id", F.round("scaled_qual", 6).alias("scaled_qual"))


@query("SELECT id, round(sin(pi() * mo_sold / cast(12 AS double)), 6) AS sin_month FROM listings")
def sin_month(t: DataFrame) -> DataFrame:
    return derive.sin_month(t, "mo_sold").select("id", F.round("sin_month", 6).alias("sin_month"))


@query("""
SELECT id, round(CASE WHEN bsmt_sf > 0 THEN ln(bsmt_sf) ELSE bsmt_sf END, 6) AS bsmt_sf FROM listings""")
def log_positive(t: DataFrame) -> DataFrame:
    return derive.log_positive(t, ["bsmt_sf"]).select("id", F.round("bsmt_sf", 6).alias("bsmt_sf"))
