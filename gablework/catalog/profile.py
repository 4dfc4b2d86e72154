"""Statistics, comparison of sources, stacking."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col
from ..operators import distribution, match, missing, profile, select
from ..session import small_frame
from .registry import query

NUMERIC = ["overall_qual", "frontage", "liv_area", "bsmt_sf", "fl1_sf", "full_bath", "sale_price"]


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(col(n), digits) for n in names})


@query("""
SELECT zoning, round(avg(sale_price), 4) AS mean, round(stddev_samp(sale_price), 4) AS std,
  count(sale_price) AS count FROM listings WHERE zoning IS NOT NULL GROUP BY zoning""")
def group_stats(t: DataFrame) -> DataFrame:
    return rounded(profile.group_stats(t, "zoning", "sale_price"), 4, "mean", "std")


@query("SELECT neighborhood, count(*) AS n_rows FROM listings GROUP BY neighborhood")
def group_count(t: DataFrame) -> DataFrame:
    return profile.group_count(t, "neighborhood")


@query("SELECT qual, count(*) AS n_rows FROM listings WHERE qual IS NOT NULL GROUP BY qual")
def value_counts(t: DataFrame) -> DataFrame:
    return profile.value_counts(t, "qual")


@query("""
SELECT neighborhood, count(id) AS n_ids, min(id) AS min_id, max(id) AS max_id,
  cast(sum(id * 2654435761 % 1000003) AS bigint) AS checksum FROM listings GROUP BY neighborhood""")
def ids_by_group(t: DataFrame) -> DataFrame:
    return profile.ids_by_group(t, "neighborhood", "id")


@query("SELECT count(*) AS n_rows FROM listings WHERE liv_area > 250 AND sale_price < 500000")
def count_where(t: DataFrame) -> DataFrame:
    return profile.count_where(t, "liv_area > 250 AND sale_price < 500000")


def _each(columns, template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


@query(_each(["sale_price", "liv_area", "bsmt_sf", "frontage"], """
SELECT '{c}' AS column_name, round(skewness({c}), 5) AS skew, round(kurtosis({c}), 5) AS kurt FROM listings"""))
def skew_kurt(t: DataFrame) -> DataFrame:
    return rounded(profile.skew_kurt(t, ["sale_price", "liv_area", "bsmt_sf", "frontage"]), 5, "skew", "kurt")


NORMAL_SQL = ", raw AS (" + _each(["sale_price", "liv_area", "overall_cond"], """
SELECT '{c}' AS column_name, cast(count({c}) AS double) AS n, kurtosis_pop({c}) AS g2,
  skewness({c}) * (cast(count({c}) AS double) - 2)
    / sqrt(cast(count({c}) AS double) * (cast(count({c}) AS double) - 1)) AS g1 FROM listings""") + """)
, s1 AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
    3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS b2,
    3 * (n - 1) / (n + 1) AS e,
    24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5)) AS v,
    6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS beta
  FROM raw)
, s2 AS (SELECT *, sqrt(2 * (b2 - 1)) - 1 AS w2, (g2 + 3 - e) / sqrt(v) AS x,
    6 + 8 / beta * (2 / beta + sqrt(1 + 4 / (beta * beta))) AS a FROM s1)
, s3 AS (SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(ln(w2) / 2) AS zs,
    (1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))) AS c FROM s2)
, s4 AS (SELECT *, (1 - 2 / (9 * a) - sign(c) * pow(abs(c), 1 / cast(3 AS double))) / sqrt(2 / (9 * a)) AS zk FROM s3)
SELECT column_name, round(zs * zs + zk * zk, 4) AS statistic, round(exp(-(zs * zs + zk * zk) / 2), 6) AS p_value FROM s4
"""


@query(NORMAL_SQL)
def normal_test(t: DataFrame) -> DataFrame:
    tested = profile.normal_test(t, ["sale_price", "liv_area", "overall_cond"])
    return rounded(rounded(tested, 4, "statistic"), 6, "p_value")


@query(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 5) AS r FROM listings"
    for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]))
def corr_matrix(t: DataFrame) -> DataFrame:
    return rounded(profile.corr_matrix(t, NUMERIC), 5, "r")


def _spiky_sql(n: int) -> str:
    """Correlations of ``spiky`` columns, NaN as missing; none with the constant c1."""
    columns = ", ".join(["CASE WHEN id % 13 <> 0 THEN liv_area END AS c0", "3.0::double AS c1",
                         *[f"(id * {k} % 101)::double AS c{k}" for k in range(2, n)]])
    pairs = " UNION ALL ".join(
        f"SELECT 'c{i}' AS a, 'c{j}' AS b, " + ("max(NULL::double)" if 1 in (i, j) else f"round(corr(c{i}, c{j}), 5)") + " AS r FROM s"
        for i in range(n) for j in range(i + 1, n))
    return f", s AS (SELECT {columns} FROM listings) {pairs}"


def _spiky(t: DataFrame, n: int) -> DataFrame:
    """Columns c0 with NaN in it, c1 constant, and others."""
    s = t.select(F.when(F.col("id") % 13 != 0, F.col("liv_area")).otherwise(F.lit(float("nan"))).alias("c0"), F.lit(3.0).alias("c1"),
                 *[(F.col("id") * k % 101).cast("double").alias(f"c{k}") for k in range(2, n)])
    return rounded(profile.corr_matrix(s, s.columns), 5, "r")


@query(_spiky_sql(6))
def corr_missing_narrow(t: DataFrame) -> DataFrame:
    return _spiky(t, 6)


@query(_spiky_sql(20))
def corr_missing_wide(t: DataFrame) -> DataFrame:
    return _spiky(t, 20)


@query(_each(NUMERIC[:-1], "SELECT '{c}' AS column_name, round(corr({c}, sale_price), 5) AS r FROM listings"))
def corr_with_target(t: DataFrame) -> DataFrame:
    return rounded(profile.corr_with(t, "sale_price", NUMERIC), 5, "r")


@query("""
, span AS (SELECT cast(min(liv_area) AS double) AS lo, cast(max(liv_area) AS double) AS hi
           FROM listings WHERE electrical IS NOT NULL)
SELECT electrical, cast(least(floor((liv_area - lo) / (hi - lo) * 30), 29) AS int) AS bin, count(*) AS n_rows
FROM listings, span WHERE electrical IS NOT NULL AND liv_area IS NOT NULL GROUP BY 1, 2""")
def facet_histogram(t: DataFrame) -> DataFrame:
    return profile.histogram(t, "liv_area", 30, "electrical")


POWER_SQL = """
, grid AS (SELECT cast(0.1 AS double) + cast(3.9 AS double) * (i / cast(199 AS double)) AS p, i
           FROM (SELECT unnest(range(200)) AS i))
, candidates AS ({each})
SELECT column_name, round(p, 9) AS power, r2 FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY r2 DESC, i) AS place FROM candidates)
WHERE place = 1"""
POWER_EACH = """
SELECT '{c}' AS column_name, i, p, round(regr_r2(sale_price, pow(cast({c} AS double), p)), 6) AS r2
FROM listings, grid GROUP BY i, p"""


def _powers(t: DataFrame, columns, grid) -> DataFrame:
    found = distribution.best_powers(t, columns, "sale_price", grid)
    return small_frame(t.sparkSession, [(c, round(p, 9), r2) for c, (p, r2) in zip(columns, found)],
                       "column_name string, power double, r2 double")


@query("""
, grid AS (SELECT cast(2.5 AS double) + i / cast(49 AS double) AS p, i FROM (SELECT unnest(range(50)) AS i))
, candidates AS (""" + POWER_EACH.format(c="overall_qual") + """)
SELECT column_name, round(p, 9) AS power, r2 FROM candidates ORDER BY r2 DESC, i LIMIT 1""")
def best_power(t: DataFrame) -> DataFrame:
    return _powers(t, ["overall_qual"], distribution.linspace(2.5, 3.5, 50))


@query(POWER_SQL.replace("{each}", _each(["overall_qual", "full_bath", "overall_cond", "liv_area"], POWER_EACH)))
def best_powers(t: DataFrame) -> DataFrame:
    return _powers(t, ["overall_qual", "full_bath", "overall_cond", "liv_area"], distribution.linspace(0.1, 4.0, 200))


@query("""
SELECT round(regr_slope(sale_price, liv_area), 4) AS slope, round(regr_intercept(sale_price, liv_area), 3) AS intercept,
  round(regr_r2(sale_price, liv_area), 6) AS r2 FROM listings""")
def ols_line(t: DataFrame) -> DataFrame:
    line = profile.ols_line(t, "liv_area", "sale_price")
    return rounded(rounded(rounded(line, 4, "slope"), 3, "intercept"), 6, "r2")


@query("""
SELECT neighborhood, round(regr_slope(sale_price, liv_area), 4) AS slope,
  round(regr_intercept(sale_price, liv_area), 3) AS intercept, round(regr_r2(sale_price, liv_area), 6) AS r2
FROM listings GROUP BY neighborhood""")
def ols_by_group(t: DataFrame) -> DataFrame:
    line = profile.ols_line(t, "liv_area", "sale_price", "neighborhood")
    return rounded(rounded(rounded(line, 4, "slope"), 3, "intercept"), 6, "r2")


@query("""
, span AS (SELECT min(sale_price) AS lo, max(sale_price) AS hi, avg(sale_price) AS m, stddev_pop(sale_price) AS s,
                  count(*) AS total FROM listings)
, binned AS (SELECT cast(least(floor((sale_price - lo) / (hi - lo) * 50), 49) AS int) AS bin, count(*) AS n_rows
             FROM listings, span GROUP BY 1)
SELECT bin, n_rows, round(1e6 * n_rows / (total * (hi - lo) / 50), 6) AS density_per_million,
  round(1e6 * exp(-pow((lo + (bin + cast(0.5 AS double)) * (hi - lo) / 50 - m) / s, 2) / 2) / (s * sqrt(2 * pi())), 6)
    AS normal_per_million
FROM binned, span""")
def normal_fit(t: DataFrame) -> DataFrame:
    fit = profile.normal_fit(t, "sale_price", 50)
    return fit.select("bin", "n_rows", F.round(F.col("density") * 1e6, 6).alias("density_per_million"),
                      F.round(F.col("normal_density") * 1e6, 6).alias("normal_per_million"))


# --- comparison of two sources -----------------------------------------------

KEYS = ["sale_price", "yr_sold", "mo_sold", "bsmt_sf"]
PAIRED = ["id", "liv_area", "fl1_sf", "zoning"]
MATCH_SQL = """
, other AS (SELECT sale_price, yr_sold, CASE WHEN id % 7 = 1 THEN mo_sold % 12 + 1 ELSE mo_sold END AS mo_sold,
              bsmt_sf, id, liv_area,
              CASE WHEN id % 3 = 0 THEN fl1_sf + 1 ELSE fl1_sf END AS fl1_sf, zoning
            FROM listings WHERE id % 10 <> 0)
, merged AS (
  SELECT coalesce(a.sale_price, b.sale_price) AS sale_price, coalesce(a.yr_sold, b.yr_sold) AS yr_sold,
    coalesce(a.mo_sold, b.mo_sold) AS mo_sold, coalesce(a.bsmt_sf, b.bsmt_sf) AS bsmt_sf,
    a.id AS id_x, a.liv_area AS liv_area_x, a.fl1_sf AS fl1_sf_x, a.zoning AS zoning_x,
    b.id AS id_y, b.liv_area AS liv_area_y, b.fl1_sf AS fl1_sf_y, b.zoning AS zoning_y
  FROM listings a FULL OUTER JOIN other b
    ON a.sale_price IS NOT DISTINCT FROM b.sale_price AND a.yr_sold IS NOT DISTINCT FROM b.yr_sold
   AND a.mo_sold IS NOT DISTINCT FROM b.mo_sold AND a.bsmt_sf IS NOT DISTINCT FROM b.bsmt_sf)
"""


def _merged(t: DataFrame) -> DataFrame:
    """The listings beside a second source: its own naming style, a tenth of the rows
    unknown to it, some areas and some months noted differently."""
    other = (t.where("id % 10 <> 0")
             .select(*[F.col(c).alias("X" + c.replace("_", "._")) for c in [*KEYS, *PAIRED]]))
    other = select.rename_regex(other, "(^X)|([.])").withColumns({
        "fl1_sf": F.when(F.col("id") % 3 == 0, F.col("fl1_sf") + 1).otherwise(F.col("fl1_sf")),
        "mo_sold": F.when(F.col("id") % 7 == 1, F.col("mo_sold") % 12 + 1).otherwise(F.col("mo_sold"))})
    return match.match_sources(t.select(*KEYS, *PAIRED), other, KEYS)


@query(MATCH_SQL + "SELECT * FROM merged")
def match_sources(t: DataFrame) -> DataFrame:
    return _merged(t)


@query(MATCH_SQL + """
SELECT id_x, id_y, coalesce(liv_area_x = liv_area_y, false) AND coalesce(fl1_sf_x = fl1_sf_y, false)
  AND coalesce(zoning_x = zoning_y, false) AS agree FROM merged""")
def rows_agree(t: DataFrame) -> DataFrame:
    return match.rows_agree(_merged(t), ["liv_area", "fl1_sf", "zoning"]).select("id_x", "id_y", "agree")


@query("""
SELECT id, CASE WHEN id % 4 <> 0 THEN 'train' ELSE 'test' END AS part, coalesce(zoning, 'None') AS zoning,
  CASE WHEN id % 4 <> 0 THEN sale_price END AS sale_price FROM listings""")
def union_split(t: DataFrame) -> DataFrame:
    narrow = t.select("id", "zoning", "sale_price")
    train, test = match.union_split(narrow.where("id % 4 <> 0"), narrow.where("id % 4 = 0").drop("sale_price"),
                                    lambda df: missing.fill_constant(df, ["zoning"], "None"))
    parts = [rows.withColumn("part", F.lit(name)) for name, rows in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1])


@query("""
, logs AS (SELECT id, ln(sale_price) AS y, ln(liv_area) AS x FROM listings)
, moments AS (SELECT avg(y) AS my, stddev_pop(y) AS sy, avg(x) AS mx, stddev_pop(x) AS sx FROM logs)
SELECT id, round((y - my) / sy, 6) AS sale_price, round((x - mx) / sx, 6) AS liv_area FROM logs, moments""")
def log_zscore(t: DataFrame) -> DataFrame:
    from ..operators.transformers import LogZScore

    columns = ["sale_price", "liv_area"]
    scaled = LogZScore(columns).fit(t).transform(t.select("id", *columns))
    return rounded(scaled, 6, *columns)
