"""The ``listings`` table and the decorator that registers a query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order, with the columns of a sales table and missing values put in.

    Lines are summed by order key before the join, so the join with orders reuses that
    partitioning, and unused columns are pruned down to the scans.
    """
    key = F.col("l_orderkey")
    quantity = F.col("l_quantity")

    def when_flag(flag):
        return F.sum(F.when(F.col("l_returnflag") == flag, quantity).otherwise(0.0))

    def when_status(status):
        return F.count(F.when(F.col("l_linestatus") == status, 1))

    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    percent = F.round(F.col("l_discount") * 100).cast("bigint")
    lines = (table(spark, folder, "lineitem").groupBy(key.alias("l_orderkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(quantity).alias("q"),
        when_flag("R").alias("qr"), when_flag("A").alias("qa"), when_flag("N").alias("qn"),
        when_status("F").alias("nf"), when_status("O").alias("no"),
        F.min(F.year("l_shipdate")).alias("y0"), F.max(F.year("l_shipdate")).alias("y1"),
        (F.sum(cents * (100 - percent)).cast("double") / 10000).alias("rev")))
    joined = (table(spark, folder, "orders")
              .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
              .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
              .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")))
    order = F.col("o_orderkey")

    def unless(k, value):
        return F.when(order % k != 0, value)

    priority = F.substring("o_orderpriority", 1, 1)
    letter = (F.when(priority == "1", "Ex").when(priority == "2", "Gd").when(priority == "3", "TA")
               .when(priority == "4", "Fa").otherwise("Po"))
    n = F.col("n")
    return joined.select(
        order.alias("id"), F.col("n_name").alias("neighborhood"),
        unless(11, F.col("c_mktsegment")).alias("zoning"),
        unless(19, F.col("o_orderstatus")).alias("electrical"),
        unless(31, F.when(order % 3 == 0, "N").otherwise("Y")).alias("central_air"),
        unless(5, letter).alias("qual"), n.alias("overall_qual"),
        unless(29, 1 + order % 9).alias("overall_cond"), unless(7, n * 10).alias("frontage"),
        F.col("q").alias("liv_area"), unless(23, F.col("qr")).alias("bsmt_sf"),
        F.col("qa").alias("fl1_sf"), F.col("qn").alias("fl2_sf"),
        F.col("nf").alias("full_bath"), F.col("no").alias("half_bath"),
        unless(17, F.col("y0")).alias("garage_yr"), F.year("o_orderdate").alias("yr_built"),
        F.col("y1").alias("yr_remod"), F.month("o_orderdate").alias("mo_sold"),
        F.col("y1").alias("yr_sold"), F.col("rev").alias("sale_price"))


LISTINGS_SQL = """
WITH li AS (
  SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q,
    sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS qr,
    sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS qa,
    sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS qn,
    count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS nf,
    count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS no,
    cast(min(year(l_shipdate)) AS int) AS y0, cast(max(year(l_shipdate)) AS int) AS y1,
    cast(sum(cast(round(l_extendedprice * 100) AS bigint)
             * (100 - cast(round(l_discount * 100) AS bigint))) AS double) / 10000 AS rev
  FROM lineitem GROUP BY l_orderkey),
listings AS (
  SELECT o_orderkey AS id, n_name AS neighborhood,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS zoning,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderstatus END AS electrical,
    CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'N' ELSE 'Y' END AS central_air,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderpriority LIKE '1%' THEN 'Ex'
         WHEN o_orderpriority LIKE '2%' THEN 'Gd' WHEN o_orderpriority LIKE '3%' THEN 'TA'
         WHEN o_orderpriority LIKE '4%' THEN 'Fa' ELSE 'Po' END AS qual,
    n AS overall_qual,
    CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE 1 + o_orderkey % 9 END AS overall_cond,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE n * 10 END AS frontage,
    q AS liv_area, CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE qr END AS bsmt_sf,
    qa AS fl1_sf, qn AS fl2_sf, nf AS full_bath, no AS half_bath,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE y0 END AS garage_yr,
    cast(year(o_orderdate) AS int) AS yr_built, y1 AS yr_remod,
    cast(month(o_orderdate) AS int) AS mo_sold, y1 AS yr_sold, rev AS sale_price
  FROM orders JOIN li ON o_orderkey = l_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


def query(sql: str | None = None, recursive: bool = False):
    """Register ``fn(listings) -> DataFrame`` under its own name. ``sql`` continues the
    WITH list that defines ``listings``; ``recursive`` if one of its tables is."""
    def register(fn):
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(listings(spark, folder))
        if sql is not None:
            start = LISTINGS_SQL.replace("WITH", "WITH RECURSIVE", 1) if recursive else LISTINGS_SQL
            ORACLES[name] = start + sql.rstrip()
        return fn
    return register
