"""Tables in: CSV or Parquet, one spelling of "missing"."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import col, missing_if_nan

# Texts that mean "missing" in a CSV field.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]


def normalize_missing(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column; one projection, no pass of its own."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floating:
        return df
    return df.select([missing_if_nan(col(c)).alias(c) if c in floating else col(c) for c in df.columns])


def load_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               format: str | None = None) -> DataFrame:
    """Read a table. With a schema a CSV is read once and badly typed fields raise;
    without one Spark infers the types, which costs a second pass over the file."""
    format = format or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if format != "csv":
        return normalize_missing(spark.read.format(format).load(path))
    if schema is None:
        inferred = spark.read.csv(path, header=True, inferSchema=True, nullValue="NA")
        texts = {f.name for f in inferred.schema.fields if isinstance(f.dataType, T.StringType)}
        return normalize_missing(inferred.select([
            F.when(~col(c).isin(MISSING_TEXTS), col(c)).alias(c) if c in texts else col(c)
            for c in inferred.columns]))
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.csv(path, header=True, schema=as_text, enforceSchema=False)
    return normalize_missing(raw.select([
        F.when(~col(f.name).isin(MISSING_TEXTS), col(f.name)).cast(f.dataType).alias(f.name)
        for f in schema.fields]))


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("bigint"))


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First rows by key; a table has no order of its own."""
    return df.orderBy(col(key)).limit(n)
