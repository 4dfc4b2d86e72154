"""Score tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import scores
from ..functions.columns import col


def score(df: DataFrame, y: str, prediction: str, group: str | None = None) -> DataFrame:
    """n, R2, RMSE per group or overall; sums are split over tasks, so a hot group is not
    gathered anywhere."""
    source = df.where(col(group).isNotNull()).groupBy(col(group)) if group else df
    a, p = col(y), col(prediction)
    return source.agg(F.count(a).alias("n"), scores.r2(a, p).alias("r2"), scores.rmse(a, p).alias("rmse"))


def score_logs(df: DataFrame, y: str, prediction: str) -> DataFrame:
    return df.agg(scores.msle(col(y), col(prediction)).alias("msle"),
                  scores.rmsle(col(y), col(prediction)).alias("rmsle"))


def check_counts(before: DataFrame, after: DataFrame, group: str) -> DataFrame:
    """Rows in and rows out per group, and whether they agree. Both sides are counted
    before they meet, in one aggregate over tagged rows."""
    tagged = (before.select(col(group), F.lit(1).alias("i"), F.lit(0).alias("o"))
              .unionAll(after.select(col(group), F.lit(0), F.lit(1))))
    return (tagged.groupBy(col(group)).agg(F.sum("i").alias("rows_in"), F.sum("o").alias("rows_out"))
            .withColumn("complete", F.col("rows_in") == F.col("rows_out")))
