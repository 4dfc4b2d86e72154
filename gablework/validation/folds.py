"""Fold numbers as a column, from the row's own key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import col


def fold_of(key: Column, k: int, seed: int | None = None) -> Column:
    """0..k-1. With a seed the key is hashed; without one an integer key is taken in
    turn. Either way a row keeps its fold however the table is read."""
    if seed is None:
        return F.pmod(key, F.lit(k)).cast("int")
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(k)).cast("int")


def with_folds(df: DataFrame, k: int, key: str, seed: int | None = None, name: str = "fold") -> DataFrame:
    return df.withColumn(name, fold_of(col(key), k, seed))
