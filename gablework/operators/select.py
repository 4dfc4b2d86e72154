"""Filter, projection, typing and renaming."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, types as T

from ..functions.columns import col, holds


def remove_outliers(df: DataFrame, condition: Column | str) -> DataFrame:
    """Drop rows that meet the condition; a row that cannot be judged stays."""
    return df.where(~holds(condition))


def select_features(df: DataFrame, keep: Iterable[str] | None = None, drop: Iterable[str] = ()) -> DataFrame:
    """Keep the listed columns (all by default) but for the dropped ones."""
    dropped = set(drop)
    return df.select([col(c) for c in (keep if keep is not None else df.columns) if c not in dropped])


def numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> DataFrame:
    return df.select([col(c) for c in numeric_names(df)])


def cast_columns(df: DataFrame, columns: Iterable[str], to: str) -> DataFrame:
    return df.withColumns({c: col(c).cast(to) for c in columns})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def rename_regex(df: DataFrame, pattern: str, replacement: str = "") -> DataFrame:
    """Rewrite every column name with a regular expression."""
    renamed = [re.sub(pattern, replacement, c) for c in df.columns]
    if len(set(renamed)) < len(renamed):
        raise ValueError("renaming would make two columns alike")
    return df.toDF(*renamed)


def columns_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.select([col(c) for c in df.columns if re.search(pattern, c)])


def split_xy(df: DataFrame, target: str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Features and target. Rows have no position, so pass a key to tie the two."""
    tie = [key] if key else []
    return df.drop(target), df.select([col(c) for c in [*tie, target]])


def one_group(df: DataFrame, group: str, value) -> DataFrame:
    return df.where(col(group) == value)
