"""Recoded and derived columns: thin table forms of the column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import columns as C
from ..functions.columns import col

# Letter grades, best to worst.
GRADES = {"Ex": 5, "Gd": 4, "TA": 3, "Fa": 2, "Po": 1}


def recode(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    return df.withColumns({c: C.replace_values(col(c), m) for c, m in rules.items()})


def merge_levels(df: DataFrame, column: str, values: Iterable, label) -> DataFrame:
    return df.withColumn(column, C.merge_into(col(column), values, label))


def keep_or_other(df: DataFrame, column: str, keep, other="Oth") -> DataFrame:
    return df.withColumn(column, C.keep_only(col(column), keep, other))


def clamp_low(df: DataFrame, column: str, low) -> DataFrame:
    return df.withColumn(column, C.at_least(col(column), low))


def ordinal_encode(df: DataFrame, columns: Iterable[str], scale: Mapping[str, int] = GRADES) -> DataFrame:
    return df.withColumns({c: C.grade(col(c), scale) for c in columns})


def flag_equals(df: DataFrame, column: str, value, name: str | None = None) -> DataFrame:
    return df.withColumn(name or column, C.equals(col(column), value))


def flag_present(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, col(column).isNotNull())


def flag_nonzero(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """{new flag: column}; a missing value counts as not zero."""
    return df.withColumns({name: C.differs(col(c), 0) for name, c in flags.items()})


def flag_same(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    return df.withColumn(name, C.same(col(a), col(b)))


def flag_in(df: DataFrame, column: str, values: Iterable, name: str) -> DataFrame:
    return df.withColumn(name, C.among(col(column), values))


def diff_columns(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """{new: (a, b)} gives a - b."""
    return df.withColumns({name: col(a) - col(b) for name, (a, b) in pairs.items()})


def sum_columns(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    return df.withColumn(name, C.total([col(c) for c in columns]))


def weighted_sum(df: DataFrame, weights: Mapping[str, float], name: str) -> DataFrame:
    return df.withColumn(name, C.weighted([(col(c), w) for c, w in weights.items()]))


def power_columns(df: DataFrame, column: str, powers: Mapping[str, int]) -> DataFrame:
    return df.withColumns({name: F.pow(col(column), F.lit(float(p))) for name, p in powers.items()})


def scale_power(df: DataFrame, column: str, power: float, name: str) -> DataFrame:
    return df.withColumn(name, F.pow(col(column), F.lit(float(power))))


def sin_month(df: DataFrame, column: str, name: str = "sin_month") -> DataFrame:
    return df.withColumn(name, C.half_wave(col(column)))


def log_column(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, F.log(col(column)))


def log_positive(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: C.log_if_positive(col(c)) for c in columns})
