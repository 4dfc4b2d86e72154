"""Counts, moments, correlations, histograms and simple regressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import col, holds, value


def _grouped(df: DataFrame, group: str):
    """Rows without a group are left out."""
    return df.where(col(group).isNotNull()).groupBy(col(group))


def group_stats(df: DataFrame, group: str, y: str) -> DataFrame:
    return _grouped(df, group).agg(F.avg(col(y)).alias("mean"), F.stddev_samp(col(y)).alias("std"),
                                   F.count(col(y)).alias("count"))


def group_count(df: DataFrame, group: str) -> DataFrame:
    """Rows per group, most first."""
    return _grouped(df, group).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), col(group))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return group_count(df, column)


def ids_by_group(df: DataFrame, group: str, key: str) -> DataFrame:
    """What identifies each group's rows: count, extremes and a checksum of the ids. The
    rows themselves stay in the table, under their group column; a list of ids would put
    a whole group in one cell."""
    k = col(key)
    return _grouped(df, group).agg(
        F.count(k).alias("n_ids"), F.min(k).alias("min_id"), F.max(k).alias("max_id"),
        F.sum(F.pmod(k * F.lit(2654435761), F.lit(1_000_003))).alias("checksum"))


def count_where(df: DataFrame, condition: Column | str) -> DataFrame:
    return df.agg(F.count_if(holds(condition)).alias("n_rows"))


# --- shape of a distribution -------------------------------------------------

def skew(x: Column) -> Column:
    """Bias-corrected skewness; needs three values."""
    n = F.count(x).cast("double")
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def kurt(x: Column) -> Column:
    """Bias-corrected excess kurtosis; needs four values."""
    n = F.count(x).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6))


def _per_column(df: DataFrame, columns: Sequence[str], measures) -> DataFrame:
    """One aggregate over the table, one output row per column."""
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), *[
        f(value(c)).alias(name) for name, f in measures.items()]) for c in columns])
    return df.agg(entries.alias("e")).select(F.explode("e").alias("e")).select("e.*")


def skew_kurt(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _per_column(df, columns, {"skew": skew, "kurt": kurt})


def normal_test(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """D'Agostino-Pearson test: statistic and p-value from the population moments. Missing for fewer
    than four values or a column without spread."""
    raw = _per_column(df, columns, {"n": lambda x: F.count(x).cast("double"), "g1": F.skewness, "g2": F.kurtosis})
    n, g1, g2 = F.col("n"), F.col("g1"), F.col("g2")
    # skewness: transformed to a standard normal (D'Agostino 1970)
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    b2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (b2 - 1)) - 1
    ratio = y / F.sqrt(2 / (w2 - 1))
    z_skew = F.log(ratio + F.sqrt(ratio * ratio + 1)) / F.sqrt(0.5 * F.log(w2))
    # kurtosis (Anscombe and Glynn 1983)
    expected = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (g2 + 3 - expected) / F.sqrt(variance)
    beta = (6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
            * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))))
    a = 6 + 8 / beta * (2 / beta + F.sqrt(1 + 4 / (beta * beta)))
    cube = (1 - 2 / a) / (1 + x * F.sqrt(2 / (a - 4)))
    z_kurt = (1 - 2 / (9 * a) - F.signum(cube) * F.pow(F.abs(cube), F.lit(1 / 3))) / F.sqrt(2 / (9 * a))
    k2 = z_skew * z_skew + z_kurt * z_kurt
    # Values below four would divide by zero; they never reach the formulas.
    raw = raw.select("column_name", *[F.when((n >= 4) & ~F.isnan(g1), c).alias(name)
                                      for name, c in (("n", n), ("g1", g1), ("g2", g2))])
    return raw.select("column_name", k2.alias("statistic"), F.exp(-k2 / 2).alias("p_value"))


def fit_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """{column: (mean, population standard deviation)}."""
    aggs = [f(value(c)).alias(f"{name}{i}") for i, c in enumerate(columns)
            for name, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = df.agg(*aggs).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


# --- correlation -------------------------------------------------------------

# Pairs computed by built-in aggregates; wider tables use one moment matrix.
BUILTIN_PAIRS = 120


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, in long form; each pair over the rows where
    both are present. A column without spread has no correlation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    if len(pairs) > BUILTIN_PAIRS:
        from ..models.gram import pairwise_correlations
        return pairwise_correlations(df, columns)
    return _pairs(df, pairs)


def _pairs(df: DataFrame, pairs) -> DataFrame:
    def correlation(a, b):
        x, y = value(a), value(b)
        both = x.isNotNull() & y.isNotNull()
        # corr divides by the spread even where it is zero, so a flat side is left out of it
        x_low, x_high, y_low, y_high = (f(F.when(both, v)) for v in (x, y) for f in (F.min, F.max))
        return F.when((x_low < x_high) & (y_low < y_high), F.try_divide(
            F.covar_pop(x, y), F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))))

    entries = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), correlation(a, b).alias("r"))
                        for a, b in pairs])
    return df.agg(entries.alias("e")).select(F.explode("e").alias("e")).select("e.*")


def corr_with(df: DataFrame, y: str, columns: Sequence[str]) -> DataFrame:
    """Features by correlation with the target, strongest positive first."""
    return (_pairs(df, [(c, y) for c in columns if c != y])
            .select(F.col("a").alias("column_name"), "r").orderBy(F.desc("r"), "column_name"))


# --- histograms --------------------------------------------------------------

def _bins(df: DataFrame, x: str, bins: int):
    v = value(x)
    low, high, total = df.agg(F.min(v), F.max(v), F.count(v)).first()
    if low is None or low == high:
        low, high = (0.0, 1.0) if low is None else (low, low + 1.0)
    number = F.least(F.floor((col(x) - F.lit(low)) / F.lit(high - low) * bins), F.lit(bins - 1)).cast("int")
    return low, (high - low) / bins, total, number


def histogram(df: DataFrame, x: str, bins: int, facet: str | None = None) -> DataFrame:
    """Equal-width counts from the minimum to the maximum over all rows, per facet."""
    present = df.where(value(x).isNotNull())
    if facet:
        present = present.where(col(facet).isNotNull())
    *_, number = _bins(present, x, bins)
    keys = [col(facet)] if facet else []
    return present.groupBy(*keys, number.alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))


def normal_fit(df: DataFrame, x: str, bins: int) -> DataFrame:
    """Observed density per bin beside the density of the normal with the same mean and
    population standard deviation, at the bin's center."""
    present = df.where(value(x).isNotNull())
    low, width, total, number = _bins(present, x, bins)
    mean, std = fit_moments(present, [x])[x]
    counted = present.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))
    center = F.lit(low) + (F.col("bin") + 0.5) * F.lit(width)
    std = std if std else math.nan  # a normal without spread has no density
    z = (center - F.lit(mean)) / F.lit(std)
    return counted.select(
        "bin", "n_rows", (F.col("n_rows") / F.lit(total * width)).alias("density"),
        (F.exp(-z * z / 2) / F.lit(std * (2 * math.pi) ** 0.5)).alias("normal_density"))


# --- simple regression -------------------------------------------------------

def ols_line(df: DataFrame, x: str, y: str, group: str | None = None) -> DataFrame:
    """Slope, intercept and R2 of y ~ 1 + x, for all rows or per group."""
    a, b = value(y), value(x)
    source = _grouped(df, group) if group else df
    return source.agg(F.regr_slope(a, b).alias("slope"), F.regr_intercept(a, b).alias("intercept"),
                      F.regr_r2(a, b).alias("r2"))


def with_fitted(df: DataFrame, x: str, y: str, name: str = "fitted") -> DataFrame:
    slope, intercept, _ = ols_line(df, x, y).first()
    return df.withColumn(name, F.lit(slope) * col(x) + F.lit(intercept))
