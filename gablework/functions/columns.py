"""Column expressions with the missing-value rules of a dataframe library.

A missing value is a value there: it equals nothing, differs from everything and
never satisfies an order comparison. SQL yields NULL in those places, so each
expression below states which of the two it follows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, functions as F

from . import text


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def missing_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def finite(c: Column) -> Column:
    """A double, with NaN and the infinities as missing: the rule of every statistic, matrix and fit."""
    return F.when(F.abs(c) < F.lit(math.inf), c)  # NaN is above all numbers


def value(name: str) -> Column:
    """A column as a double, with NaN and the infinities as missing."""
    return finite(col(name).cast("double"))


# --- flags: never NULL -------------------------------------------------------

def equals(c: Column, value) -> Column:
    """``c == value``; False where missing."""
    return c.eqNullSafe(F.lit(value))


def differs(c: Column, value) -> Column:
    """``c != value``; True where missing."""
    return ~c.eqNullSafe(F.lit(value))


def same(a: Column, b: Column) -> Column:
    """Two columns agree; two missing values do not."""
    return F.coalesce(a == b, F.lit(False))


def among(c: Column, values: Iterable) -> Column:
    return F.coalesce(c.isin(list(values)), F.lit(False))


def holds(condition: Column | str) -> Column:
    """A condition (an expression or its SQL text) as a two-valued flag."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return F.coalesce(condition, F.lit(False))


# --- recoding ----------------------------------------------------------------

def replace_values(c: Column, mapping: Mapping) -> Column:
    """Swap single values; ``None`` as the new value makes it missing."""
    branches = [(c == F.lit(old), F.lit(new)) for old, new in mapping.items()]
    if not branches:
        return c
    expr = F.when(*branches[0])
    for condition, value in branches[1:]:
        expr = expr.when(condition, value)
    return expr.otherwise(c)


def merge_into(c: Column, values: Iterable, label) -> Column:
    return F.when(c.isin(list(values)), F.lit(label)).otherwise(c)


def keep_only(c: Column, value, other) -> Column:
    """``value`` stays, everything else becomes ``other``, missing included."""
    return F.when(differs(c, value), F.lit(other)).otherwise(c)


def at_least(c: Column, low) -> Column:
    """Raise small values to ``low``; missing stays missing."""
    return F.when(c < F.lit(low), F.lit(low)).otherwise(c)


def grade(c: Column, scale: Mapping[str, int]) -> Column:
    """Ordered letters to integers; missing and unknown letters give 0."""
    table = F.create_map(*[F.lit(v) for pair in scale.items() for v in pair])
    return F.coalesce(F.try_element_at(table, c), F.lit(0))


# --- arithmetic: NULL where an input is missing ------------------------------

def total(columns: Sequence[Column]) -> Column:
    return reduce(add, columns)


def weighted(terms: Sequence[tuple[Column, float]]) -> Column:
    return reduce(add, [c if w == 1 else c * F.lit(float(w)) for c, w in terms])


def half_wave(month: Column) -> Column:
    return F.sin(F.lit(math.pi) * month / F.lit(12.0))


def log_if_positive(c: Column) -> Column:
    """Natural log of positive values; zero and below are left alone."""
    return F.when(c > 0, F.log(c)).otherwise(c)


def log_of_positive(c: Column, what: str) -> Column:
    """Natural log; zero and below are an error that names the column, since a row would leave every fit unnoticed."""
    message = F.concat(F.lit(f"no logarithm of {what}: "), c.cast("string"))
    return F.when(c <= 0, F.raise_error(message).cast("double")).otherwise(F.log(c))


def conjunction(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def complete_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows without a missing value, NULL, NaN or infinite, in the named columns. One condition per column:
    ``dropna`` makes a single condition over all of them, and the optimizer derives
    exponentially many constraints from that when the columns are renamed."""
    fractional = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.where(conjunction([col(n).isNotNull() for n in names]
                                + [F.abs(col(n)) < F.lit(math.inf) for n in names if n in fractional]))


def dot(names: Sequence[str], weights: Sequence[float], intercept: float = 0.0) -> Column:
    """intercept + sum of weight * column, skipping zero weights."""
    return F.expr(text.dot(names, weights, intercept))
