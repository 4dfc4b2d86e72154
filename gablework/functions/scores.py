"""Score aggregates: use inside ``agg``, with or without groups."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def r2(y: Column, predicted: Column) -> Column:
    """1 - residual sum of squares / total sum of squares; missing where y does not vary."""
    both = y.isNotNull() & predicted.isNotNull()
    residual = F.sum(F.pow(y - predicted, F.lit(2.0)))
    spread = F.var_pop(F.when(both, y)) * F.count(F.when(both, y))
    return F.lit(1.0) - F.try_divide(residual, spread)


def mse(y: Column, predicted: Column) -> Column:
    return F.avg(F.pow(y - predicted, F.lit(2.0)))


def rmse(y: Column, predicted: Column) -> Column:
    return F.sqrt(mse(y, predicted))


def msle(y: Column, predicted: Column) -> Column:
    """Mean squared error of the logs."""
    return mse(F.log(y), F.log(predicted))


def rmsle(y: Column, predicted: Column) -> Column:
    return F.sqrt(msle(y, predicted))
