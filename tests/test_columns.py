"""Missing-value rules of the column expressions, one case per rule."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gablework.functions import columns as C
from gablework.operators import derive, select


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, "Y", 2, 2, "Ex", 1.0), (2, "N", 0, 5, "zz", 0.0), (3, None, None, None, None, None)],
        "id int, s string, a int, b int, q string, x double")


def values(df, expr):
    return [r[0] for r in df.orderBy("id").select(expr).collect()]


@pytest.mark.parametrize("build, expected", [
    (lambda: C.equals(F.col("s"), "Y"), [True, False, False]),
    (lambda: C.differs(F.col("a"), 0), [True, False, True]),
    (lambda: C.same(F.col("a"), F.col("b")), [True, False, False]),
    (lambda: C.among(F.col("s"), ["Y"]), [True, False, False]),
    (lambda: C.keep_only(F.col("s"), "Y", "Oth"), ["Y", "Oth", "Oth"]),
    (lambda: C.at_least(F.col("a"), 1), [2, 1, None]),
    (lambda: C.grade(F.col("q"), derive.GRADES), [5, 0, 0]),
    (lambda: C.total([F.col("a"), F.col("b")]), [4, 5, None]),
    (lambda: C.log_if_positive(F.col("x")), [0.0, 0.0, None]),
    (lambda: C.replace_values(F.col("s"), {"Y": "Z", "N": None}), ["Z", None, None]),
    (lambda: C.merge_into(F.col("s"), ["Y", "N"], "M"), ["M", "M", None]),
])
def test_rule(rows, build, expected):
    assert values(rows, build()) == expected


def test_outliers_that_cannot_be_judged_stay(rows):
    assert select.remove_outliers(rows, "a > 1 AND b < 3").count() == 2


def test_rename_refuses_to_merge_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, ab int")
    with pytest.raises(ValueError):
        select.rename_regex(df, "[.]")


def test_complete_rows_plans_quickly_over_many_derived_columns(spark):
    import time

    df = spark.range(10).withColumn("x", F.when(F.col("id") > 3, F.col("id")))
    for step in range(3):
        df = df.select("id", "x", *[(F.col("x") + i + step).alias(f"c{i}") for i in range(40)])
    start = time.time()
    assert C.complete_rows(df, [f"c{i}" for i in range(40)]).count() == 6
    assert time.time() - start < 20
