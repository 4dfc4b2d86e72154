"""One-hot levels of every type, and their bound."""

from __future__ import annotations

import datetime
import decimal

import pytest

from gablework.operators.transformers import OneHot


def test_dates_and_decimals_are_levels(spark, tmp_path):
    from gablework.sources.sinks import load_model, save_model

    df = spark.createDataFrame([(datetime.date(2020, 1, 1), decimal.Decimal("1.5")), (datetime.date(2020, 1, 2), decimal.Decimal("2.5"))],
                               "day date, price decimal(4,1)")
    model = OneHot(["day", "price"], drop=None).fit(df)
    save_model(model, str(tmp_path / "m"))
    rows = [r.asDict() for r in load_model(str(tmp_path / "m")).transform(df).collect()]
    assert rows == [{"day_2020-01-01": 1, "day_2020-01-02": 0, "price_1.5": 1, "price_2.5": 0},
                    {"day_2020-01-01": 0, "day_2020-01-02": 1, "price_1.5": 0, "price_2.5": 1}]


def test_bound_on_levels_is_an_argument(spark):
    df = spark.range(6_000).selectExpr("cast(id as string) AS c")
    with pytest.raises(ValueError):
        OneHot(["c"]).fit(df)
    assert len(OneHot(["c"], most_levels=7_000).fit(df)["levels"][0]) == 6_000
