from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gablework.operators import lookup, missing


@pytest.fixture(scope="module")
def rows(spark):
    # group "hot" holds most rows
    data = [("hot", "b" if i % 3 else "a", i % 2, i) for i in range(900)]
    data += [("tie", "y", 1, 1000), ("tie", "x", 2, 1001), ("tie", None, 1, 1002),
             ("empty", None, None, 1003), (None, "q", 7, 1004), ("hot", None, None, 1005), ("new", None, 3, 1006)]
    return spark.createDataFrame(data, "g string, s string, n int, id int").repartition(4)


def test_mode_and_rarest(rows):
    def table(strategy):
        return {r["g"]: (r["s"], r["n"]) for r in missing.group_choice(rows, "g", ["s", "n"], strategy).collect()}

    assert table("mode") == {"hot": ("b", 0), "tie": ("x", 1), "empty": (None, None), "new": (None, 3)}
    assert table("rarest")["hot"] == ("a", 0)
    assert table("rarest")["tie"] == ("x", 2)


def test_imputer_fills_from_its_group(rows):
    model = missing.GroupModeImputer("g", ["s", "n"]).fit(rows)
    out = {r["id"]: (r["s"], r["n"]) for r in model.transform(rows).collect()}
    assert len(out) == rows.count()
    assert out[1005] == ("b", 0) and out[1002] == ("x", 1)
    assert out[1003] == (None, None)  # a group without values
    assert out[1004] == ("q", 7)      # a row without a group is left alone


def test_factorizer_uses_train_codes(rows, spark):
    fit = missing.Factorizer("s", "id", "code").fit(rows)
    codes = {r["s"]: r["code"] for r in fit.transform(rows).select("s", "code").distinct().collect()}
    assert codes == {"a": 0, "b": 1, "y": 2, "x": 3, "q": 4, None: -1}
    other = spark.createDataFrame([("never",), ("b",)], "s string")
    assert {r["s"]: r["code"] for r in fit.transform(other).collect()} == {"never": -1, "b": 1}


def test_saved_lookup_stands_alone(spark, tmp_path):
    """A model with 60,000 date groups is saved whole: the scratch table behind it may go."""
    import shutil

    from gablework.sources.sinks import load_model, save_model

    df = spark.range(120_000).selectExpr(
        "date_add(date'1900-01-01', cast(id % 60000 as int)) AS day", "cast(id % 60000 % 7 as string) AS s",
        "cast(id % 60000 % 3 as decimal(4,1)) AS d")
    model = missing.GroupModeImputer("day", ["s", "d"]).fit(df)
    save_model(model, str(tmp_path / "model"))
    shutil.rmtree(model["table"]["path"].removeprefix("file:"))
    again = load_model(str(tmp_path / "model"))
    holes = df.withColumns({"s": F.lit(None).cast("string"), "d": F.lit(None).cast("decimal(4,1)")}).limit(60_000)
    filled = again.transform(holes)
    assert filled.where("s is null or d is null").count() == 0
    assert filled.join(df.distinct(), ["day", "s", "d"], "left_anti").count() == 0


def test_numbered_is_gapless(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = {(r["k"], r["i"]) for r in lookup.numbered(df, "k", "i").collect()}
    assert got == {(i, i) for i in range(1000)}


def test_fill_leaves_nothing_missing(t):
    filled = missing.fill_constant(t, ["zoning", "frontage"], "0")
    assert filled.where("zoning is null or frontage is null").count() == 0
    assert dict(filled.dtypes)["frontage"] == "bigint"


def test_unknown_strategy(rows):
    with pytest.raises(ValueError):
        missing.group_choice(rows, "g", ["s"], "median")
